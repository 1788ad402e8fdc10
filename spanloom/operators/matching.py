"""One-to-one matching of gold and predicted spans, greedy in the order of the gold spans.

Spans that touch, directly or through others, form a cluster; no match leaves its
cluster.  Clusters are found by a running maximum within a document, most are
settled by their counts, and only those in which a choice exists meet the greedy
pass, which handles many clusters of one Arrow batch at a time.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

PAIRS = "array<struct<g:int,p:int,class:string>>"
_PAIR_TYPE = pa.list_(pa.struct([("g", pa.int32()), ("p", pa.int32()), ("class", pa.string())]))


def over_arrays(kernel: Callable, *columns: Column) -> Column:
    """``kernel`` of each row's arrays: pairs (place in the first, place in the second, class)."""

    @F.arrow_udf(PAIRS)
    def run(first: pa.Array, second: pa.Array) -> pa.Array:
        out = [[{"g": g, "p": p, "class": c} for g, p, c in kernel(a or [], b or [])] for a, b in zip(first.to_pylist(), second.to_pylist())]
        return pa.array(out, _PAIR_TYPE)

    return run(*columns)


def shared(a: dict, b: dict) -> int:
    """Characters that both half-open spans hold."""
    return max(0, min(a["end"], b["end"]) - max(a["start"], b["start"]))


def by_overlap(golds: list[dict], preds: list[dict]) -> list[tuple[int, int, str]]:
    """Pairs of the same type by the largest overlap, then of other types; ties go to the earlier prediction."""
    out, free_g, free_p = [], list(range(len(golds))), list(range(len(preds)))
    for name, same in (("BOUNDARY", True), ("TYPE_MISMATCH", False)):
        rest = []
        for i in free_g:
            rated = [(shared(golds[i], preds[j]), -j) for j in free_p if (golds[i]["type"] == preds[j]["type"]) is same]
            size, j = max(rated, default=(0, 0))
            if size:
                out.append((i, -j, name))
                free_p.remove(-j)
            else:
                rest.append(i)
        free_g = rest
    return out


def by_place(golds: list[dict], preds: list[dict]) -> list[tuple[int, int, str]]:
    """Each gold span with its exact prediction if that is free, else with the first free one that touches it (one type)."""
    equal: dict[tuple, deque] = defaultdict(deque)
    for j, p in enumerate(preds):
        equal[p["start"], p["end"]].append(j)
    out, free = [], dict.fromkeys(range(len(preds)))
    for i, g in enumerate(golds):
        same = equal[g["start"], g["end"]]
        while same and same[0] not in free:
            same.popleft()
        j = same[0] if same else next((j for j in free if shared(g, preds[j])), None)
        if j is not None:
            out.append((i, j, "COR" if same else "PAR"))
            del free[j]
    return out


def by_containment(golds: list[dict], preds: list[dict]) -> list[tuple[int, int, str]]:
    """Each prediction, in order, with the first free gold surface that equals it, holds it or stands in it."""
    out, free = [], dict.fromkeys(range(len(golds)))
    for j, p in enumerate(preds):
        i = next((i for i in free if p["surface"] in golds[i]["surface"] or golds[i]["surface"] in p["surface"]), None)
        if i is not None:
            out.append((i, j, "MATCH"))
            del free[i]
    return out


def sides(gold: DataFrame, pred: DataFrame, columns: list[str]) -> DataFrame:
    """Both tables with flags g and p."""
    return gold.select(*columns, F.lit(1).alias("g"), F.lit(0).alias("p")).unionByName(pred.select(*columns, F.lit(0).alias("g"), F.lit(1).alias("p")))


def clusters(both: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """One row per cluster of touching spans: the keys, and arrays gs and ps of ``fields`` in that order; one shuffle by the keys."""
    order = Window.partitionBy(*keys).orderBy("start", "end")
    top = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    again = (F.lag("start").over(order) == F.col("start")) & (F.lag("end").over(order) == F.col("end"))  # equal empty spans belong together
    opens = F.when(top.isNull() | (F.col("start") >= top) & ~again, 1).otherwise(0)
    numbered = both.withColumn("_opens", opens).withColumn("_cluster", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    listed = lambda side: F.array_sort(F.collect_list(F.when(F.col(side) == 1, F.struct(*fields))))
    return numbered.groupBy(*keys, "_cluster").agg(listed("g").alias("gs"), listed("p").alias("ps"))


def relaxed_pairs(gold: DataFrame, pred: DataFrame, key: str = "doc_id") -> DataFrame:
    """Clusters of one type with their pairs (COR or PAR)."""
    found = clusters(sides(gold, pred, [key, "type", "start", "end"]), [key, "type"], ["start", "end"])
    simple = (F.size("gs") <= 1) & (F.size("ps") <= 1)
    g, p = F.get("gs", F.lit(0)), F.get("ps", F.lit(0))
    touch = (g["start"] < p["end"]) & (p["start"] < g["end"])
    one = lambda name: F.array(F.struct(F.lit(0).alias("g"), F.lit(0).alias("p"), F.lit(name).alias("class")))
    exact = (g["start"] == p["start"]) & (g["end"] == p["end"])
    pairs = F.when(exact, one("COR")).when(touch, one("PAR")).otherwise(F.array().cast(PAIRS))
    settled = found.where(simple | (F.size("gs") == 0) | (F.size("ps") == 0)).withColumn("pairs", F.when(simple, pairs).otherwise(F.array().cast(PAIRS)))
    open_ = found.where(~simple & (F.size("gs") > 0) & (F.size("ps") > 0))
    return settled.unionByName(open_.withColumn("pairs", over_arrays(by_place, F.col("gs"), F.col("ps"))))


def error_rows(gold: DataFrame, pred: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per pair or span left over: class EXACT, BOUNDARY, TYPE_MISMATCH, MISS or HALLUCINATION.

    Equal spans pair off by their counts before clusters are made.  Order of the
    gold spans and of the predictions: start, end, type.  Spans of no length
    pair only with equal ones; equal spans count as often as they stand there.
    """
    span = ["start", "end", "type"]
    counts = sides(gold, pred, [key, *span]).groupBy(key, *span).agg(F.sum("g").alias("g"), F.sum("p").alias("p"))
    both = F.least("g", "p")
    times = lambda df, n: df.withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), n))).drop("_n")
    named = lambda side, src="": [F.col(f"{src}{c}").alias(f"{side}_{c}") for c in span]
    exact = times(counts.where(both > 0), both).select(key, *named("g"), *named("p"), F.lit("EXACT").alias("class"))
    left = counts.where("g <> p")
    rest = times(left.where("g > p"), F.col("g") - F.col("p")).select(key, *span, F.lit(1).alias("g"), F.lit(0).alias("p"))
    rest = rest.unionByName(times(left.where("p > g"), F.col("p") - F.col("g")).select(key, *span, F.lit(0).alias("g"), F.lit(1).alias("p")))
    found = clusters(rest, [key], span)
    none = F.array().cast(PAIRS)
    alone = (F.size("gs") == 0) | (F.size("ps") == 0)
    paired = found.where(alone).withColumn("pairs", none).unionByName(found.where(~alone).withColumn("pairs", over_arrays(by_overlap, F.col("gs"), F.col("ps"))))
    kind = f"array<struct<{', '.join(f'{s}_{c}:{t}' for s in 'gp' for c, t in (('start', 'bigint'), ('end', 'bigint'), ('type', 'string')))}, class:string>>"
    rows = F.expr(f"""cast(concat(
        transform(pairs, x -> named_struct('gs', gs[x.g].start, 'ge', gs[x.g].end, 'gt', gs[x.g].type, 'ps', ps[x.p].start, 'pe', ps[x.p].end, 'pt', ps[x.p].type, 'c', x.class)),
        transform(filter(gs, (s, i) -> not exists(pairs, x -> x.g = i)), s -> named_struct('gs', s.start, 'ge', s.end, 'gt', s.type, 'ps', null, 'pe', null, 'pt', null, 'c', 'MISS')),
        transform(filter(ps, (s, i) -> not exists(pairs, x -> x.p = i)), s -> named_struct('gs', null, 'ge', null, 'gt', null, 'ps', s.start, 'pe', s.end, 'pt', s.type, 'c', 'HALLUCINATION'))) as {kind})""")
    return exact.unionByName(paired.select(key, F.inline(rows)))


def containment_counts(gold: DataFrame, pred: DataFrame, key: str = "doc_id", order: str = "start") -> DataFrame:
    """Per type: surfaces matched by containment (one to one), predicted and gold; a document's surfaces of a type are the unit."""
    from ..functions.text import plain_surface

    plain = lambda df: df.select(key, F.trim("type").alias("type"), F.col(order).alias("place"), plain_surface(F.col("surface")).alias("surface"))
    both = sides(plain(gold), plain(pred), [key, "type", "place", "surface"])
    listed = lambda side: F.array_sort(F.collect_list(F.when(F.col(side) == 1, F.struct("place", "surface"))))
    found = both.groupBy(key, "type").agg(listed("g").alias("gs"), listed("p").alias("ps"))
    alone = (F.size("gs") == 0) | (F.size("ps") == 0)
    n = found.where(alone).withColumn("m", F.lit(0)).unionByName(found.where(~alone).withColumn("m", F.size(over_arrays(by_containment, F.col("gs"), F.col("ps")))))
    return n.groupBy("type").agg(F.sum("m").alias("tp"), F.sum(F.size("ps")).alias("n_pred"), F.sum(F.size("gs")).alias("n_gold"))
