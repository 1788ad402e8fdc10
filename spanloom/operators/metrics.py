"""Span scores.  Strict scores are set-based; relaxed ones keep duplicates and match greedily in gold order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import context, plain_surface, surface
from . import matching


def prf(tp: Column, pred: Column, gold: Column) -> tuple[Column, Column, Column]:
    """Precision, recall, F1 from counts; 0 where a denominator is 0."""
    p = F.when(pred > 0, tp / pred).otherwise(F.lit(0.0))
    r = F.when(gold > 0, tp / gold).otherwise(F.lit(0.0))
    return p, r, F.when(tp > 0, 2 * tp / (pred + gold)).otherwise(F.lit(0.0))


def rated(counts: DataFrame, tp: str = "tp", pred: str = "n_pred", gold: str = "n_gold", places: int | None = 6) -> DataFrame:
    shown = [x if places is None else F.round(x, places) for x in prf(F.col(tp), F.col(pred), F.col(gold))]
    return counts.withColumns(dict(zip(("precision", "recall", "f1"), shown)))


def sides(gold: DataFrame, pred: DataFrame, keys: list[str], carry: list[str] | None = None) -> DataFrame:
    """One row per distinct span with flags of the sides it is on; one shuffle, combined before it."""
    cols = [*keys, *(carry or [])]
    both = gold.select(*cols, F.lit(1).alias("g"), F.lit(0).alias("p")).unionByName(pred.select(*cols, F.lit(0).alias("g"), F.lit(1).alias("p")))
    return both.groupBy(*cols).agg(F.max("g").alias("g"), F.max("p").alias("p"))


def strict(gold: DataFrame, pred: DataFrame, by: list[str] | None = None, keys: list[str] | None = None, places: int | None = 6) -> DataFrame:
    """Micro scores overall (type ALL) and per type, for each value of ``by``; ``places`` None leaves them unrounded."""
    by, keys = by or [], keys or ["doc_id", "start", "end", "type"]
    flags = sides(gold, pred, keys, [c for c in by if c not in keys])
    counted = flags.groupBy(*by, "type").agg(F.sum(F.col("g") * F.col("p")).alias("tp"), F.sum("p").alias("n_pred"), F.sum("g").alias("n_gold"))
    total = counted.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("tp", "n_pred", "n_gold")]) if by else counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "n_pred", "n_gold")])
    return rated(counted.unionByName(total.withColumn("type", F.lit("ALL"))), places=places)


def relaxed(gold: DataFrame, pred: DataFrame, key: str = "doc_id", by: list[str] | None = None) -> DataFrame:
    """COR + PAR/2 scores; each gold span, in order, takes its exact prediction, else the first unused overlapping one of its type.

    ``by`` names columns of both tables that are part of the key and split the scores.
    """
    by = by or []
    both = gold, pred
    if by:
        both = tuple(df.withColumn("_key", F.struct(key, *by)) for df in both)
    found = matching.relaxed_pairs(*both, "_key" if by else key)
    groups = [F.col(f"_key.{c}").alias(c) for c in by]
    many = lambda name: F.size(F.filter("pairs", lambda x: x["class"] == name)).cast("long")
    counted = found.groupBy(*groups, "type").agg(F.sum(many("COR")).alias("cor"), F.sum(many("PAR")).alias("par"), F.sum(F.size("ps").cast("long")).alias("n_pred"), F.sum(F.size("gs").cast("long")).alias("n_gold"))
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("cor", "par", "n_pred", "n_gold")]
    total = (counted.groupBy(*by).agg(*sums) if by else counted.agg(*sums)).withColumn("type", F.lit("ALL"))
    out = counted.unionByName(total).withColumn("credit", F.col("cor") + F.col("par") * 0.5)
    return rated(out, "credit").drop("credit")


def errors(gold: DataFrame, pred: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per matched pair or unmatched span, see ``matching.error_rows``."""
    return matching.error_rows(gold, pred, key)


def error_totals(rows: DataFrame) -> DataFrame:
    """Counts of the gold side (fn) and the predicted side (fp) by type and class, by class, and in all (type or class ALL)."""
    sides_ = rows.where("class <> 'EXACT'").select(F.explode(F.array(
        F.struct(F.lit("fn").alias("side"), F.col("g_type").alias("type"), "class"),
        F.struct(F.lit("fp").alias("side"), F.col("p_type").alias("type"), "class"),
    )).alias("x")).select("x.*").where("type is not null")
    counted = sides_.groupBy("side", "type", "class").agg(F.count("*").alias("n"))
    by_class = counted.groupBy("side", "class").agg(F.sum("n").alias("n")).withColumn("type", F.lit("ALL"))
    total = by_class.groupBy("side").agg(F.sum("n").alias("n")).withColumns({"type": F.lit("ALL"), "class": F.lit("ALL")})
    return counted.unionByName(by_class).unionByName(total)


def confusion(rows: DataFrame) -> DataFrame:
    """Pairs by gold and predicted type: exact and boundary pairs on the diagonal, the empty sign for the missing side."""
    return rows.groupBy(F.coalesce("g_type", F.lit("∅")).alias("gold_type"), F.coalesce("p_type", F.lit("∅")).alias("pred_type")).agg(F.count("*").alias("n"))


def top_errors(rows: DataFrame, docs: DataFrame, side: str, n: int = 50, width: int = 20, key: str = "doc_id") -> DataFrame:
    """The ``n`` errors of each type on one side (fn or fp): surfaces that err most often first, then by document and place.

    With the surface, ``width`` characters on either side, the class and the type of the other side.
    """
    if side not in ("fn", "fp"):
        raise ValueError(f"side must be fn or fp: {side}")
    mine, other = ("g", "p") if side == "fn" else ("p", "g")
    start, end = F.col(f"{mine}_start"), F.col(f"{mine}_end")
    wrong = rows.where(f"class <> 'EXACT' and {mine}_type is not null").join(docs.select(key, "text"), key)
    left, right = context(F.col("text"), start, end, width)
    shown = wrong.select(key, F.col(f"{mine}_type").alias("type"), surface(F.col("text"), start, end).alias("surface"), left.alias("left"), right.alias("right"), "class", F.coalesce(f"{other}_type", F.lit("∅")).alias("counter"), start.alias("start"), end.alias("end"))
    often = shown.groupBy("type", "surface").agg(F.count("*").alias("n"))
    order = Window.partitionBy("type").orderBy(F.desc("n"), key, "start", "end", "class", "counter")
    return shown.join(often, ["type", "surface"]).withColumn("r", F.row_number().over(order)).where(F.col("r") <= n)


def dirty(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents with at least one error, and how many on each side."""
    fn, fp = F.count_if((F.col("class") != "EXACT") & F.col("g_type").isNotNull()), F.count_if((F.col("class") != "EXACT") & F.col("p_type").isNotNull())
    return rows.groupBy(key).agg(fn.alias("fn"), fp.alias("fp")).where("fn > 0 or fp > 0")


def review_sample(rows: DataFrame, ratio: float = 0.1, least: int = 3, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """Erring documents to review: the first ``least`` of each type in seeded order, then others up to the share ``ratio`` of them.

    Own deterministic order: by a portable hash, not by a generator that walks the documents.
    """
    wrong = rows.where("class <> 'EXACT'")
    types = wrong.select(key, F.explode(F.array_compact(F.array("g_type", "p_type"))).alias("type")).distinct()
    hashed = types.withColumn("h", F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))))
    first = hashed.withColumn("r", F.row_number().over(Window.partitionBy("type").orderBy("h", key))).where(F.col("r") <= least)
    must = first.select(key).distinct().withColumn("must", F.lit(1))
    docs = hashed.select(key, "h").distinct().join(must, key, "left").withColumn("must", F.coalesce("must", F.lit(0)))
    # the least hash that is still taken: two numbers reach the driver
    total, sure = docs.agg(F.count("*"), F.sum("must")).first()
    more = max(1, round(total * ratio)) - (sure or 0)
    if more <= 0:
        return docs.where("must = 1").select(key)
    filled = docs.where("must = 0").orderBy("h", key).limit(more)
    return docs.where("must = 1").select(key).unionByName(filled.select(key))


def review_records(rows: DataFrame, docs: DataFrame, chosen: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per error of the chosen documents, with blank columns for the reviewer."""
    wrong = rows.where("class <> 'EXACT'").join(chosen.select(key), key, "left_semi").join(docs.select(key, "text"), key)
    sides_ = F.explode(F.array_compact(F.array(F.when(F.col("g_type").isNotNull(), F.lit("fn")), F.when(F.col("p_type").isNotNull(), F.lit("fp"))))).alias("side")
    blanks = [F.lit("").alias("verdict"), F.lit("").alias("corrected_label"), F.lit(None).cast("long").alias("corrected_start"), F.lit(None).cast("long").alias("corrected_end"), F.lit("").alias("note")]
    return wrong.select(key, "text", sides_, "class", *[f"{s}_{c}" for s in "gp" for c in ("start", "end", "type")], *blanks)


def same_documents(gold: DataFrame, pred: DataFrame, key: str = "doc_id") -> None:
    """Raise unless both tables list the same documents."""
    a, b = gold.select(F.col(key).alias("k"), F.lit(1).alias("a")).distinct(), pred.select(F.col(key).alias("k"), F.lit(1).alias("b")).distinct()
    lost, extra = a.join(b, "k", "full").agg(F.count_if(F.col("b").isNull()), F.count_if(F.col("a").isNull())).first()
    if lost or extra:
        raise ValueError(f"documents differ: {lost} without predictions, {extra} without gold")


def text_match_relaxed(gold: DataFrame, pred: DataFrame, key: str = "doc_id") -> DataFrame:
    """Agreement by containment of surfaces without spaces, one to one, per type."""
    return rated(matching.containment_counts(gold, pred, key))


def text_match_exact(gold: DataFrame, pred: DataFrame, key: str = "doc_id") -> DataFrame:
    """Multiset agreement of (document, surface without spaces, type)."""
    norm = plain_surface(F.col("surface")).alias("surface")
    side = lambda df, g, p: df.select(key, norm, "type", F.lit(g).alias("g"), F.lit(p).alias("p"))
    counts = side(gold, 1, 0).unionByName(side(pred, 0, 1)).groupBy(key, "surface", "type").agg(F.sum("g").alias("g"), F.sum("p").alias("p"))
    return rated(counts.groupBy("type").agg(F.sum(F.least("g", "p")).alias("tp"), F.sum("p").alias("n_pred"), F.sum("g").alias("n_gold")))


def at_thresholds(gold: DataFrame, pred: DataFrame, cuts: dict[str, float]) -> DataFrame:
    """Strict scores of the predictions that reach their type's cut; types without a cut and spans without a score stay."""
    return strict(gold, apply_thresholds(pred, cuts))


def apply_thresholds(pred: DataFrame, cuts: dict[str, float]) -> DataFrame:
    if not cuts:
        return pred
    least = F.try_element_at(F.create_map(*[F.lit(x) for kv in cuts.items() for x in kv]), F.col("type"))
    return pred.where(least.isNull() | F.col("score").isNull() | (F.col("score") >= least))


def best_scores(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """Distinct predicted spans with their best score (1 where there is none) and whether they are gold."""
    span = ["doc_id", "start", "end", "type"]
    best = pred.groupBy(*span).agg(F.max(F.coalesce("score", F.lit(1.0))).alias("score"))
    return best.join(gold.select(*span, F.lit(True).alias("hit")).distinct(), span, "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def fit_thresholds(gold: DataFrame, pred: DataFrame, target: float = 0.93, sweeps: int = 6) -> dict[str, float]:
    """Coordinate ascent over at most 121 candidate cuts per type, on the driver.

    Spans are counted by type and score; each count falls between two candidates,
    so what is collected has one row per (type, candidate), whatever the data's size.
    """
    spark = pred.sparkSession
    counts = best_scores(gold, pred).groupBy("type", "score").agg(F.count("*").alias("n"), F.count_if("hit").alias("tp"))
    ranks = [0.98 * i / 119 for i in range(120)]
    cand = counts.groupBy("type").agg(F.percentile("score", F.array(*[F.lit(q) for q in ranks]), F.col("n")).alias("q")).collect()
    cuts = {r["type"]: sorted({0.0, *r["q"]}) for r in cand}
    table = {t: [(0, 0)] * len(c) for t, c in cuts.items()}
    if cuts:
        levels = spark.createDataFrame([(t, [float(c) for c in cs]) for t, cs in cuts.items()], "type string, cuts array<double>")
        place = F.size(F.filter("cuts", lambda c: c <= F.col("score"))) - 1
        for t, i, n, tp in counts.join(F.broadcast(levels), "type").groupBy("type", place.alias("i")).agg(F.sum("n"), F.sum("tp")).collect():
            if i >= 0:
                table[t][i] = (n, tp)
        for t, rows in table.items():  # from counts between two cuts to counts at or over each
            for i in range(len(rows) - 2, -1, -1):
                table[t][i] = (rows[i][0] + rows[i + 1][0], rows[i][1] + rows[i + 1][1])
    total = gold.select("doc_id", "start", "end", "type").distinct().count()

    def value(choice: dict[str, int]) -> float:
        n, tp = (sum(table[t][i][k] for t, i in choice.items()) for k in (0, 1))
        p, r = tp / n if n else 0.0, tp / total if total else 0.0
        f = 2 * p * r / (p + r) if p + r else 0.0
        return f - 100 * max(0.0, target - p) - 100 * max(0.0, target - r)

    choice = {t: 0 for t in sorted(cuts)}
    best = value(choice)
    for _ in range(sweeps):
        before = best
        for t in choice:
            for i in range(len(cuts[t])):
                if (v := value(choice | {t: i})) > best:
                    best, choice = v, choice | {t: i}
        if best == before:
            break
    return {t: cuts[t][i] for t, i in choice.items()}
