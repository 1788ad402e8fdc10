"""Span tables: one row per span with a document key, start, end (exclusive) and type."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

#: code points of white space, and of the marks that a span does not end with
BLANK = np.array([*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], np.uint32)
STOPS = np.array([*b".,"], np.uint32)


def tokens(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Tokens between single spaces, with their number and start; null texts have none.

    A token's place follows from the lengths before it in its own row, so whole
    Arrow batches are split and summed at once and nothing is shuffled.
    """
    names = [f"`{c}`" for c in docs.columns if c != "text"]
    rows = docs.select(*names, "text").where("text is not null")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")

    def split(batches):
        for batch in batches:
            words = pc.split_pattern(batch.column(len(names)), " ")
            of, flat = pc.list_parent_indices(words), pc.list_flatten(words)
            size = pc.utf8_length(flat).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            first = np.cumsum(np.bincount(of.to_numpy(), minlength=len(batch))) - np.bincount(of.to_numpy(), minlength=len(batch))
            at, before = of.to_numpy(), np.cumsum(size) - size
            begin = first[at]
            columns = [batch.column(i).take(of) for i in range(len(names))]
            places = [pa.array((np.arange(len(at)) - begin).astype(np.int32)), flat.cast(pa.string()), pa.array(before - before[begin])]
            yield pa.RecordBatch.from_arrays(columns + places, [n.strip("`") for n in names] + ["tok", "word", "start"])

    return rows.mapInArrow(split, f"{kinds}, tok int, word string, start long")


def slices(batch: pa.RecordBatch, column: int, size: int = 1 << 20):
    """A batch in parts whose texts hold about ``size`` bytes, one row at least, so that arrays over their characters stay small."""
    part = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64)) // size
    cuts = [*np.flatnonzero(np.diff(part, prepend=-1)), len(batch)]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def laid_out(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Texts end to end: their code points, where each begins and its length; then the tokens between single spaces: whose, number, start and end in the text."""
    points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), "<u4")
    size = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    base = np.cumsum(size) - size
    gaps = np.flatnonzero(points == 32)
    many = np.searchsorted(gaps, base + size) - np.searchsorted(gaps, base) + 1
    of, first = np.repeat(np.arange(len(size)), many), np.cumsum(many) - many
    start, end = np.empty(len(of), np.int64), np.empty(len(of), np.int64)
    opens, closes = np.ones(len(of), bool), np.ones(len(of), bool)
    opens[first], closes[first + many - 1] = False, False
    start[first], start[opens] = base, gaps + 1
    end[first + many - 1], end[closes] = base + size, gaps
    return points, base, size, of, np.arange(len(of)) - first[of], start - base[of], end - base[of]


def trimmed_tokens(docs: DataFrame, moved: Callable, key: str = "doc_id") -> DataFrame:
    """Tokens between single spaces (key, tok, start, end) whose places ``moved`` changes and which are then trimmed as by ``text.trimmed``.

    ``moved`` takes numpy arrays of the tokens' numbers, starts, ends and the
    lengths of their texts and gives their starts and ends.  Texts are looked up as
    arrays of code points, so a token costs the same wherever it stands, and
    nothing is shuffled; null texts have none.
    """

    def trim(batches):
        for batch in batches:
            for rows in slices(batch, 1):
                points, base, size, of, tok, start, end = laid_out(rows.column(1))
                start, end = moved(tok, start, end, size[of])
                blank = np.isin(points, BLANK)
                n, at = len(points), np.arange(len(points))
                ahead = np.append(np.minimum.accumulate(np.where(blank, n, at)[::-1])[::-1], n)  # the next character that is not blank
                behind = np.append(0, np.maximum.accumulate(np.where(blank | np.isin(points, STOPS), 0, at + 1)))  # the end of the last one that stays
                a, b = start + base[of], end + base[of]
                first = np.minimum(ahead[a], b)
                last = np.maximum(behind[b], first)
                left = last > first
                columns = [rows.column(0).take(pa.array(of)), pa.array(tok.astype(np.int32)), pa.array(np.where(left, first - base[of], start)), pa.array(np.where(left, last - base[of], end))]
                yield pa.RecordBatch.from_arrays(columns, [key, "tok", "start", "end"])

    return docs.select(key, "text").where("text is not null").mapInArrow(trim, f"`{key}` {dict(docs.dtypes)[key]}, tok int, start long, end long")


def pieces(docs: DataFrame, pattern: str, key: str = "doc_id") -> DataFrame:
    """Matches of a pattern in whole texts: the key, their number, start, end and text; null texts have none."""
    import re

    find, kind = re.compile(pattern).finditer, dict(docs.dtypes)[key]

    def run(batches):
        for batch in batches:
            for i, text in enumerate(batch.column(1).to_pylist()):
                found = [(*m.span(), m[0]) for m in find(text)]
                for a in range(0, len(found), 1 << 14):  # bounded, however long the text
                    some = found[a : a + (1 << 14)]
                    ids = batch.column(0).take(pa.array([i] * len(some), pa.int64()))
                    start, end, words = zip(*some)
                    yield pa.RecordBatch.from_arrays([ids, pa.array(range(a, a + len(some)), pa.int64()), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(words, pa.string())], [key, "tok", "start", "end", "word"])

    return docs.select(key, "text").where("text is not null").mapInArrow(run, f"`{key}` {kind}, tok long, start long, end long, word string")


def context_words(docs: DataFrame, spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """Words with a letter or digit that begin in no span, per document (0 where there are none)."""
    words = pieces(docs, r"\S+", key).where(F.col("word").rlike(r"[\p{L}\p{N}]"))
    s = spans.select(F.col(key).alias("k"), F.col("start").alias("s"), F.col("end").alias("e"))
    inside = touching(words.select(key, "tok", "start", (F.col("start") + 1).alias("stop")), s, key).select(key, "tok").distinct()
    n = words.join(inside, [key, "tok"], "left_anti").groupBy(key).agg(F.count("*").alias("n_context"))
    return docs.select(key).distinct().join(n, key, "left").select(key, F.coalesce("n_context", F.lit(0).cast("long")).alias("n_context"))


WIDTH = 64  #: characters of the stretches by which spans and tokens meet


def touching(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join of ``left`` (key, start, stop) with ``right`` (k, s, e) where both share a character.

    Both are dealt by document and stretch of text, so a document is never met with itself
    span by span; the stretch where the overlap begins gives the pair, once.
    """
    spread = lambda a, b: F.explode(F.sequence(F.floor(a / WIDTH), F.floor((F.greatest(b, a + 1) - 1) / WIDTH)))
    x = left.withColumn("_at", spread(F.col("start"), F.col("stop")))
    y = right.withColumn("_in", spread(F.col("s"), F.col("e")))
    met = x.join(y, (x[key] == y["k"]) & (x["_at"] == y["_in"]) & (F.col("start") < F.col("e")) & (F.col("s") < F.col("stop")))
    return met.where(F.floor(F.greatest("start", "s") / WIDTH) == F.col("_at")).drop("_at", "_in")


def overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return (s1 < e2) & (s2 < e1)


def pair_class(gold: str = "g", pred: str = "p") -> Column:
    """Category of a gold and a predicted span: EXACT, BOUNDARY, TYPE_MISMATCH or UNRELATED."""
    g, p = (lambda c: F.col(f"{gold}_{c}")), (lambda c: F.col(f"{pred}_{c}"))
    same, touch = g("type") == p("type"), overlap(g("start"), g("end"), p("start"), p("end"))
    exact = same & (g("start") == p("start")) & (g("end") == p("end"))
    return F.when(exact, "EXACT").when(same & touch, "BOUNDARY").when(touch, "TYPE_MISMATCH").otherwise("UNRELATED")


def bio_encode(toks: DataFrame, spans: DataFrame, key: str = "doc_id", inside: bool = False) -> DataFrame:
    """Tokens with B-/I-/O tags: a token that shares a character with a span takes its type, the earliest span wins.

    With ``inside`` the whole token must lie in the span, as sub-word labels need it.
    """
    s = spans.select(F.col(key).alias("k"), F.col("start").alias("s"), F.col("end").alias("e"), "type")
    t = toks.withColumn("stop", F.col("start") + F.length("word"))
    met = touching(t.where(F.length("word") > 0).select(key, "tok", "start", "stop"), s, key)
    if inside:
        met = met.where("s <= start and stop <= e")
    found = met.groupBy(key, "tok").agg(F.min(F.struct("s", "e", "type")).alias("span"))
    joined = t.join(found, [key, "tok"], "left").select(*t.columns, "span")
    again = F.lag("span").over(Window.partitionBy(key).orderBy("tok"))
    tag = F.when(F.col("span.s").isNull(), "O").when(again.eqNullSafe(F.col("span")), F.concat(F.lit("I-"), F.col("span.type"))).otherwise(F.concat(F.lit("B-"), F.col("span.type")))
    return joined.withColumn("tag", tag).drop("span")


def bio_decode(tagged: DataFrame, key: str = "doc_id", drop_orphans: bool = False) -> DataFrame:
    """Spans of tag runs by gaps and islands; an orphan I- opens a span unless dropped."""
    w = Window.partitionBy(key).orderBy("tok")
    t = tagged.withColumn("kind", F.substring("tag", 1, 1)).withColumn("type", F.expr("substring(tag, 3)"))
    follows = (F.lag("kind").over(w) != "O") & (F.lag("type").over(w) == F.col("type"))
    opens = (F.col("kind") != "O") & ((F.col("kind") == "B") | ~F.coalesce(follows, F.lit(False)))
    t = t.withColumn("opens", opens.cast("int")).withColumn("run", F.sum("opens").over(w))
    runs = t.where("kind <> 'O'").groupBy(key, "run").agg(F.min("start").alias("start"), F.max("stop").alias("end"), F.min_by("type", "tok").alias("type"), F.min_by("kind", "tok").alias("kind"))
    return (runs.where("kind = 'B'") if drop_orphans else runs).select(key, "start", "end", "type")


def repair_bio(tagged: DataFrame, key: str = "doc_id") -> DataFrame:
    """A B- right after the same type becomes I-."""
    w = Window.partitionBy(key).orderBy("tok")
    last = F.expr("substring(prev, 3)")
    out = tagged.withColumn("prev", F.lag("tag").over(w))
    same = F.col("tag").startswith("B-") & (F.col("prev") != "O") & (last == F.expr("substring(tag, 3)"))
    return out.withColumn("tag", F.when(same, F.concat(F.lit("I-"), last)).otherwise(F.col("tag"))).drop("prev")


def mask(text: Column, spans: Column, nonce: str) -> Column:
    """The text with sorted, disjoint spans (s, e) replaced by numbered sentinels."""
    state = F.struct(F.lit(0).alias("at"), F.lit(0).alias("n"), F.lit("").alias("out"))

    def step(a: Column, x: Column) -> Column:
        piece = F.substr(text, a["at"] + 1, x["s"] - a["at"])
        return F.struct(x["e"].alias("at"), (a["n"] + 1).alias("n"), F.concat(a["out"], piece, F.lit(f"【PII{nonce}_"), a["n"].cast("string"), F.lit("】")).alias("out"))

    return F.aggregate(spans, state, step, lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1, F.length(text))))


def masked_value(text: Column, spans: Column, nonce: str) -> Column:
    """``mask`` of sorted spans; raises where one lies outside the text or begins before the last one ends."""
    outside = F.exists(spans, lambda x: (x["s"] < 0) | (x["s"] >= x["e"]) | (x["e"] > F.length(text)))
    crossed = F.exists(spans, lambda x: F.exists(spans, lambda y: (x["s"] < y["s"]) & (y["s"] < x["e"]))) | (F.size(F.array_distinct(F.transform(spans, lambda x: x["s"]))) < F.size(spans))
    wrong = F.when(outside, F.raise_error(F.lit("a span lies outside the text")).cast("string")).when(crossed, F.raise_error(F.lit("spans overlap")).cast("string"))
    return F.when(outside | crossed, wrong).otherwise(mask(text, spans, nonce))


def restore(masked: Column, values: Column, nonce: str) -> Column:
    """Sentinels back to their values (array in order); unknown sentinels of this nonce go."""
    return restored(masked, values, nonce)["text"]


def restored(masked: Column, values: Column, nonce: str) -> Column:
    """Struct (text, n): ``restore``, and how many values the text held a sentinel of."""
    sign = lambda i: F.concat(F.lit(f"【PII{nonce}_"), i.cast("string"), F.lit("】"))
    pairs = F.transform(values, lambda v, i: F.struct(i.alias("i"), v.alias("v")))
    state = F.struct(masked.alias("text"), F.lit(0).alias("n"))
    full = F.aggregate(pairs, state, lambda a, x: F.struct(F.replace(a["text"], sign(x["i"]), x["v"]).alias("text"), (a["n"] + F.contains(a["text"], sign(x["i"])).cast("int")).alias("n")))
    return F.struct(F.regexp_replace(full["text"], f"【PII{nonce}_[0-9]+】", "").alias("text"), full["n"].alias("n"))
