"""Mentions of a dictionary in texts, their coverage by labels, ledgers of judged places."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.files import table
from .spans import touching

#: fixed values: characters that join a word, and what may follow a Korean surface or makes another word of it
WORD = "[가-힣A-Za-z0-9]"
PARTICLES = """으로서 으로써 이라는 이라고 에서는 에서도 에게서 으로는 으로도 이라며 이라도 이었 이라 라고 라는 라며 에서 에게 에는 에도 에만 까지 부터 처럼
보다 조차 마저 밖에 대로 같이 이랑 이며 으로 이나 이란 은 는 이 가 을 를 에 와 과 의 로 만 도 랑 뿐 인 며 나 란""".split()
SUFFIXES = "장실석자단문록비후중때날용차"
KEY = 4  #: characters of a surface that route it
BEFORE, AFTER = 5, 12  #: characters around a place that decide
SLOTS = 1 << 20  #: of the filter before the join, at every size


def mentions(toks: DataFrame, surfaces: DataFrame, key: str = "doc_id") -> DataFrame:
    """Tokens equal to a surface of the dictionary: an equi-join, whatever the dictionary's size."""
    return toks.join(surfaces.select(F.col("surface").alias("word")).distinct(), "word").select(key, F.col("start"), (F.col("start") + F.length("word")).alias("end"), F.col("word").alias("surface"))


def bounded(before: Column, rest: Column) -> Column:
    """Whether a surface ends where a word ends, or a Korean particle follows that is no derivational suffix."""
    particle = rest.rlike(f"^(?![{SUFFIXES}])(?:{'|'.join(PARTICLES)})")
    return (rest == "") | rest.rlike(r"(?s)^[^\p{L}\p{N}]") | particle


def mentions_anywhere(docs: DataFrame, surfaces: DataFrame, key: str = "doc_id", rule: Callable[[Column, Column], Column] | None = bounded) -> DataFrame:
    """Every occurrence of a surface in the whole text, overlapping ones and surfaces of several words too.

    With a ``rule`` no Hangul, Latin letter or digit may stand before it, and the
    rule decides on the ``BEFORE`` characters before it and the ``AFTER`` behind it;
    without one every place counts.  Places that may begin a mention meet the
    dictionary by an equi-join on the first characters; a table of their checksums
    holds back most others before.  The rows have what stands before and after.
    """
    # the dictionary is used again and again, so it is made once; a surface shorter than the key is met by its own length
    s = table(surfaces.select("surface").where("surface <> ''").distinct().withColumn("head", F.substring("surface", 1, KEY)))
    kind = dict(docs.dtypes)[key]
    # KEY sizes and SLOTS numbers at most
    most, sizes, slots = s.agg(F.max(F.length("surface")), F.array_sort(F.collect_set(F.length("head"))), F.collect_set((F.crc32("head") % SLOTS).cast("int"))).first()
    if most is None:
        return docs.sparkSession.createDataFrame([], f"`{key}` {kind}, start long, end long, surface string, before string, rest string")
    marks = bytearray(SLOTS)
    for m in slots:
        marks[m] = 1
    marks, begins, width = bytes(marks), re.compile(rf"(?<!{WORD})(?=.)" if rule else r"(?=.)", re.DOTALL), most + AFTER

    def places(batches):
        for batch in batches:
            for i, text in enumerate(batch.column(1).to_pylist()):
                spots = ((m.start(), text[m.start() : m.start() + n]) for m in begins.finditer(text) for n in sizes if m.start() + n <= len(text))
                at = [(p, head) for p, head in spots if marks[zlib.crc32(head.encode()) % SLOTS]]
                for a in range(0, len(at), 1 << 14):  # bounded, however long the text
                    some = at[a : a + (1 << 14)]
                    ids = batch.column(0).take(pa.array([i] * len(some), pa.int64()))
                    yield pa.RecordBatch.from_arrays([ids, pa.array([p for p, _ in some], pa.int64()), pa.array([h for _, h in some], pa.string()), pa.array([text[p : p + width] for p, _ in some], pa.string()), pa.array([text[max(0, p - BEFORE) : p] for p, _ in some], pa.string())], [key, "start", "head", "seg", "before"])

    found = docs.select(key, "text").where("text is not null").mapInArrow(places, f"`{key}` {kind}, start long, head string, seg string, before string")
    met = found.join(s, "head").where(F.startswith("seg", F.col("surface")))
    rest = F.substr("seg", F.length("surface") + 1)
    rows = met.select(key, "start", (F.col("start") + F.length("surface")).alias("end"), "surface", "before", F.substr(rest, F.lit(1), F.lit(AFTER)).alias("rest"))
    return rows.where(rule(F.col("before"), F.col("rest"))) if rule else rows


def uncovered(found: DataFrame, spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """Mentions (key, start, end, ...) that no labelled span overlaps."""
    s = spans.select(F.col(key).alias("k"), F.col("start").alias("s"), F.col("end").alias("e"))
    sites = found.select(key, "start", F.col("end").alias("stop")).distinct()
    taken = touching(sites, s, key).select(key, "start", F.col("stop").alias("end")).distinct()
    return found.join(taken, [key, "start", "end"], "left_anti").select(*found.columns)


def exclude_judged(found: DataFrame, ledger: DataFrame, key: str = "doc_id") -> DataFrame:
    """Without the sites that the ledger judged not to count; entries without a site are passed over."""
    sites = ledger.where("start is not null and end is not null and verdict = 'NOT'").select(key, "start", "end").distinct()
    return found.join(sites, [key, "start", "end"], "left_anti")


def trim_targets(docs: DataFrame, spans: DataFrame, others: DataFrame, key: str = "doc_id", least: int = 3) -> DataFrame:
    """Spans that a longer surface of the same kind encloses in the text, with that place (new_start, new_end).

    Surfaces are those of ``spans`` with at least ``least`` characters; the longest
    counts, then the leftmost.  Where it overlaps one of the ``others``, there is no target.
    """
    longer = spans.select("surface").distinct().where(F.length("surface") >= least)
    texts = docs.join(spans.select(key).distinct(), key, "left_semi")
    places = mentions_anywhere(texts, longer, key, rule=None).select(F.col(key).alias("k"), F.col("start").alias("s"), F.col("end").alias("e"), F.col("surface").alias("target"))
    sites = spans.select(key, "start", F.col("end").alias("stop"), "surface").distinct()
    inside = touching(sites, places, key).where((F.col("s") <= F.col("start")) & (F.col("stop") <= F.col("e")) & (F.length("target") > F.length("surface")) & F.contains("target", F.col("surface")))
    best = inside.withColumn("r", F.row_number().over(Window.partitionBy(key, "start", "stop", "surface").orderBy(F.desc(F.length("target")), "s", "target"))).where("r = 1")
    best = best.select(key, "start", F.col("stop").alias("end"), "surface", "target", F.col("s").alias("new_start"), F.col("e").alias("new_end"))
    wide = best.select(key, F.col("new_start").alias("start"), F.col("new_end").alias("stop")).distinct()
    clash = touching(wide, others.select(F.col(key).alias("k"), F.col("start").alias("s"), F.col("end").alias("e")), key).select(key, F.col("start").alias("new_start"), F.col("stop").alias("new_end")).distinct()
    return best.join(clash, [key, "new_start", "new_end"], "left_anti").select(*best.columns)
