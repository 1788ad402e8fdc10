"""Quality classifier by importance resampling.

Two generative models over hashed byte n-grams and word-pair classes: the target
model is counted on good labelled documents (a bounded sample), the raw model on
all documents.  A document's log weight is the log ratio of the two models for its
whole text: the sum of its n-grams' log ratios, less a calibrated ratio of their
length models (the same for every n-gram).  Gumbel top-k takes k documents without
replacement in proportion to the weights: a document's key is its log weight plus
a Gumbel draw, and the k largest keys are taken, where k is the number of documents
of weight 1 or more.  The draw decides among documents near that weight; short texts
are near it.

Counts cover all documents; what reaches the driver is two vectors of
``BUCKETS`` values, the held-out labels' weights, and a few histograms of fixed size.
Defined cases: a null or empty text has no n-grams and weight ``-inf`` and is
rejected; an empty table gives none; without good or without bad labels every
document with n-grams is kept; documents equal in key at the cut are all kept;
repeated rows each give a row, of the same draw; of repeated labels the smallest
counts.  Very long texts count whole.  Other columns are not looked at, whatever
their names; a null doc_id is drawn for as a value of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import Words, bounded_batches, map_texts, mix, slices, texts_of
from .shared import cut as cut_lineage

BUCKETS = 1 << 14
SIZES = (3,)  #: bytes per n-gram
SAMPLE_ROWS = 20_000  #: labelled rows used for the target model and the cut, at most
SCHEMA = "doc_id long, n_grams long, log_ratio double"


def gram_buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams that stay within one text, and the text of each."""
    words = Words(texts)
    starts, buf = words.text_start, words.buf
    ends = np.r_[starts[1:], len(buf)] - 1  # a separator byte closes each text
    out, of = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    wide = buf.astype(np.uint64)
    for n in SIZES:
        count = np.maximum(0, ends - starts - n + 1)
        at = np.arange(int(count.sum())) + np.repeat(starts - np.r_[0, np.cumsum(count)[:-1]], count)
        key = np.zeros(max(0, len(buf) - n + 1), np.uint64)
        for k in range(n):
            key = key << np.uint64(8) | wide[k : k + len(key)]
        out.append((mix(key + np.uint64(n << 40)) >> np.uint64(50)).astype(np.int32)[at])
        of.append(np.repeat(np.arange(len(starts), dtype=np.int32), count))
    # word pairs count by whether both are equal: repetition looks alike for every word
    hashed = words.hashes()
    pair = np.flatnonzero(words.text_of[1:] == words.text_of[:-1])
    out.append((hashed[pair] == hashed[pair + 1]).astype(np.int32))
    of.append(words.text_of[pair].astype(np.int32))
    return np.concatenate(out), np.concatenate(of)


def labelled(labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """A bounded sample of labels: id, quality, and which half it is in (0 fits the model, 1 sets the cut)."""
    return (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").cast("int").alias("_y"))
        .orderBy(F.xxhash64("_id"), "_id").limit(rows)
        .withColumn("_half", F.pmod(F.xxhash64("_id", F.lit("half")), F.lit(2)).cast("int"))
    )


def models(docs: DataFrame, sample: DataFrame) -> np.ndarray | None:
    """Log ratio of target and raw model for each bucket."""
    spark = docs.sparkSession
    good = F.broadcast(sample.where("_y = 1 and _half = 0").select("_id", F.lit(1).alias("_good")))
    marked = docs.select("doc_id", "text").join(good, docs["doc_id"] == good["_id"], "left").select("_good", "text")
    bounded_batches(spark)

    def count(batches):
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            marks, texts = np.array([m == 1 for m in batch.column(0).to_pylist()], bool), texts_of(batch.column(1))
            for a, b in slices([len(t) for t in texts]):
                key, of = gram_buckets(texts[a:b])
                raw += np.bincount(key, minlength=BUCKETS)
                if marks[a:b].any():
                    target += np.bincount(key[marks[a:b][of]], minlength=BUCKETS)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])], ["bucket", "raw", "target"])

    got = marked.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for bucket, r, t in got:
        raw[bucket] += r
        target[bucket] += t
    if target.sum() <= BUCKETS:
        return None
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weights(docs: DataFrame, ratio: np.ndarray | None) -> DataFrame:
    """One row per document with the log ratio of the models for its n-grams."""
    table = np.zeros(BUCKETS) if ratio is None else ratio

    def work(rows: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        key, of = gram_buckets(texts)
        n = np.bincount(of, minlength=len(texts))
        total = np.bincount(of, weights=table[key], minlength=len(texts))
        total = np.where(n > 0, total, -np.inf)
        return pa.RecordBatch.from_arrays([rows.column(0), pa.array(n.astype(np.int64)), pa.array(total)], ["doc_id", "n_grams", "log_ratio"])

    return map_texts(docs, work, SCHEMA)


def best_cut(pairs: list[tuple[float, int]], good_cost: float = 10.0) -> float:
    """The mean ratio over which documents count as good; losing a good one costs ``good_cost`` times keeping a bad one."""
    pairs = sorted((w, y) for w, y in pairs if np.isfinite(w))
    bad, good = sum(1 - y for _, y in pairs), sum(y for _, y in pairs)
    if not bad or not good:
        return -np.inf
    cost = best = bad / bad  # everything kept
    cut, lo = -np.inf, 0.0
    for i, (w, y) in enumerate(pairs):
        cost += good_cost * y / good - (1 - y) / bad
        if cost < best - 1e-12 and i + 1 < len(pairs) and pairs[i + 1][0] > w:
            best, cut, lo = cost, (w + pairs[i + 1][0]) / 2, w
    return cut


def kth_largest(keys: DataFrame, column: str, k: int, lo: float, hi: float, bins: int = 4096, rounds: int = 8) -> float:
    """A value with exactly k keys at or over it (more only where keys are equal), by histograms of fixed size."""
    at = keys.select(F.col(column).alias("x")).where(F.col("x").isNotNull())
    need = k
    for _ in range(rounds):
        width = (hi - lo) / bins
        if not width > 0 or lo + width == lo:
            return lo
        slot = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor((F.col("x") - F.lit(lo)) / F.lit(width)).cast("int")))
        inside = at.where(F.col("x").between(lo, hi))
        hist = {r[0]: tuple(r[1:]) for r in inside.groupBy(slot.alias("s")).agg(F.count("*"), F.min("x"), F.max("x")).collect()}
        for s in sorted(hist, reverse=True):
            n, least, most = hist[s]
            if need <= n:
                if need == n:
                    return least
                lo, hi = least, most
                break
            need -= n
    return lo


def gumbel(key: str, seed: int):
    """A Gumbel draw that follows from the document's id."""
    unit = (F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(-F.log(unit))


def top_k(scored: DataFrame, seed: int = 1) -> DataFrame:
    """``scored`` (doc_id, n_grams, log_weight) with the Gumbel key and whether it is among the k largest, k being the number of weights of 1 or more."""
    keyed = cut_lineage(scored.withColumn("gumbel_key", F.when(F.col("n_grams") > 0, F.col("log_weight") + gumbel("doc_id", seed))))
    k, lo, hi = keyed.where(F.col("n_grams") > 0).agg(F.count_if(F.col("log_weight") >= 0), F.min("gumbel_key"), F.max("gumbel_key")).first()
    least = kth_largest(keyed, "gumbel_key", k, lo, hi) if k else float("inf")
    return keyed.withColumn("kept", F.coalesce(F.col("gumbel_key") >= F.lit(least), F.lit(False)))


def classify(docs: DataFrame, labels: DataFrame, seed: int = 1, rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: n-grams, log ratio, log weight, Gumbel key, and whether it is among the k taken."""
    docs = docs.select("doc_id", "text")
    sample = labelled(labels.select("doc_id", "quality"), rows)
    ratio = models(docs, sample)
    scored = cut_lineage(weights(docs, ratio))
    per_gram = None
    if ratio is not None:
        held = F.broadcast(sample.where("_half = 1").select("_id", "_y"))
        pairs = scored.join(held, scored["doc_id"] == held["_id"]).where("n_grams > 0").select(F.col("log_ratio") / F.col("n_grams"), "_y").collect()
        per_gram = best_cut([(r[0], r[1]) for r in pairs])
    # without a cut nothing is known against any document
    weight = F.col("log_ratio") - F.col("n_grams") * F.lit(float(per_gram)) if per_gram is not None and np.isfinite(per_gram) else F.lit(0.0)
    scored = scored.withColumn("log_weight", F.when(F.col("n_grams") > 0, weight).otherwise(F.lit(float("-inf"))))
    return top_k(scored, seed)
