"""Substring dedup by super-k-mers.

A window is ``K`` consecutive words.  Consecutive windows of a document that
share their minimiser (the smallest hash of an ``M``-word gram inside) travel as
one packed string to the minimiser's bucket.  There all windows are sorted;
each window but the first of its word sequence is a repeat.  Words under a
repeat go; windows are judged on the input.

Skew: equal packed strings of one input slice meet before the shuffle, so a
passage in a third of all rows reaches its bucket once per slice; grams that a
sample of documents shows to be very frequent come last in the minimiser order
(at most ``1 / HOT_SHARE`` of them), so a frequent line does not gather its
contexts in one bucket.  The sample changes only routes, never results.  Words
are compared by 128-bit fingerprints.

Defined cases: a null or empty text has no words and keeps the empty string;
texts under ``K`` words keep all; a null doc_id counts as the smallest; rows
equal in doc_id and text are one document and get the same result, rows equal in
doc_id alone are ordered by a hash of the text.  Other columns pass unchanged.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import Words, bounded_batches, mix, slices, texts_of
from .bpe import _pack, _unpack

K, M = 20, 3
SLICE = 4 << 20
SUB_BUCKETS = 8  #: for each shuffle partition
HOT_SHARE, SAMPLE_DIVISOR = 1 / 2000, 64
B1, B2 = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1
WORD = re.compile(rb"[^\x20\x09-\x0d]+")
_TABLES: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _TABLES.get(base)
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            have = _TABLES[base] = np.cumprod(np.r_[np.uint64(1), np.full(max(n, 1 << 16), base, np.uint64)], dtype=np.uint64)
    return have


def run_hashes(hashed: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hashes of the word runs [begin, end)."""
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        total = np.r_[np.uint64(0), np.cumsum(hashed * _power(base, len(hashed))[: len(hashed)], dtype=np.uint64)]
        return (total[end] - total[begin]) * _power(inverse, len(hashed))[begin]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def super_kmers(words: Words, h1: np.ndarray, hot: np.ndarray, k: int = K, m: int = M):
    """Start word, end word and minimiser of the runs of windows that share a minimiser."""
    n = len(h1)
    none = np.zeros(0, np.int64)
    if n < k:
        return none, none, np.zeros(0, np.uint64)
    at = np.arange(n - m + 1)
    gram = mix(run_hashes(h1, at, at + m, B1)) >> np.uint64(1)
    if len(hot):
        where = np.minimum(np.searchsorted(hot, gram), len(hot) - 1)
        gram = gram | ((hot[where] == gram).astype(np.uint64) << np.uint64(63))
    least = sliding_min(gram, k - m + 1)
    whole = words.text_of[: n - k + 1] == words.text_of[k - 1 :]
    new = whole & np.r_[True, (least[1:] != least[:-1]) | ~whole[:-1] | (words.text_of[1 : len(least)] != words.text_of[: len(least) - 1])]
    begin = np.flatnonzero(new)
    if not len(begin):
        return none, none, np.zeros(0, np.uint64)
    many = np.add.reduceat(whole.astype(np.int64), begin)
    return begin, begin + many + k - 1, least[begin]


def hot_grams(docs: DataFrame) -> np.ndarray:
    """Minimisers of more than ``HOT_SHARE`` of the runs in a sample of documents; sorted, bounded in number."""
    def count(batches):
        for batch in batches:
            texts = texts_of(batch.column(0))
            for a, b in slices([len(t) for t in texts]):
                words = Words(texts[a:b])
                _, _, least = super_kmers(words, words.hashes(1), np.zeros(0, np.uint64))
                value, many = np.unique(least, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(many)], ["gram", "n"])

    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_DIVISOR)) == 0)
    grams = sample.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).where("n >= 8")
    top = grams.orderBy(F.desc("n"), "gram").limit(int(1 / HOT_SHARE)).collect()
    total = sum(r[1] for r in top)
    return np.sort(np.array([r[0] for r in top if r[1] > total * HOT_SHARE], np.int64).view(np.uint64))


def repeats(docs: DataFrame, k: int = K, m: int = M) -> DataFrame:
    """Rows (doc_id, text_hash, first, last): runs of words under windows that also start earlier."""
    spark = docs.sparkSession
    bounded_batches(spark)
    partitions = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = partitions * SUB_BUCKETS
    hot = hot_grams(docs)
    keyed = docs.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), F.xxhash64("text").alias("th"), "text")
    out_names = ["bucket", "blob"]

    def cut_up(batches):
        for batch in batches:
            ids, ths = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            texts = texts_of(batch.column(2))
            for a, b in slices([len(t) for t in texts], SLICE):
                words = Words(texts[a:b])
                h1, h2 = words.hashes(1), words.hashes(2)
                begin, end, least = super_kmers(words, h1, hot, k, m)
                if not len(begin):
                    continue
                text = words.text_of[begin]
                doc, th, start = ids[a:b][text], ths[a:b][text], begin - words.first[text]
                f1, f2 = run_hashes(h1, begin, end, B1), run_hashes(h2, begin, end, B2)
                size = end - begin
                order = np.lexsort((start, th, doc, size, f2, f1))
                same = np.r_[False, (f1[order][1:] == f1[order][:-1]) & (f2[order][1:] == f2[order][:-1]) & (size[order][1:] == size[order][:-1])]
                lead = order[~same][np.cumsum(~same) - 1]
                repeat = same & ((doc[order] != doc[lead]) | (th[order] != th[lead]) | (start[order] != start[lead]))
                blobs = []
                if (gone := order[repeat]).size:
                    blobs.append((-1, _pack(doc[gone].tobytes(), th[gone].tobytes(), start[gone].tobytes(), (start[gone] + size[gone]).tobytes())))
                keep = order[~same]
                home = (mix(least[keep] + np.uint64(5)) % np.uint64(buckets)).astype(np.int64)
                keep = keep[np.argsort(home, kind="stable")]
                home = np.sort(home, kind="stable")
                places, cuts = np.unique(home, return_index=True)
                from_byte, to_byte, raw = words.start[begin], words.end[end - 1], words.raw
                for bucket, i, j in zip(places.tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(home)]):
                    mine = keep[i:j]
                    packed = b"\n".join([raw[x:y].replace(b"\n", b" ") for x, y in zip(from_byte[mine].tolist(), to_byte[mine].tolist())])
                    blobs.append((bucket, _pack(doc[mine].tobytes(), th[mine].tobytes(), start[mine].tobytes(), packed)))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in blobs], pa.int32()), pa.array([x[1] for x in blobs], pa.binary())], out_names)

    def judged(parts) -> tuple[np.ndarray, ...]:
        doc, th, start = (np.concatenate([np.frombuffer(p[i], np.int64) for p in parts]) for i in range(3))
        lines = [x for p in parts for x in p[3].split(b"\n")]
        order = np.lexsort((start, th, doc))
        again = np.r_[False, (doc[order][1:] == doc[order][:-1]) & (th[order][1:] == th[order][:-1]) & (start[order][1:] == start[order][:-1])]
        order = order[~again]
        doc, th, start = doc[order], th[order], start[order]
        words = Words([lines[i] for i in order.tolist()])
        h1, h2 = words.hashes(1), words.hashes(2)
        n = words.count - k + 1  # windows of each run
        of = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        at = words.first[of] + place
        w1, w2 = run_hashes(h1, at, at + k, B1), run_hashes(h2, at, at + k, B2)
        by = np.argsort(w1, kind="stable")
        equal = w1[by][1:] == w1[by][:-1]
        if (equal & (w2[by][1:] != w2[by][:-1])).any():
            by = np.lexsort((w2, w1))
            equal = (w1[by][1:] == w1[by][:-1]) & (w2[by][1:] == w2[by][:-1])
        repeat = np.zeros(len(of), bool)
        repeat[by[1:][equal]] = True
        hit = np.flatnonzero(repeat)
        if not len(hit):
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        new = np.r_[True, (np.diff(hit) > 1) | (of[hit][1:] != of[hit][:-1])]
        first, last = hit[new], hit[np.r_[new[1:], True]]
        o = of[first]
        return doc[o], th[o], start[o] + place[first], start[o] + place[last] + k

    def sort_windows(batches):
        def rows(columns):
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc_id", "text_hash", "first", "last"])

        held, at = [], None
        for batch in batches:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if bucket < 0:
                    yield rows([np.frombuffer(p, np.int64) for p in _unpack(blob)])
                    continue
                if bucket != at and held:
                    yield rows(judged(held))
                    held = []
                at = bucket
                held.append(_unpack(blob))
        if held:
            yield rows(judged(held))

    sent = keyed.mapInArrow(cut_up, "bucket int, blob binary")
    # ranges found before the shuffle are spread evenly; buckets go to their partition
    home = F.when(F.col("bucket") < 0, F.xxhash64("blob")).otherwise(F.xxhash64("bucket"))
    return sent.repartition(partitions, home).sortWithinPartitions("bucket").mapInArrow(sort_windows, "doc_id long, text_hash long, first long, last long")


REPORT = ("n_words", "n_removed", "kept_sha256")


def deduplicate(docs: DataFrame, k: int = K, m: int = M, report: bool = True) -> DataFrame:
    """All columns of ``docs`` with the text cut down to its kept words; with the ``report`` also n_words, n_removed and kept_sha256."""
    spark = docs.sparkSession
    found = repeats(docs.select("doc_id", "text"), k, m).groupBy(F.col("doc_id").alias("_sl_id"), F.col("text_hash").alias("_sl_th")).agg(F.collect_list(F.struct("first", "last")).alias("_sl_runs"))
    left = docs.select(docs["*"], F.coalesce(docs["doc_id"], F.lit(-(1 << 63))).alias("_sl_k"), F.xxhash64(docs["text"]).alias("_sl_h"))
    both = left.join(found, (left["_sl_k"] == found["_sl_id"]) & (left["_sl_h"] == found["_sl_th"]), "left").drop("_sl_k", "_sl_h", "_sl_id", "_sl_th")
    added = REPORT if report else ()
    others = [f for f in docs.schema.fields if f.name not in ("text", *added)]
    names = [f.name for f in others]

    def keep(batches):
        for batch in batches:
            runs = batch.column(len(names) + 1).to_pylist()
            texts, kept, words_n, removed, digests = texts_of(batch.column(len(names))), [], [], [], []
            for text, spans in zip(texts, runs):
                words = WORD.findall(text)
                if spans:
                    gone = np.zeros(len(words) + 1, np.int32)
                    for s in spans:
                        gone[s["first"]] += 1
                        gone[s["last"]] -= 1
                    stay = np.cumsum(gone[:-1]) == 0
                    left_over = [w for w, s in zip(words, stay.tolist()) if s]
                else:
                    left_over = words
                out = b" ".join(left_over)
                kept.append(out.decode() if spans else None)
                words_n.append(len(words))
                removed.append(len(words) - len(left_over))
                digests.append(hashlib.sha256(out).hexdigest())
            # a text that loses nothing stays as it was, line breaks included
            text = [k if k is not None else t.decode() for k, t in zip(kept, texts)]
            counts = [pa.array(words_n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            columns = [batch.column(i) for i in range(len(names))] + [pa.array(text, pa.string()), *counts[: len(added)]]
            yield pa.RecordBatch.from_arrays(columns, [*names, "text", *added])

    from pyspark.sql.types import LongType, StringType, StructField, StructType

    kinds = dict(zip(REPORT, (LongType(), LongType(), StringType())))
    schema = StructType([*others, StructField("text", StringType()), *[StructField(c, kinds[c]) for c in added]])
    bounded_batches(spark)
    return both.select(*[both[f"`{n}`"] for n in names], "text", "_sl_runs").mapInArrow(keep, schema)
