"""Approximate nearest neighbours on shifted space-filling curves.

Vectors get one more component that turns the largest inner product into the
smallest distance, are projected to a few dimensions in ``ORDERINGS`` ways, each
with a shift, and lie on a Hilbert curve each time.  Every ordering is
range-partitioned and cut into windows of ``WINDOW`` vectors; a query meets its
own window and as many to either side as the table needs, and what all orderings
find merges and is ranked by the exact inner product in double precision.

How many follows from the table: ``PROBES`` of the queries are answered exactly
by one pass over all vectors, and every query reaches as many windows as bring
``TARGET`` of those neighbours into sight (one at least; all, in the limit).

The projections are fitted on a sample of at most ``SAMPLE`` vectors; every
vector is indexed.  Equal vectors are one entry with its smallest ids, so a hot
vector fills no window.  Windows are ranges of rank, alike at every size.
Defined cases: vectors that are null, zero, hold null or non-finite components,
or have another length than the commonest take no part, nor do null ids;
repeated ids count as one vector if equal, as several otherwise.  Ties in score go
to the smaller vec_id; an empty table gives none; other columns are not looked at,
whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .arrays import bounded_batches
from .shared import cut

ORDERINGS, DIMENSIONS, BITS, WINDOW, SAMPLE = 20, 6, 8, 1024, 20_000
PROBES, TARGET = 256, 0.95


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert keys of integer points (one row each), by undoing excess rotations and Gray code."""
    x = points.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = (x[0] ^ x[i]) & p
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            if i:
                x[i] = np.where(high, x[i], x[i] ^ t)
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b) & 1
    return key


class Curves:
    """Projections, shifts and scales fitted on a bounded sample."""

    def __init__(self, sample: np.ndarray, longest: float, orderings: int = ORDERINGS, dimensions: int = DIMENSIONS, bits: int = BITS, seed: int = 1):
        rng, self.bits, self.longest = np.random.default_rng(seed), bits, longest
        data = self.lift(sample)
        self.mean = data.mean(axis=0)
        values, axes = np.linalg.eigh(np.cov(data - self.mean, rowvar=False) + 1e-9 * np.eye(data.shape[1]))
        order = np.argsort(-values)
        main, self.maps = axes[:, order] * np.sqrt(np.maximum(values[order], 0) / max(values.max(), 1e-12)), []
        d = min(dimensions, data.shape[1])
        for _ in range(orderings):
            # random directions, drawn in proportion to what each axis explains
            base = np.linalg.qr(main @ rng.standard_normal((data.shape[1], d)))[0]
            flat = (data - self.mean) @ base
            lo, hi = np.quantile(flat, 0.005, axis=0), np.quantile(flat, 0.995, axis=0)
            wide = np.maximum(hi - lo, 1e-9)
            # the shift moves cell borders; a quarter of the range is left for it
            self.maps.append((base, lo - rng.random(d) * wide / 3, wide * 4 / 3))

    def lift(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, self.longest**2 - (x * x).sum(axis=1)))
        return np.c_[x, extra]

    def keys(self, x: np.ndarray) -> list[np.ndarray]:
        data, top = self.lift(x) - self.mean, (1 << self.bits) - 1
        return [hilbert(np.clip(((data @ base - lo) / wide * (top + 1)).astype(np.int64), 0, top), self.bits) for base, lo, wide in self.maps]


def usable(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, embedding) that take part."""
    e = F.col("embedding")
    if not dict(vectors.dtypes)["embedding"] == "array<float>":  # single precision stays as it is, to move less
        e = e.cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding")).where("vec_id is not null and embedding is not null and size(embedding) > 0")
    good = "forall(embedding, x -> x is not null and not isnan(x) and abs(double(x)) < double('inf')) and exists(embedding, x -> x <> 0)"
    rows = rows.where(F.expr(good))
    sizes = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.where(F.size("embedding") == (sizes[0][0] if sizes else 0))


def exact(table: DataFrame, ids: np.ndarray, x: np.ndarray, k: int) -> DataFrame:
    """The ``k`` nearest entries of a few probes (ids and vectors), over the whole table: q, entry, score."""

    def scan(batches):
        best = np.full((len(ids), k), -np.inf), np.full((len(ids), k), -1, np.int64)
        for batch in batches:
            if not len(batch):
                continue
            entry = batch.column(0).to_numpy()
            c = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1).astype(np.float64)
            score = np.where(entry == ids[:, None], -np.inf, np.einsum("qd,cd->qc", x, c, optimize=False))
            both = np.c_[best[0], score], np.c_[best[1], np.broadcast_to(entry, score.shape)]
            at = np.argsort(-both[0], axis=1, kind="stable")[:, :k]
            best = tuple(np.take_along_axis(b, at, axis=1) for b in both)
        seen = best[0] > -np.inf
        yield pa.RecordBatch.from_arrays([pa.array(np.broadcast_to(ids[:, None], seen.shape)[seen]), pa.array(best[1][seen]), pa.array(best[0][seen])], ["q", "entry", "score"])

    found = table.select("entry", "embedding").mapInArrow(scan, "q long, entry long, score double")
    return found.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "entry"))).where(F.col("n") <= k).drop("n")


def reach(ranked: DataFrame, true: DataFrame, target: float) -> int:
    """The fewest windows to either side that hold ``target`` of the true neighbours (q, entry) in some ordering."""
    few = F.broadcast(true.select("q", "entry"))  # probes times k rows, at every size
    theirs = ranked.join(few, "entry").select("q", "entry", "ordering", "block")
    own = ranked.join(F.broadcast(true.select(F.col("q").alias("entry")).distinct()), "entry").select(F.col("entry").alias("q"), "ordering", F.col("block").alias("at"))
    apart = theirs.join(own, ["q", "ordering"]).groupBy("q", "entry").agg(F.min(F.abs(F.col("block") - F.col("at"))).alias("d"))
    counts = sorted((int(d), n) for d, n in apart.groupBy("d").count().collect())
    need, seen = target * sum(n for _, n in counts), 0
    for d, n in counts:
        seen += n
        if seen >= need:
            return max(1, d)
    return 1


def nearest(vectors: DataFrame, queries: str = "vec_id % 20 = 0", k: int = 20, orderings: int = ORDERINGS, dimensions: int = DIMENSIONS, window: int = WINDOW, sample_rows: int = SAMPLE, probes: int = PROBES, target: float = TARGET) -> DataFrame:
    """Each query's ``k`` nearest found: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = usable(vectors).select("vec_id", "embedding", F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(7), "embedding").alias("h2"))
    few = Window.partitionBy("h1", "h2").orderBy("vec_id")
    members = cut(rows.withColumn("place", F.row_number().over(few)).where(F.col("place") <= k + 1))
    entries = members.where("place = 1").select(F.col("vec_id").alias("entry"), "embedding", "h1", "h2")
    names = members.join(entries.select("entry", "h1", "h2"), ["h1", "h2"]).select("entry", "vec_id")
    asked = rows.where(queries).select("vec_id", "h1", "h2").distinct().join(entries.select("entry", "h1", "h2"), ["h1", "h2"]).select("entry", F.col("vec_id").alias("query_id"))
    asking = cut(asked)
    wanted = asking.select("entry").distinct().withColumn("asks", F.lit(True))
    table = entries.select("entry", "embedding").join(wanted, "entry", "left").select("entry", "embedding", F.coalesce("asks", F.lit(False)).alias("asks"))
    longest = entries.agg(F.max(F.expr("aggregate(embedding, double(0), (s, x) -> s + double(x) * double(x))"))).first()[0]
    if longest is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = np.array([r[0] for r in entries.orderBy(F.xxhash64("entry"), "entry").limit(sample_rows).select("embedding").collect()], np.float64)
    curves = Curves(sample, float(np.sqrt(longest)), orderings, dimensions)

    def place(batches):
        for batch in batches:
            ids, asks = batch.column(0), batch.column(2)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1).astype(np.float64)
            for i, key in enumerate(curves.keys(x)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(batch), i, np.int32)), pa.array(key), ids, asks], ["ordering", "key", "entry", "asks"])

    def number(batches):
        pid, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            at = np.arange(n, n + len(batch))
            n += len(batch)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(np.full(len(batch), pid, np.int32)), pa.array(at)], ["ordering", "entry", "asks", "part", "at"])

    # only keys and ids are ordered; vectors join their windows afterwards
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    laid = table.mapInArrow(place, "ordering int, key long, entry long, asks boolean").repartitionByRange(parts, "ordering", "key", "entry").sortWithinPartitions("ordering", "key", "entry")
    laid = cut(laid.mapInArrow(number, "ordering int, entry long, asks boolean, part int, at long"))
    sizes = laid.groupBy("ordering", "part").agg(F.min("at").alias("lo"), F.count("*").alias("n")).collect()
    before: dict[int, int] = {}
    shift = []
    for o, p, lo, n in sorted(sizes):
        shift.append((o, p, before.get(o, 0) - lo))
        before[o] = before.get(o, 0) + n
    offsets = F.broadcast(spark.createDataFrame(shift, "ordering int, part int, shift long"))  # one row per partition and ordering at most
    ranked = laid.join(offsets, ["ordering", "part"]).select("entry", "ordering", F.floor((F.col("at") + F.col("shift")) / window).alias("block"))
    asked = wanted.orderBy(F.xxhash64("entry"), "entry").limit(probes).join(entries, "entry").select("entry", "embedding").collect()
    far = 1
    if asked:
        ids, x = np.array([r[0] for r in asked], np.int64), np.array([r[1] for r in asked], np.float64)
        far = reach(ranked, cut(exact(table, ids, x, k)), target)
    seated = ranked.groupBy("entry").agg(F.collect_list(F.struct("ordering", "block")).alias("seats")).join(table, "entry")
    # an entry sits in its own block; where it asks, also as a query there and in those within reach
    seats = F.expr(f"""if(asks, concat(transform(seats, s -> struct(s.ordering, s.block, false as asks)),
        flatten(transform(seats, s -> transform(sequence(-{far}L, {far}L), d -> struct(s.ordering, s.block + d as block, true as asks))))),
        transform(seats, s -> struct(s.ordering, s.block, false as asks)))""")
    blocks = seated.select("entry", "embedding", F.explode(seats).alias("s")).select("s.ordering", "s.block", "entry", "embedding", "s.asks")

    def rank(pdf: pd.DataFrame) -> pd.DataFrame:
        asks = pdf["asks"].to_numpy(bool)
        if not asks.any() or asks.all():
            return pd.DataFrame({"q": np.zeros(0, np.int64), "entry": np.zeros(0, np.int64), "score": np.zeros(0)})
        x, ids = np.stack(pdf["embedding"].to_numpy()).astype(np.float64), pdf["entry"].to_numpy(np.int64)
        c, q, ci, qi = x[~asks], x[asks], ids[~asks], ids[asks]
        by = np.argsort(ci, kind="stable")
        c, ci = c[by], ci[by]
        out_q, out_e, out_s = [], [], []
        for a in range(0, len(q), 1024):
            score = np.einsum("qd,cd->qc", q[a : a + 1024], c, optimize=False)
            best = np.argsort(-score, axis=1, kind="stable")[:, : k + 1]
            out_q.append(np.repeat(qi[a : a + 1024], best.shape[1]))
            out_e.append(ci[best].ravel())
            out_s.append(np.take_along_axis(score, best, axis=1).ravel())
        return pd.DataFrame({"q": np.concatenate(out_q), "entry": np.concatenate(out_e), "score": np.concatenate(out_s)})

    found = blocks.groupBy("ordering", "block").applyInPandas(rank, "q long, entry long, score double")
    found = found.groupBy("q", "entry").agg(F.max("score").alias("score"))
    top = found.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "entry"))).where(F.col("n") <= k + 1).drop("n")
    wide = top.join(names, "entry").select("q", "vec_id", "score")
    wide = wide.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).where(F.col("n") <= k + 1)
    each = wide.join(asking.select(F.col("entry").alias("q"), "query_id"), "q").where("vec_id <> query_id")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
