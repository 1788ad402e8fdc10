"""Lineage cuts in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..sources.files import shared_root

FILTER_BITS = 1 << 26  #: bits of the key filter: 8 MB


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one of our own only in local mode where none is set, else this raises."""
    return shared_root(spark)


class Table:
    """Rows written once to the shared folder: ``df`` reads them, ``n`` and ``digest`` were taken while writing."""

    def __init__(self, df: DataFrame):
        self.spark = df.sparkSession
        self.path = f"{shared_folder(self.spark)}/{uuid.uuid4().hex}"
        seen = Observation()
        kept = [c for c, kind in df.dtypes if kind in ("bigint", "int", "boolean")]
        mark = F.sum(F.shiftright(F.xxhash64(*[F.col(c) for c in kept] or [F.lit(0)]), 24))
        df.observe(seen, F.count(F.lit(1)).alias("n"), mark.alias("mark")).write.parquet(self.path)
        got = seen.get
        self.n, self.digest = got["n"], (got["n"], got["mark"])
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """Remove the files; only once nothing will read them any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """The same rows, read from a table in the shared folder."""
    return Table(df).df


def among(rows: DataFrame, wanted: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The rows whose key (the only column of ``wanted``) is wanted.

    A bitmap of hashed keys, of ``bits`` bits at every size, is broadcast and
    holds back most other rows before they are dealt; an exact join follows.
    """
    key = wanted.columns[0]
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    of = lambda df: df.withColumn("_sl_at", place)
    maps = of(wanted).groupBy(F.bitmap_bucket_number("_sl_at").alias("_sl_part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_sl_at")).alias("_sl_bits"))
    met = of(rows).withColumn("_sl_part", F.bitmap_bucket_number("_sl_at")).join(F.broadcast(maps), "_sl_part")
    byte = F.expr("cast(conv(hex(substring(_sl_bits, cast(bitmap_bit_position(_sl_at) div 8 as int) + 1, 1)), 16, 10) as int)")
    on = byte.bitwiseAND(F.expr("shiftleft(1, cast(bitmap_bit_position(_sl_at) % 8 as int))")) != 0
    return met.where(on).select(*rows.columns).join(wanted, key, "left_semi")


def components(edges: DataFrame, rounds: int = 60) -> Table:
    """Connected components of edges (a, b): one row (node, root) per node, root the smallest node.

    Large-star and small-star rounds in turn; each round is dealt by node, and a
    node's links are aggregated before they are dealt.  Rounds end when the links
    no longer change.
    """
    links = Table(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct())
    for _ in range(rounds):
        if not links.n:
            break
        # large star: each node links its larger neighbours to its smallest neighbour (or itself)
        both = links.df.union(links.df.select("u", "v")).toDF("x", "y")
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("v"), F.col("m").alias("u")).distinct()
        # small star: each node links itself and its smaller neighbours to the smallest of them
        low = large.groupBy(F.col("v").alias("x")).agg(F.min("u").alias("m"))
        small = large.toDF("x", "y").join(low, "x")
        pairs = F.explode(F.array(F.struct(F.col("y").alias("v"), F.col("m").alias("u")), F.struct(F.col("x").alias("v"), F.col("m").alias("u")))).alias("p")
        now = Table(small.select(pairs).select("p.v", "p.u").where("v <> u").distinct())
        links.drop()
        done, links = now.digest == links.digest, now
        if done:
            break
    else:
        raise RuntimeError("components did not settle")
    found = Table(links.df.toDF("node", "root").union(links.df.select("u", "u").distinct()))
    links.drop()
    return found
