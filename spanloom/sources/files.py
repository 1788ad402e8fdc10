"""Small files and scratch space where every executor can reach them."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one of our own in local mode only.

    On a cluster without the setting this raises: a folder of one machine would lose
    what other machines write.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spanloom-"))
    return sc.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame) -> DataFrame:
    """The same rows, written once to the shared folder: what follows reads them instead of making them again."""
    path = scratch(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as a whole; raises FileNotFoundError where there is none."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    rows = spark.read.text(path, wholetext=True).head(1)
    return rows[0][0] if rows else ""


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, in place of what was there."""
    p, fs = _path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(read_text(spark, path))


def write_json(spark: SparkSession, path: str, value) -> None:
    write_text(spark, path, json.dumps(value, ensure_ascii=False, indent=2))
