"""Corpus pipeline: quality, near copies, repeated passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``, others that the table has beside them too,
whatever their names.  Nulls, ties, repeated rows, empty tables and very long
texts have the results that each operator's docstring states: rows without an id
stay through near copies, rows without text go with the quality stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from spanloom.llm import minhash, packing, pii, resampling, substrings
from spanloom.llm.shared import shared_folder


def _sized(docs: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``, with n_chars (where there is one) following the text."""
    if "n_chars" in like.columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(like.schema["n_chars"].dataType))
    return docs.select(*[docs[f"`{c}`"] for c in like.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes; a doc_id goes if no row of it is taken."""
    judged = resampling.classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    gone = judged.groupBy(F.col("doc_id").alias("_sl_id")).agg(F.max("kept").alias("k")).where("not k").select("_sl_id")
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_sl_id"]), "left_anti")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near copies."""
    return minhash.keep_one(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that also start earlier."""
    return _sized(substrings.deduplicate(docs, report=False), docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return _sized(pii.redact(docs), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, placed in sequences."""
    return packing.sequences(docs)


STAGES = [("quality", quality), ("minhash", near_copies), ("substrings", passages), ("pii", personal_data), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
