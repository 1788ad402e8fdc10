"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, licenses, minhash, neighbours, packing, pii, quality_rules, resampling, secrets, substrings


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.classes(table(spark, folder, "documents"))


def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(table(spark, folder, "documents"))


def op4_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.sequences(table(spark, folder, "documents"))


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(table(spark, folder, "documents"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_rules.assess(docs, quality_rules.fit(docs, table(spark, folder, "labels")))


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"))


def op10_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.deduplicate(table(spark, folder, "documents").select("doc_id", "text")).drop("text")


def queries() -> dict:
    return {
        f.__name__: f
        for f in (op1_minhash, op2_licenses, op3_bpe, op4_neighbours, op5_quality, op6_packing, op7_pii, op8_quality_rules, op9_secrets, op10_substrings)
    }


OP10_SQL = r"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
k AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)),
r AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS n FROM k) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + o AS i FROM r, range(20) t(o)),
x AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
kept AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.i) FILTER (WHERE g.i IS NULL) AS t, count(g.i) AS n FROM x LEFT JOIN gone g ON x.doc_id = g.doc_id AND x.i = g.i GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id"""


def oracle_sql() -> dict[str, str]:
    return {"op10_substrings": OP10_SQL}
