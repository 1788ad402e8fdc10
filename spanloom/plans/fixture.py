"""Synthetic annotations over the documents table, and their SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.spans import tokens

TYPES = ("PER", "LOC", "ORG", "PROD", "EVT")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def toks(spark: SparkSession, folder: str) -> DataFrame:
    return tokens(table(spark, folder, "documents").select("doc_id", "lang", "text"))


def gold(spark: SparkSession, folder: str) -> DataFrame:
    t = toks(spark, folder).withColumn("surface", F.regexp_extract("word", "^[A-Z][a-z]+", 0)).where(F.length("surface") >= 4)
    kind = F.element_at(F.array(*[F.lit(x) for x in TYPES]), ((F.col("doc_id") + F.col("tok")) % 5 + 1).cast("int"))
    return t.select("doc_id", "lang", "tok", "start", (F.col("start") + F.length("surface")).alias("end"), kind.alias("type"), "surface")


def pred(spark: SparkSession, folder: str, modulus: int = 20) -> DataFrame:
    """The gold spans, some dropped, cut short or of another type, and some that are not there."""
    g = gold(spark, folder).withColumn("h", (F.col("doc_id") * 31 + F.col("start") * 7) % modulus).where("h <> 0")
    seen = g.select("doc_id", "lang", "start", F.when(F.col("h") == 1, F.col("end") - 1).otherwise(F.col("end")).alias("end"), F.when(F.col("h") == 2, "ORG").otherwise(F.col("type")).alias("type"), F.when(F.col("h") == 1, F.expr("substring(surface, 1, length(surface) - 1)")).otherwise(F.col("surface")).alias("surface"))
    t = toks(spark, folder).where(F.col("word").rlike("^[a-z]{7}$") & ((F.col("doc_id") * 13 + F.col("start")) % 97 == 0))
    extra = t.select("doc_id", "lang", "start", (F.col("start") + 7).alias("end"), F.lit("LOC").alias("type"), F.col("word").alias("surface"))
    return seen.unionByName(extra).withColumn("score", F.lit(0.5) + ((F.col("doc_id") * 17 + F.col("start") * 3) % 50) / F.lit(100.0))


def annotation_sql(modulus: int = 20, name: str = "pred") -> str:
    return f"""{name} AS (
  SELECT *, 0.5 + ((doc_id * 17 + start * 3) % 50) / 100.0 AS score FROM (
    SELECT doc_id, lang, start, CASE WHEN h = 1 THEN stop - 1 ELSE stop END AS stop, CASE WHEN h = 2 THEN 'ORG' ELSE type END AS type,
      CASE WHEN h = 1 THEN substr(surface, 1, length(surface) - 1) ELSE surface END AS surface
    FROM (SELECT *, (doc_id * 31 + start * 7) % {modulus} AS h FROM gold) WHERE h <> 0
    UNION ALL
    SELECT doc_id, lang, start, start + 7, 'LOC', word FROM toks WHERE regexp_full_match(word, '[a-z]{{7}}') AND (doc_id * 13 + start) % 97 = 0))"""


TOKENS_SQL = """WITH words AS (SELECT doc_id, lang, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) - 1 AS tok FROM documents),
toks AS (SELECT *, CAST(coalesce(sum(length(word) + 1) OVER (PARTITION BY doc_id ORDER BY tok ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM words),
gold AS (SELECT doc_id, lang, tok, start, start + length(surface) AS stop, (['PER', 'LOC', 'ORG', 'PROD', 'EVT'])[CAST((doc_id + tok) % 5 + 1 AS BIGINT)] AS type, surface
  FROM (SELECT *, regexp_extract(word, '^[A-Z][a-z]+', 0) AS surface FROM toks) WHERE length(surface) >= 4)"""
ANNOTATIONS_SQL = f"{TOKENS_SQL},\n{annotation_sql()}"
