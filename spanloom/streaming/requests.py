"""Streams of requests: language resolution and windowed counts of late data with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.serving import resolve


def resolved_stream(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 8) -> DataFrame:
    """Documents as they arrive, with their language; backpressure by files per trigger."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return resolve(rows.withColumn("lang", F.lit(None).cast("string")))


def windowed_counts(events: DataFrame, time: str = "ts", late: str = "1 hour", width: str = "1 hour", slide: str | None = None, by: str = "event_type") -> DataFrame:
    """Counts of each window and kind; with ``slide`` the windows overlap; rows later than ``late`` behind the newest are dropped by a stream."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    return events.withWatermark(time, late).groupBy(window, by).agg(F.count("*").alias("n"))


def sessions(events: DataFrame, key: str, time: str = "ts", gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of each key: they end where nothing follows within ``gap``."""
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap), key).agg(F.count("*").alias("n"))


def first_only(events: DataFrame, keys: list[str], time: str = "ts", late: str = "1 hour") -> DataFrame:
    """Each key once, as long as its repetitions come within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def run_once(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """All that is there now, appended to a table in a shared folder, and that table; after a lost run it goes on from its checkpoint."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
