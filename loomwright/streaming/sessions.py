"""Streaming forms of the session and flood operators, keyed by a stream's user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session_counts(stream: DataFrame, time: str, key: str, gap: str, late: str) -> DataFrame:
    """Events by session of a key: sessions end after ``gap`` without events; events later than ``late``
    behind the newest are left out. Batch tables work too."""
    return stream.withWatermark(time, late).groupBy(key, F.session_window(time, gap).alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), "n")


def first_seen(stream: DataFrame, time: str, keys: list[str], late: str) -> DataFrame:
    """The first of equal events within the watermark: repeated deliveries are dropped."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def replay(spark: SparkSession, path: str, schema, files_at_once: int = 1) -> DataFrame:
    """A folder of parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(path)
