"""Structured Streaming forms of the ledger's stateful behaviour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def once(stream: DataFrame, txn: str, ts: str, late: str = "10 minutes") -> DataFrame:
    """Each transaction once: repeats within the watermark are dropped, and state is bounded by it."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([txn])


def too_many(stream: DataFrame, key: str, ts: str, most: int, window: str = "60 seconds", slide: str = "10 seconds", late: str = "1 minute") -> DataFrame:
    """key, start, n of sliding windows with more than `most` rows of a key."""
    w = F.window(ts, window, slide).alias("w")
    return stream.withWatermark(ts, late).groupBy(key, w).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select(key, F.col("w.start").alias("start"), "n")


def failures(stream: DataFrame, key: str, ts: str, window: str = "10 minutes", late: str = "1 minute") -> DataFrame:
    """key, start, n of tumbling windows."""
    return stream.withWatermark(ts, late).groupBy(key, F.window(ts, window).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), "n")


def arrivals(spark: SparkSession, path: str, schema: str, files: int = 1) -> DataFrame:
    """Chunks of a table as they arrive in a folder, some files a step."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", str(files)).parquet(path)


def live_view(stream: DataFrame, keep: Column, facet: str) -> DataFrame:
    """value, n, passed of what has arrived so far; written in complete mode, every step shows the view anew. State is one row a value."""
    return stream.groupBy(F.col(facet).alias("value")).agg(F.count(F.lit(1)).alias("n"), F.count_if(keep).alias("passed"))


def sessions(stream: DataFrame, key: str, ts: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """key, start, end, n of sessions parted by a gap."""
    return stream.withWatermark(ts, late).groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
