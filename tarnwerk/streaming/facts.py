"""Streaming forms of the facts: an extension for append-shaped event records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _instant(c):
    """A local timestamp as the instant of that clock in UTC, whatever the session's zone."""
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c.cast("timestamp_ntz"))
    return F.timestamp_micros(us)


def _local(c):
    """The inverse of _instant."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.lit("1970-01-01").cast("timestamp_ntz"))


def read_events(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def windowed_counts(events: DataFrame, time: str, keys: list[str], width: str = "1 day", late: str = "2 days", measures: dict | None = None) -> DataFrame:
    """Counts per key and tumbling window of event time; events later than ``late`` behind the newest are dropped, and
    a window's state is given up once it can no longer change. Works on batches alike."""
    e = events.withColumn("_ts", _instant(F.col(time)))
    if events.isStreaming:
        e = e.withWatermark("_ts", late)
    g = e.groupBy(F.window("_ts", width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("records"), *[F.sum(c).alias(n) for n, c in (measures or {}).items()])
    return g.select(_local(F.col("w.start")).alias("window_start"), *keys, "records", *(measures or {}))


def sessions(events: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions per key: events no farther apart than ``gap``."""
    e = events.withColumn("_ts", _instant(F.col(time)))
    if events.isStreaming:
        e = e.withWatermark("_ts", late)
    g = e.groupBy(F.session_window("_ts", gap).alias("s"), key).agg(F.count(F.lit(1)).alias("events"))
    return g.select(key, _local(F.col("s.start")).alias("session_start"), _local(F.col("s.end")).alias("session_end"), "events")


def run_once(stream: DataFrame, table: str, checkpoint: str, mode: str = "append") -> None:
    """Process all that is there and stop; results go to an in-memory table of that name (tests and small results)."""
    q = stream.writeStream.format("memory").queryName(table).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
