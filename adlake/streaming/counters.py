"""Call counters on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hourly_counts(calls: DataFrame, endpoint: str, ts: str, keep: str = "24 hours") -> DataFrame:
    """Calls per endpoint and hour; an hour's counter is dropped ``keep`` after it passed."""
    return (
        calls.select(F.col(endpoint).alias("endpoint"), F.col(ts).cast("timestamp").alias("__ts"))
        .withWatermark("__ts", keep)
        .groupBy("endpoint", F.window("__ts", "1 hour").alias("w"))
        .agg(F.count(F.lit(1)).alias("calls"))
        .select("endpoint", F.col("w.start").alias("hour"), "calls")
    )


def sliding_counts(calls: DataFrame, key: str, ts: str, seconds: int = 20, step: int = 1, late: str = "1 minute") -> DataFrame:
    """Calls per key in windows of ``seconds`` that advance by ``step`` seconds."""
    return (
        calls.select(F.col(key).alias("key"), F.col(ts).cast("timestamp").alias("__ts"))
        .withWatermark("__ts", late)
        .groupBy("key", F.window("__ts", f"{seconds} seconds", f"{step} seconds").alias("w"))
        .agg(F.count(F.lit(1)).alias("calls"))
        .select("key", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "calls")
    )


def first_seen(entities: DataFrame, key: str = "id", ts: str = "updated_at", ttl: str = "24 hours") -> DataFrame:
    """Entities worth fetching: repeats within ``ttl`` are suppressed."""
    return entities.withWatermark(ts, ttl).dropDuplicatesWithinWatermark([key])
