"""Request plans: date chunks per account and what the cache already holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions.dates import is_full_month


def explode_ranges(df: DataFrame, ranges: Column) -> DataFrame:
    """Every row once per range, as date columns ``start`` and ``end``."""
    return df.select("*", F.inline(ranges))


def split_by_cache(chunks: DataFrame, cached: DataFrame, keys: Sequence[str], stable_until) -> DataFrame:
    """Marks each chunk ``cached`` or ``fetch``.

    A chunk that contains the last stable day is always fetched; the others are
    served when the cache has any row for their keys and range.
    """
    on = [*keys, "start", "end"]
    boundary = F.lit(stable_until).cast("date")
    have = cached.select(*on).distinct().withColumn("__have", F.lit(True))
    unstable = F.col("start").cast("date").isNotNull() & boundary.between(F.col("start"), F.col("end"))
    return (
        chunks.join(have, on, "left")
        .withColumn("source", F.when(~unstable & F.col("__have").isNotNull(), "cached").otherwise("fetch"))
        .drop("__have")
    )


def cached_rows(chunks: DataFrame, cache: DataFrame, keys: Sequence[str], stable_until) -> DataFrame:
    """Cache rows of the chunks that may be served from it."""
    boundary = F.lit(stable_until).cast("date")
    usable = chunks.filter(~boundary.between(F.col("start"), F.col("end")))
    on = [*keys, "start", "end"]
    return cache.join(usable.select(*on), on, "left_semi")


def cacheable(rows: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Rows that cover whole months; only these are kept in the report cache."""
    return rows.filter(is_full_month(F.col(start).cast("date"), F.col(end).cast("date"), strict=False))
