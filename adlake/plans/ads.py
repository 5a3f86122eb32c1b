"""Ads reports: performance totals, breakdowns, and daily metrics with their entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.operators import enrich, sets, unnest
from adlake.operators.latest import override
from adlake.plans.templates import reportable, spending


def performance_report(pages: DataFrame, page_names: DataFrame, level: str) -> DataFrame:
    """Totals per object over the requested range, with its creative and page name."""
    rows = unnest.performance_rows(pages, level)
    if "effective_status" in rows.columns:
        rows = reportable(rows, level)
    if "actor_id" not in rows.columns:
        return rows
    named = enrich.page_names(rows, page_names)
    return named.withColumn("page_name", F.when(F.col("actor_id").isNotNull(), F.col("page_name")))


def breakdown_report(pages: DataFrame) -> DataFrame:
    return unnest.breakdown_rows(pages)


def fresh(cache: DataFrame, as_of, hours: int = 24, saved: str = "updated_at") -> DataFrame:
    """Cached entities that have not expired."""
    floor = F.lit(as_of).cast("timestamp") - F.make_interval(hours=F.lit(hours))
    return cache.filter(F.col(saved) > floor)


def entities_to_fetch(insights: DataFrame, cache: DataFrame, level: str, as_of) -> DataFrame:
    """Ids seen in the insights that the fresh cache does not hold."""
    ids = sets.distinct_ids(insights, f"{level}_id").withColumnRenamed(f"{level}_id", "id")
    return sets.missing_ids(ids, fresh(cache, as_of), ["id"])


def daily_report(
    pages: DataFrame, objects: DataFrame, cache: DataFrame, page_names: DataFrame, level: str, as_of
) -> tuple[DataFrame, DataFrame]:
    """Metrics and entities of a two-phase daily report.

    Rows without spend are dropped. Entities come from the fresh cache, newly
    fetched ones replace them, and only those the metrics mention are kept.
    """
    metrics = spending(unnest.insight_rows(pages, level))
    fetched = enrich.page_names(unnest.entity_rows(objects), page_names)
    held = fresh(cache, as_of).drop("updated_at")
    ids = metrics.select(F.col(f"{level}_id").alias("id"))
    entities = sets.only_known(override(held, fetched, ["id"]), ids, ["id"])
    return metrics, entities


def joined_daily_report(metrics: DataFrame, entities: DataFrame, level: str) -> DataFrame:
    return enrich.join_entities(metrics, entities, level)


def total(rows: DataFrame, column: str) -> DataFrame:
    """Sum of a text-encoded amount."""
    amount = F.coalesce(F.col(column).try_cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))
    return rows.agg(F.sum(amount).cast("double").alias(f"total_{column}"))
