"""Nested API answers and reports to flat rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions import text as tx
from adlake.functions.jsonx import first_filled, or_null, text
from adlake.schemas import NAMED

HOURLY = "hourly_stats_aggregated_by_audience_time_zone"


def page_rows(pages: DataFrame, context: Sequence[str] = ()) -> DataFrame:
    """One row per element of ``data``; pages without data give none."""
    return pages.select(*context, F.explode("data").alias("item"))


def _item_fields(df: DataFrame) -> list[str]:
    return df.schema["item"].dataType.fieldNames()


def insight_rows(pages: DataFrame, level: str) -> DataFrame:
    """Daily insight pages to rows.

    ``pages`` carries the request's ``account_id`` and ``account_name``; these
    replace whatever the row says. A row without ``{level}_id`` takes its ``id``.
    """
    rows = page_rows(pages, ["account_id", "account_name"])
    names = _item_fields(rows)
    key = f"{level}_id"
    out = [F.col(f"item.{n}").alias(n) for n in names if n not in ("account_id", "account_name", key)]
    own = F.col(f"item.{key}") if key in names else F.lit(None).cast("string")
    fallback = F.col("item.id") if "id" in names else F.lit(None).cast("string")
    if level != "account":
        out.append(F.coalesce(own, fallback).alias(key))
    return rows.select("account_id", "account_name", *out)


def breakdown_rows(pages: DataFrame) -> DataFrame:
    """Breakdown pages to rows: request dates fill missing ones, hour buckets get a plain name.

    ``pages`` carries ``account_id, account_name, start_date, end_date``.
    """
    rows = page_rows(pages, ["account_id", "account_name", "start_date", "end_date"])
    special = ("account_id", "account_name", "date_start", "date_stop")
    names = _item_fields(rows)
    out = [F.col(f"item.{n}").alias(n) for n in names if n not in special]
    hour = F.col(f"item.{HOURLY}") if HOURLY in names else F.lit(None).cast("string")
    return rows.select(
        "account_id",
        "account_name",
        first_filled(F.col("item.date_start"), default=F.col("start_date")).alias("date_start"),
        first_filled(F.col("item.date_stop"), default=F.col("end_date")).alias("date_stop"),
        text(hour).alias("hour_of_day"),
        *out,
    )


def creative_columns(creative: Column) -> dict[str, Column]:
    """Flat creative columns; all NULL where the row has no creative."""
    given = creative.isNotNull()

    def col(c: Column) -> Column:
        return F.when(given, c)

    return {
        "creative_id": col(text(creative["id"])),
        "creative_title": col(text(creative["title"])),
        "creative_body": col(text(creative["body"])),
        "actor_id": col(text(creative["actor_id"])),
        "creative_thumbnail_url": col(tx.image_formula(creative["thumbnail_url"])),
        "creative_thumbnail_raw_url": col(text(creative["thumbnail_url"])),
        "creative_link": col(tx.prefixed(tx.STORY_LINK, creative["object_story_id"])),
    }


def performance_rows(pages: DataFrame, level: str) -> DataFrame:
    """Performance pages (object plus one total insight) to rows.

    The insight's columns win over the object's. The report covers the requested
    range, so the request gives the dates. ``page_name`` is added by a lookup.
    """
    rows = page_rows(pages, ["account_id", "account_name", "start_date", "end_date"])
    item = F.col("item")
    record = F.get(item["insights"]["data"], 0)
    nested = ("insights", "creative", "campaign", "adset")
    names = _item_fields(rows)
    insight_type = rows.schema["item"].dataType["insights"].dataType["data"].dataType.elementType
    fixed = {
        "account_id": F.col("account_id"),
        "account_name": F.col("account_name"),
        "date_start": F.col("start_date"),
        "date_stop": F.col("end_date"),
    }
    cols: dict[str, Column] = {n: item[n] for n in names if n not in nested}
    for n in insight_type.fieldNames():
        cols[n] = F.coalesce(record[n], cols[n]) if n in cols else record[n]
    if "creative" in names:
        cols.update(creative_columns(item["creative"]))
    none = F.lit(None).cast("string")
    for unit in ("campaign", "adset"):
        own_id, own_name = cols.get(f"{unit}_id", none), cols.get(f"{unit}_name", none)
        if unit == "campaign" and level == "campaign":
            cols["campaign_id"] = F.coalesce(or_null(own_id), item["id"])
            cols["campaign_name"] = F.coalesce(or_null(own_name), item["name"])
        elif unit in names:
            given = item[unit].isNotNull()
            cols[f"{unit}_id"] = F.when(given, item[unit]["id"]).otherwise(own_id)
            cols[f"{unit}_name"] = F.when(given, item[unit]["name"]).otherwise(own_name)
    cols.update(fixed)
    return rows.select(*[c.alias(n) for n, c in cols.items()])


def entity_rows(objects: DataFrame, item: str = "item") -> DataFrame:
    """Single-object answers to flat entity rows; ``object_id`` (the requested id) is the id."""
    it = F.col(item)
    known = ("id", "name", "campaign", "adset", "creative")
    other = [n for n in objects.schema[item].dataType.fieldNames() if n not in known]
    creative = creative_columns(it["creative"])
    given = it["creative"].isNotNull()
    return objects.select(
        F.col("object_id").alias("id"),
        it["name"].alias("name"),
        it["campaign"]["id"].alias("campaign_id"),
        it["campaign"]["name"].alias("campaign_name"),
        it["adset"]["id"].alias("adset_id"),
        it["adset"]["name"].alias("adset_name"),
        it["adset"]["bid_strategy"].alias("adset_bid_strategy"),
        first_filled(it["adset"]["bid_amount"], it["adset"]["daily_budget"], it["adset"]["lifetime_budget"]).alias(
            "adset_bid_amount"
        ),
        F.when(given, text(it["creative"]["name"])).alias("creative_name"),
        *[c.alias(n) for n, c in creative.items()],
        *[it[n].alias(n) for n in other],
    )


def expand_metrics(df: DataFrame, metrics: str, names: Sequence[str]) -> DataFrame:
    """Metrics become columns; a metric replaces a column of the same name."""
    kept = [c for c in df.columns if c != metrics and c not in names]
    return df.select(*kept, *[F.col(metrics)[n].alias(n) for n in names])


def flatten_creatives(campaigns: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Nested shop report (campaign → product → creative) to one row per creative.

    Campaigns without products and products without creatives give no rows.
    """
    products = campaigns.select("*", F.explode("performance_data").alias("p")).drop("performance_data")
    rows = products.select("*", F.explode("p.creative_details").alias("c"))
    given = [n for n in ("start_date", "end_date", "advertiser_id", "advertiser_name", "store_id", "store_name",
                         "campaign_id", "campaign_name", "operation_status") if n in campaigns.columns]
    flat = rows.select(
        *given,
        F.col("p.dimensions.item_group_id").alias("item_group_id"),
        F.col("p.product_details.product_title").alias("product_name"),
        F.col("p.product_details.product_status").alias("product_status"),
        F.col("p.product_details.product_image_url").alias("product_image_url"),
        F.col("c.item_id").alias("item_id"),
        F.concat(F.lit(tx.VIDEO_LINK), F.col("c.item_id")).alias("video_url"),
        F.col("c.metadata.title").alias("title"),
        F.col("c.metadata.tt_account_name").alias("tt_account_name"),
        F.col("c.metadata.tt_account_profile_image_url").alias("tt_account_profile_image_url"),
        first_filled(F.col("c.metadata.product_img"), default=F.col("p.product_details.product_image_url")).alias(
            "product_img"
        ),
        F.col("c.metrics").alias("metrics"),
    )
    return expand_metrics(flat, "metrics", metrics)


def usage_rows(jobs: DataFrame) -> DataFrame:
    """Job log to one row per (job, batch, account); batches without accounts keep one row."""
    # each step keeps only what the next one needs: an exploded row carries no siblings
    batches = jobs.select("job_id", F.posexplode("api_total_counts.summaries").alias("batch_index", "s")).select(
        "job_id",
        "batch_index",
        F.coalesce(F.col("s.rate_limits.app_usage_pct"), F.lit(0.0)).alias("app_usage_pct"),
        F.col("s.rate_limits.account_details").alias("details"),
    )
    accounts = batches.select(
        "job_id", "batch_index", "app_usage_pct", F.posexplode_outer("details").alias("account_index", "a")
    )
    uses = F.col("a.business_use_cases")

    def total(field: str) -> Column:
        return F.aggregate(uses, F.lit(0), lambda acc, u: acc + F.coalesce(u[field], F.lit(0)))

    insights_tier = F.filter(uses, lambda u: u["type"] == "ads_insights")
    return accounts.select(
        "job_id",
        "batch_index",
        "account_index",
        "app_usage_pct",
        F.col("a.account_id").alias("account_id"),
        F.coalesce(F.col("a.insights_usage_pct"), F.lit(0.0)).alias("insights_usage_pct"),
        F.coalesce(F.col("a.eta_seconds"), F.lit(0)).alias("eta_seconds"),
        F.coalesce(total("total_cputime"), F.lit(0)).alias("cpu_time"),
        F.coalesce(total("total_time"), F.lit(0)).alias("total_time"),
        # the last use case of the kind names the tier
        F.try_element_at(insights_tier, F.lit(-1))["ads_api_access_tier"].alias("tier"),
    )


def header_map(headers: Column) -> Column:
    """``[{name, value}]`` as a map with lower-cased names; a repeated name keeps its last value."""
    lowered = F.transform(headers, lambda h: F.struct(F.lower(text(h["name"])).alias("k"), h["value"].alias("v")))
    last = F.filter(
        lowered,
        lambda h, i: ~F.exists(
            F.slice(lowered, i + 2, F.greatest(F.size(lowered) - i - 1, F.lit(0))), lambda later: later["k"] == h["k"]
        ),
    )
    return F.map_from_entries(last)


def header_value(headers: Column, name: str) -> Column:
    """Last value of one header, without building the whole map."""
    hits = F.filter(headers, lambda h: F.lower(h["name"]) == name)
    return F.try_element_at(hits, F.lit(-1))["value"]


def account_refs(df: DataFrame, column: str = "account") -> DataFrame:
    """Accounts given as plain ids or as ``{id, name}`` JSON objects, as two columns."""
    obj = F.from_json(column, NAMED)
    is_object = F.ltrim(column).startswith("{")
    return df.select(
        F.when(is_object, obj["id"]).otherwise(F.col(column)).alias("account_id"),
        F.when(is_object, obj["name"]).otherwise(F.concat(F.lit("Account "), F.col(column))).alias("account_name"),
    )
