"""Gold models: dimensions and facts on top of the silver rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.operators.enrich import region_dimension
from adlake.operators.latest import distinct_dimension, newer_than
from adlake.operators.quality import Check

# Fact columns (output, silver column) and ad dimension columns.
CAMPAIGN_FACT = (
    *[(c, c) for c in (
        "surrogate_key", "created_at", "account_id", "campaign_id", "date_start", "date_stop", "spend", "reach",
        "impressions", "cpc", "cpm", "ctr", "clicks", "frequency", "cost_per_unique_inline_link_click",
    )],
    ("post_engagement", "post_engagement_count"),
    *[(c, c) for c in ("page_engagement", "comment_count", "video_view_count", "post_reaction_count")],
    ("message_count", "onsite_conversion_messaging_welcome_message"),
)
LOCATION_FACT = (
    "surrogate_key", "created_at", "ad_id", "date_start", "date_stop", "region", "spend", "impressions", "cpc", "cpm",
    "ctr", "clicks", "total_messaging_connection",
)
AD_ATTRIBUTES = (
    "campaign_id", "adset_id", "ad_name", "creative_id", "creative_name", "creative_body", "creative_title",
    "creative_thumbnail_url", "creative_link_url", "status", "page_name", "actor_id",
)


def dim_accounts(campaign_daily: DataFrame, since=None) -> DataFrame:
    return distinct_dimension(newer_than(campaign_daily, since), ["account_id"], ["account_name"])


def dim_campaigns(campaign_daily: DataFrame, since=None) -> DataFrame:
    return distinct_dimension(newer_than(campaign_daily, since), ["campaign_id"], ["account_id", "campaign_name"])


def dim_ads(ad_metadata: DataFrame, since=None) -> DataFrame:
    renamed = newer_than(ad_metadata, since).withColumnsRenamed({"id": "ad_id", "name": "ad_name"})
    return distinct_dimension(renamed, ["ad_id"], AD_ATTRIBUTES)


def dim_regions(ad_location: DataFrame, seed: DataFrame, as_of: Column | None = None) -> DataFrame:
    return region_dimension(ad_location, seed, as_of if as_of is not None else F.current_timestamp())


def fact_campaigns_daily(campaign_daily: DataFrame, since=None) -> DataFrame:
    """Silver already holds one row per key, so this is a projection without a shuffle."""
    return newer_than(campaign_daily, since).select(*[F.col(c).alias(out) for out, c in CAMPAIGN_FACT])


def fact_ad_location_daily(ad_location: DataFrame, since=None) -> DataFrame:
    return newer_than(ad_location, since).select(*LOCATION_FACT)


# The data tests of every model.
def _checks(model: str, not_null=(), unique=()) -> list[Check]:
    return [Check(model, "not_null", c) for c in not_null] + [Check(model, "unique", c) for c in unique]


_SILVER = ("surrogate_key", "job_id", "created_at")
CHECKS = [
    *_checks("stg_account_daily", _SILVER, ["surrogate_key"]),
    *_checks("stg_campaign_daily", _SILVER, ["surrogate_key"]),
    *_checks("stg_ad_set_daily", _SILVER, ["surrogate_key"]),
    *_checks("stg_ad_daily", _SILVER, ["surrogate_key"]),
    *_checks("stg_ad_daily_location", _SILVER, ["surrogate_key"]),
    *_checks("stg_ad_age_gender_daily", _SILVER, ["surrogate_key"]),
    *_checks("stg_ad_metadata", ("id", "job_id", "created_at"), ["id"]),
    *_checks("fact_campaigns_daily", ("surrogate_key", "created_at", "account_id", "campaign_id"), ["surrogate_key"]),
    *_checks("fact_ad_location_daily", ("surrogate_key", "created_at", "ad_id"), ["surrogate_key"]),
    Check("fact_ad_location_daily", "relationships", "ad_id", "dim_ads", "ad_id"),
    Check("fact_ad_location_daily", "relationships", "region", "dim_regions", "region"),
    *_checks("dim_accounts", ("account_id", "account_name"), ["account_id"]),
    *_checks("dim_campaigns", ("campaign_id", "account_id"), ["campaign_id"]),
    *_checks("dim_ads", ("ad_id", "campaign_id"), ["ad_id"]),
    *_checks("dim_regions", ("region",), ["region"]),
]
