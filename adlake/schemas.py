"""Fixed schemas: the landing envelope, report payloads, telemetry and job logs."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()


def fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, _S) for name in names])


RAW = fields(job_id=_S, created_at=T.TimestampType(), data=_S)

ACTIONS = T.ArrayType(texts("action_type", "value"))

REGION_SEED = texts("region_code", "region_name", "region_type", "macro_region")

NAMED = texts("id", "name")
ENTITY = fields(
    id=_S,
    name=_S,
    status=_S,
    effective_status=_S,
    campaign=NAMED,
    adset=texts("id", "name", "bid_strategy", "bid_amount", "daily_budget", "lifetime_budget"),
    creative=texts("id", "name", "title", "body", "actor_id", "thumbnail_url", "object_story_id"),
)

PAGING = fields(next=_S, cursors=texts("before", "after"))

USE_CASES = T.ArrayType(
    fields(
        type=_S, call_count=_I, total_cputime=_I, total_time=_I, estimated_time_to_regain_access=_I,
        ads_api_access_tier=_S,
    )
)
ACCOUNT_DETAILS = T.ArrayType(
    fields(account_id=_S, insights_usage_pct=_D, eta_seconds=_I, business_use_cases=USE_CASES)
)
RATE_LIMITS = fields(app_usage_pct=_D, account_details=ACCOUNT_DETAILS)
BATCH_SUMMARY = fields(timestamp=_S, success_count=_I, error_count=_I, rate_limits=RATE_LIMITS)
API_COUNTS = fields(summaries=T.ArrayType(BATCH_SUMMARY), batch_count=_I, total_backoff_sec=_I)

JOB_LOG = fields(
    job_id=_S,
    task_type=_S,
    user_email=_S,
    status=_S,
    start_time=T.TimestampType(),
    end_time=T.TimestampType(),
    duration_seconds=_D,
    progress=_I,
    message=_S,
    last_message=_S,
    full_logs=_S,
    template_name=_S,
    advertiser_id=_S,
    store_id=_S,
    api_total_counts=API_COUNTS,
)

# Nested shop report. Metric maps are open: reports may ask for any metric.
METRICS = T.MapType(_S, _S)
CREATIVE = fields(
    item_id=_S,
    metrics=METRICS,
    metadata=texts("title", "tt_account_name", "tt_account_profile_image_url", "product_img"),
)
PRODUCT_PERFORMANCE = fields(
    dimensions=texts("campaign_id", "item_group_id", "stat_time_day"),
    metrics=METRICS,
    product_details=texts("product_title", "product_status", "product_image_url"),
    creative_details=T.ArrayType(CREATIVE),
)


def insight_payload(scalars, parents) -> T.StructType:
    """Payload of one report row: every scalar is text, every parent an action array."""
    return T.StructType(
        [T.StructField(s, _S) for s in scalars] + [T.StructField(p, ACTIONS) for p in parents]
    )


def page_envelope(item: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField("data", T.ArrayType(item)), T.StructField("paging", PAGING)]
    )
