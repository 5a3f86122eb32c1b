"""Job logs: life cycle, filters and the figures the dashboards show."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.operators.windows import count_categories, first_match

# Statuses, task types and categories used in job logs.
FAILED = ("FAILED", "FAILURE")
ACTIVE = ("PENDING", "STARTED", "RUNNING")
ACTIVE_COLUMNS = ("job_id", "task_type", "status", "progress", "last_message", "start_time", "message", "user_email")
SHOP_TASKS = ("product", "creative", "tiktok_product", "tiktok_creative")
SHOP_MARK = "tiktok.com"
ADS_MARKS = ("facebook", "fb")
ADS_KINDS = (("daily", "Daily"), ("performance", "Performance"), ("breakdown", "Breakdown"))
SHOP_KINDS = (("product", "Product"), ("creative", "Creative"))
STATUS_GROUPS = ("Success", "Failed", "Cancelled", "Started")
USAGE_BUCKETS = ("Safe (<75%)", "Warning (75-95%)", "Critical (>95%)")
CANCEL_MARK = "TaskCancelledException"
CANCEL_MESSAGE = "Task was cancelled by user."
LOG_NOT_FOUND = "Log not found."
RANGES = {"24h": 24, "7d": 7 * 24, "30d": 30 * 24}
ROW_LIMIT, DISPLAY_LIMIT = 10_000, 1_000


def in_range(jobs: DataFrame, time_range: str, as_of, task_types: Sequence[str] = ()) -> DataFrame:
    """Jobs started within the range before ``as_of``; any other range name means all."""
    out = jobs
    if time_range in RANGES:
        floor = F.lit(as_of).cast("timestamp") - F.make_interval(hours=F.lit(RANGES[time_range]))
        out = out.filter(F.col("start_time") >= floor)
    if task_types:
        out = out.filter(F.col("task_type").isin(*task_types))
    return out


def recent_jobs(jobs: DataFrame, time_range: str, as_of, task_types: Sequence[str] = (), limit: int = ROW_LIMIT) -> DataFrame:
    """Newest jobs of a range without their full log."""
    rows = in_range(jobs, time_range, as_of, task_types).drop("full_logs")
    return rows.orderBy(F.col("start_time").desc_nulls_last(), "job_id").limit(limit)


def active_jobs(jobs: DataFrame) -> DataFrame:
    return (
        jobs.filter(F.col("status").isin(*ACTIVE))
        .select(*ACTIVE_COLUMNS)
        .orderBy(F.col("start_time").desc_nulls_last(), "job_id")
    )


def with_status(jobs: DataFrame, status: str) -> DataFrame:
    if status == "all":
        return jobs
    return jobs.filter(F.upper(F.coalesce("status", F.lit(""))) == status.upper())


def ads_jobs(jobs: DataFrame) -> DataFrame:
    hit = F.lit(False)
    for mark in ADS_MARKS:
        hit = hit | F.col("task_type").contains(mark)
    return jobs.filter(hit)


def shop_jobs(jobs: DataFrame) -> DataFrame:
    marked = F.coalesce(F.to_json("api_total_counts").contains(SHOP_MARK), F.lit(False))
    return jobs.filter(F.coalesce(F.col("task_type").isin(*SHOP_TASKS), F.lit(False)) | marked)


def job_log(jobs: DataFrame, job_id: str) -> DataFrame:
    """Full log of one job, or the fixed text when there is no such job. Always one row."""
    found = jobs.filter(F.col("job_id") == job_id).agg(
        F.count(F.lit(1)).alias("n"), F.first(F.coalesce("full_logs", F.lit(""))).alias("log")
    )
    return found.select(F.when(F.col("n") > 0, F.col("log")).otherwise(F.lit(LOG_NOT_FOUND)).alias("full_logs"))


def kpis(jobs: DataFrame) -> DataFrame:
    """Totals, success rate in %, mean duration of finished jobs and users with a mail address."""
    ok = F.col("status") == "SUCCESS"
    ran = F.when(F.col("duration_seconds") > 0, F.col("duration_seconds"))
    mail = F.when(F.col("user_email").contains("@"), F.col("user_email"))
    total = F.count(F.lit(1))
    good = F.count_if(ok)
    return jobs.agg(
        total.alias("total_tasks"),
        good.alias("successful_tasks"),
        F.coalesce(F.round(F.lit(100.0) * good / F.nullif(total, F.lit(0)), 1), F.lit(0.0)).alias("success_rate"),
        F.coalesce(F.round(F.avg(ran), 1), F.lit(0.0)).alias("avg_duration"),
        F.count_distinct(mail).alias("unique_users"),
    )


def count_by(jobs: DataFrame, column: str, missing: str | None = None) -> DataFrame:
    """Jobs per value. ``missing`` names the empty ones; without it they are left out."""
    c = F.nullif(F.col(column), F.lit(""))
    keyed = jobs.select((F.coalesce(c, F.lit(missing)) if missing else c).alias(column))
    if missing is None:
        keyed = keyed.filter(F.col(column).isNotNull())
    return keyed.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def failed_by_user(jobs: DataFrame) -> DataFrame:
    return count_by(jobs.filter(F.col("status").isin(*FAILED)), "user_email", missing="Unknown")


def top(counts: DataFrame, name: str, n: int) -> DataFrame:
    return counts.orderBy(F.col("n").desc(), F.col(name)).limit(n)


def status_group(status: Column) -> Column:
    s = F.upper(F.coalesce(status, F.lit("")))
    return (
        F.when(s.isin("SUCCESS", "COMPLETED"), "Success")
        .when(s.isin("CANCELLED", "REVOKED"), "Cancelled")
        .when(s.isin("STARTED", "RUNNING"), "Started")
        .otherwise("Failed")
    )


def status_groups(jobs: DataFrame) -> DataFrame:
    return count_categories(jobs, status_group(F.col("status")), STATUS_GROUPS, "status_group")


def ads_kinds(jobs: DataFrame) -> DataFrame:
    names = [n for _, n in ADS_KINDS] + ["Other"]
    return count_categories(jobs, first_match(F.col("task_type"), ADS_KINDS, "Other"), names)


def shop_kinds(jobs: DataFrame) -> DataFrame:
    names = [n for _, n in SHOP_KINDS] + ["Other"]
    return count_categories(jobs, first_match(F.col("task_type"), SHOP_KINDS, "Other"), names)


def summaries(jobs: DataFrame) -> DataFrame:
    return jobs.select("job_id", F.explode("api_total_counts.summaries").alias("s"))


def usage_buckets(jobs: DataFrame, scale: float = 1.0) -> DataFrame:
    used = F.coalesce(F.col("s.rate_limits.app_usage_pct"), F.lit(0.0)) * F.lit(float(scale))
    safe, warning, critical = USAGE_BUCKETS
    bucket = F.when(used >= 95, critical).when(used >= 75, warning).otherwise(safe)
    return count_categories(summaries(jobs), bucket, USAGE_BUCKETS, "bucket")


def batch_totals(jobs: DataFrame) -> DataFrame:
    """Jobs, batches, clean batches and seconds waited. Nothing is exploded: sums stay per job."""
    api = F.col("api_total_counts")
    clean = F.filter(api["summaries"], lambda s: (s["success_count"] > 0) & (s["error_count"] == 0))
    size = lambda c: F.coalesce(F.greatest(F.size(c), F.lit(0)), F.lit(0))
    return jobs.agg(
        F.count(F.lit(1)).alias("total_tasks"),
        F.coalesce(F.sum(size(api["summaries"])), F.lit(0)).alias("total_batches"),
        F.coalesce(F.sum(size(clean)), F.lit(0)).alias("success_batches"),
        F.coalesce(F.sum(F.coalesce(api["total_backoff_sec"], F.lit(0))), F.lit(0)).alias("total_backoff"),
    )


def kind_counts(jobs: DataFrame) -> DataFrame:
    return jobs.agg(
        F.count(F.lit(1)).alias("total_tasks"),
        F.count_if(F.col("task_type").contains("product")).alias("product_tasks"),
        F.count_if(F.col("task_type").contains("creative")).alias("creative_tasks"),
    )


# -- life cycle ----------------------------------------------------------------------


def lifecycle(events: DataFrame) -> DataFrame:
    """Current state of every job from its ``start``, ``progress`` and ``end`` events.

    ``events``: job_id, kind, ts, status, progress, message. An end beats any
    progress, and progress beats the start, whatever order they arrive in. A
    cancel mark in the end message wins over the status the worker reported.
    Everything is a mergeable aggregate, so the same code runs on a stream.
    """
    t = F.col("ts").cast("timestamp")
    kind = F.col("kind")
    rank = F.when(kind == "end", 2).when(kind == "progress", 1).otherwise(0)
    cancelled = (kind == "end") & F.coalesce(F.col("message").contains(CANCEL_MARK), F.lit(False))
    status = (
        F.when(cancelled, "CANCELLED")
        .when(kind == "start", "STARTED")
        .when(kind == "progress", F.coalesce("status", F.lit("RUNNING")))
        .otherwise(F.coalesce("status", F.lit("FAILED")))
    )
    message = F.when(cancelled, CANCEL_MESSAGE).otherwise(F.col("message"))
    order = F.struct(rank, t, status)
    state = events.groupBy("job_id").agg(
        F.min(F.when(kind == "start", t)).alias("start_time"),
        F.max(F.when(kind == "end", t)).alias("end_time"),
        F.max_by(status, order).alias("status"),
        F.max_by(F.col("progress"), F.when(kind == "progress", F.struct(t, F.col("progress")))).alias("progress"),
        F.max_by(F.col("message"), F.when(kind == "progress", F.struct(t, F.col("progress")))).alias("last_message"),
        F.max_by(message, F.when(kind == "end", F.struct(t, status))).alias("message"),
    )
    length = (F.unix_micros("end_time") - F.unix_micros("start_time")) / F.lit(1e6)
    return state.withColumn(
        "duration_seconds",
        F.when(F.col("end_time").isNull(), F.lit(None).cast("double"))
        .when(F.col("start_time").isNull(), F.lit(-1.0))
        .otherwise(F.round(length, 2)),
    )
