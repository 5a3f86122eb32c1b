"""Job-log figures over the events table, each event read as one job."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlake.operators import joblog as jl
from adlake.operators import unnest
from adlake.plans import dashboards
from adlake.workload.derive import _pick, as_table, spread, table
from adlake.workload.registry import query

AS_OF = "2024-01-31 00:00:00"
STATUSES = ["SUCCESS", "COMPLETED", "FAILED", "FAILURE", "STARTED", "RUNNING", "PENDING", "CANCELLED", "REVOKED"]
ACCESS = ["standard_access", "development_access"]

JOBS_SQL = """
jobs AS (
  SELECT *, event_id % 8 <> 7 AS has_api FROM (
    SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           concat('job_', lpad(CAST(event_id AS VARCHAR), 12, '0')) AS job_id,
           CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 'fb_other'
                WHEN event_type = 'click' THEN 'facebook_daily' WHEN event_type = 'view' THEN 'facebook_performance'
                WHEN event_type = 'purchase' THEN 'product' WHEN event_type = 'error' THEN 'facebook_breakdown'
                ELSE 'tiktok_creative' END AS task_type,
           CASE WHEN user_id % 13 = 0 THEN NULL WHEN user_id % 17 = 0 THEN concat('user', user_id)
                ELSE concat('user', user_id, '@example.com') END AS user_email,
           ['SUCCESS','COMPLETED','FAILED','FAILURE','STARTED','RUNNING','PENDING','CANCELLED','REVOKED']
             [event_id % 9 + 1] AS status,
           ts AS start_time,
           CASE WHEN event_id % 10 = 0 THEN -1.0 WHEN event_id % 7 = 0 THEN NULL ELSE value END AS duration_seconds
    FROM events)
),
batches AS (
  SELECT job_id, event_id, user_id, k, e AS batch_index, (k + e) % 5 AS success_count, (k + 2 * e) % 3 AS error_count,
         CAST((k + e * 7) % 101 AS DOUBLE) AS app_usage_pct, task_type
  FROM jobs, (VALUES (0), (1)) AS t(e) WHERE has_api
),
accounts AS (
  SELECT b.*, a AS account_index, concat('act_', (user_id + a * 3) % 40) AS account_id,
         CAST((k * 3 + a * 11 + batch_index) % 100 AS DOUBLE) AS insights_usage_pct,
         (k * 7 + a * 5 + batch_index) % 400 AS eta_seconds,
         CASE WHEN (k + a) % 7 = 6 THEN 0 ELSE (k + a * 9) % 100 + (k + a * 9 + 5) % 100 END AS cpu_time,
         CASE WHEN (k + a) % 7 = 6 THEN 0 ELSE (k * 2) % 100 + (k * 2 + 30) % 100 END AS total_time,
         CASE WHEN (k + a) % 7 = 6 THEN NULL WHEN k % 2 = 0 THEN 'standard_access' ELSE 'development_access' END AS tier
  FROM batches b, (VALUES (0), (1)) AS t(a) WHERE (k + batch_index) % 6 <> 5
)"""
WITH = "WITH " + JOBS_SQL


def _summary(e: int):
    k, user = F.col("k"), F.col("user_id")

    def case(a: int, b: int):
        return F.struct(
            F.lit(["ads_insights", "ads_management"][b]).alias("type"),
            ((k * 5 + b * 50) % 200).alias("call_count"),
            ((k + a * 9 + b * 5) % 100).alias("total_cputime"),
            ((k * 2 + b * 30) % 100).alias("total_time"),
            F.lit(0).alias("estimated_time_to_regain_access"),
            (_pick(ACCESS, k % 2) if b == 0 else F.lit("x")).alias("ads_api_access_tier"),
        )

    def account(a: int):
        return F.struct(
            F.concat(F.lit("act_"), ((user + a * 3) % 40).cast("string")).alias("account_id"),
            ((k * 3 + a * 11 + e) % 100).cast("double").alias("insights_usage_pct"),
            ((k * 7 + a * 5 + e) % 400).alias("eta_seconds"),
            F.when((k + a) % 7 != 6, F.array(case(a, 0), case(a, 1))).alias("business_use_cases"),
        )

    origin = F.when(F.col("event_id") % 23 == 0, "https://business-api.tiktok.com/open_api/v1.3/")
    return F.struct(
        origin.alias("timestamp"),
        ((k + e) % 5).alias("success_count"),
        ((k + 2 * e) % 3).alias("error_count"),
        F.struct(
            ((k + e * 7) % 101).cast("double").alias("app_usage_pct"),
            F.when((k + e) % 6 != 5, F.array(account(0), account(1))).alias("account_details"),
        ).alias("rate_limits"),
    )


def job_log(spark, folder):
    ev = spread(table(spark, folder, "events")).withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    n, kind, user = F.col("event_id"), F.col("event_type"), F.col("user_id")
    task = (
        F.when(n % 11 == 0, None).when(n % 19 == 0, "fb_other").when(kind == "click", "facebook_daily")
        .when(kind == "view", "facebook_performance").when(kind == "purchase", "product")
        .when(kind == "error", "facebook_breakdown").otherwise("tiktok_creative")
    )
    name = F.concat(F.lit("user"), user.cast("string"))
    api = F.struct(
        F.array(_summary(0), _summary(1)).alias("summaries"), F.lit(2).alias("batch_count"),
        (F.col("k") % 4 * 5).alias("total_backoff_sec"),
    )
    return ev.select(
        F.concat(F.lit("job_"), F.lpad(n.cast("string"), 12, "0")).alias("job_id"),
        task.alias("task_type"),
        F.when(user % 13 == 0, None).when(user % 17 == 0, name).otherwise(F.concat(name, F.lit("@example.com"))).alias("user_email"),
        _pick(STATUSES, n % 9).alias("status"),
        F.col("ts").cast("timestamp").alias("start_time"),
        F.when(n % 10 == 0, -1.0).when(n % 7 == 0, None).otherwise(F.col("value")).alias("duration_seconds"),
        F.col("k").alias("progress"),
        F.concat(F.lit("step "), F.col("k").cast("string")).alias("last_message"),
        F.concat(F.lit("done "), F.col("k").cast("string")).alias("message"),
        F.concat(F.lit("log of "), n.cast("string")).alias("full_logs"),
        F.when(n % 8 != 7, api).alias("api_total_counts"),
    )


def job_table(spark, folder):
    """The job log for figures that go through its nested usage."""
    return as_table(job_log(spark, folder))



@query("status_counts", WITH + " SELECT status, count(*) AS n FROM jobs GROUP BY status")
def status_counts(spark, folder):
    return jl.count_by(job_log(spark, folder), "status", missing="undefined")


@query("task_type_counts", WITH + " SELECT coalesce(task_type, 'Unknown') AS task_type, count(*) AS n FROM jobs GROUP BY 1")
def task_type_counts(spark, folder):
    return jl.count_by(job_log(spark, folder), "task_type", missing="Unknown")


def _filled(spine, source, key):
    rows = ", ".join(f"('{v}')" for v in spine)
    return f"SELECT s.c AS {key}, count(x.c) AS n FROM (VALUES {rows}) s(c) LEFT JOIN ({source}) x ON x.c = s.c GROUP BY s.c"


_ADS = "coalesce(task_type LIKE '%facebook%' OR task_type LIKE '%fb%', false)"
_SHOP = (
    "(coalesce(task_type IN ('product','creative','tiktok_product','tiktok_creative'), false)"
    " OR (has_api AND event_id % 23 = 0))"
)
_ADS_KIND = (
    "CASE WHEN task_type LIKE '%daily%' THEN 'Daily' WHEN task_type LIKE '%performance%' THEN 'Performance' "
    "WHEN task_type LIKE '%breakdown%' THEN 'Breakdown' ELSE 'Other' END"
)
_SHOP_KIND = (
    "CASE WHEN task_type LIKE '%product%' THEN 'Product' WHEN task_type LIKE '%creative%' THEN 'Creative' ELSE 'Other' END"
)
_GROUP = (
    "CASE WHEN status IN ('SUCCESS','COMPLETED') THEN 'Success' WHEN status IN ('CANCELLED','REVOKED') THEN 'Cancelled' "
    "WHEN status IN ('STARTED','RUNNING') THEN 'Started' ELSE 'Failed' END"
)


@query(
    "category_zero_fill",
    WITH + _filled(["Daily", "Performance", "Breakdown", "Other"], f"SELECT {_ADS_KIND} AS c FROM jobs WHERE {_ADS}", "category"),
)
def category_zero_fill(spark, folder):
    return jl.ads_kinds(jl.ads_jobs(job_log(spark, folder)))


@query(
    "shop_category_zero_fill",
    WITH + _filled(["Product", "Creative", "Other"], f"SELECT {_SHOP_KIND} AS c FROM jobs WHERE {_SHOP}", "category"),
)
def shop_category_zero_fill(spark, folder):
    return jl.shop_kinds(jl.shop_jobs(job_table(spark, folder)))


@query(
    "status_rollup",
    WITH + _filled(["Success", "Failed", "Cancelled", "Started"], f"SELECT {_GROUP} AS c FROM jobs WHERE {_ADS}", "status_group"),
)
def status_rollup(spark, folder):
    return jl.status_groups(jl.ads_jobs(job_log(spark, folder)))


@query(
    "usage_buckets",
    WITH + _filled(
        ["Safe (<75%)", "Warning (75-95%)", "Critical (>95%)"],
        "SELECT CASE WHEN app_usage_pct >= 95 THEN 'Critical (>95%)' WHEN app_usage_pct >= 75 THEN 'Warning (75-95%)' "
        f"ELSE 'Safe (<75%)' END AS c FROM batches WHERE {_ADS}", "bucket",
    ),
)
def usage_buckets(spark, folder):
    return jl.usage_buckets(jl.ads_jobs(job_table(spark, folder)))


@query(
    "overview_kpis",
    WITH + """ SELECT count(*) AS total_tasks, count(*) FILTER (status = 'SUCCESS') AS successful_tasks,
  round(100.0 * count(*) FILTER (status = 'SUCCESS') / count(*)::DOUBLE, 1) AS success_rate,
  round(avg(duration_seconds) FILTER (duration_seconds > 0), 1) AS avg_duration,
  count(DISTINCT user_email) FILTER (user_email LIKE '%@%') AS unique_users FROM jobs""",
)
def overview_kpis(spark, folder):
    return jl.kpis(job_log(spark, folder))


@query(
    "top_failed_users",
    WITH + """ SELECT coalesce(user_email, 'Unknown') AS user_email, count(*) AS n FROM jobs
  WHERE status IN ('FAILED', 'FAILURE') GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10""",
)
def top_failed_users(spark, folder):
    return jl.top(jl.failed_by_user(job_log(spark, folder)), "user_email", 10)


@query(
    "top_users",
    WITH + " SELECT user_email, count(*) AS n FROM jobs WHERE user_email IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 5",
)
def top_users(spark, folder):
    return jl.top(jl.count_by(job_log(spark, folder), "user_email"), "user_email", 5)


@query(
    "recent_jobs",
    WITH + f""" SELECT job_id, task_type, user_email, status, start_time, duration_seconds FROM jobs
  WHERE start_time >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AND task_type IN ('facebook_daily', 'product')
  ORDER BY start_time DESC, job_id LIMIT 10000""",
)
def recent_jobs(spark, folder):
    rows = jl.recent_jobs(job_log(spark, folder), "7d", AS_OF, ["facebook_daily", "product"])
    return rows.select("job_id", "task_type", "user_email", "status", "start_time", "duration_seconds")


@query(
    "active_jobs",
    WITH + """ SELECT job_id, task_type, status, k AS progress, concat('step ', k) AS last_message, start_time,
  concat('done ', k) AS message, user_email FROM jobs WHERE status IN ('PENDING', 'STARTED', 'RUNNING')""",
)
def active_jobs(spark, folder):
    return jl.active_jobs(job_log(spark, folder))


@query(
    "job_log_lookup",
    WITH + " SELECT coalesce(max(concat('log of ', event_id)), 'Log not found.') AS full_logs FROM jobs"
    " WHERE job_id = 'job_000000000042'",
)
def job_log_lookup(spark, folder):
    return jl.job_log(job_log(spark, folder), "job_000000000042")


@query(
    "ads_batch_totals",
    WITH + f""" SELECT (SELECT count(*) FROM jobs WHERE {_ADS}) AS total_tasks,
  (SELECT count(*) FROM batches WHERE {_ADS}) AS total_batches,
  (SELECT count(*) FROM batches WHERE {_ADS} AND success_count > 0 AND error_count = 0) AS success_batches,
  (SELECT CAST(sum(CASE WHEN has_api THEN k % 4 * 5 ELSE 0 END) AS BIGINT) FROM jobs WHERE {_ADS}) AS total_backoff""",
)
def ads_batch_totals(spark, folder):
    return jl.batch_totals(jl.ads_jobs(job_table(spark, folder)))


@query(
    "shop_kind_counts",
    WITH + f""" SELECT count(*) AS total_tasks, count(*) FILTER (task_type LIKE '%product%') AS product_tasks,
  count(*) FILTER (task_type LIKE '%creative%') AS creative_tasks FROM jobs WHERE {_SHOP}""",
)
def shop_kind_counts(spark, folder):
    return jl.kind_counts(jl.shop_jobs(job_table(spark, folder)))


@query(
    "jobs_with_status",
    WITH + " SELECT job_id, status FROM jobs WHERE upper(status) = upper('cancelled')",
)
def jobs_with_status(spark, folder):
    return jl.with_status(job_log(spark, folder), "cancelled").select("job_id", "status")


@query(
    "usage_rows",
    WITH + """ SELECT b.job_id, b.batch_index, a.account_index, b.app_usage_pct, a.account_id,
  coalesce(a.insights_usage_pct, 0.0) AS insights_usage_pct, coalesce(a.eta_seconds, 0) AS eta_seconds,
  coalesce(a.cpu_time, 0) AS cpu_time, coalesce(a.total_time, 0) AS total_time, a.tier
  FROM batches b LEFT JOIN accounts a ON a.job_id = b.job_id AND a.batch_index = b.batch_index""",
)
def usage_rows(spark, folder):
    return unnest.usage_rows(job_table(spark, folder))


@query(
    "account_usage",
    WITH + """ SELECT job_id, account_id, max(insights_usage_pct) AS max_insights, max(eta_seconds) AS max_eta,
  count(*) AS call_count, coalesce(arg_max(tier, batch_index * 10 + account_index) FILTER (tier IS NOT NULL), 'N/A') AS tier
  FROM accounts GROUP BY 1, 2""",
)
def account_usage(spark, folder):
    return dashboards.job_detail(job_table(spark, folder))["accounts"]


@query(
    "batch_load",
    WITH + """ SELECT b.job_id, b.batch_index, max(b.app_usage_pct) AS app_usage, coalesce(max(cpu_time), 0) AS max_cpu,
  coalesce(max(total_time), 0) AS max_total_time FROM batches b
  LEFT JOIN accounts a ON a.job_id = b.job_id AND a.batch_index = b.batch_index GROUP BY 1, 2""",
)
def batch_load(spark, folder):
    return dashboards.job_detail(job_table(spark, folder))["batches"]


@query(
    "padded_series",
    WITH + """ SELECT s.job_id, s.account_id, s.batch_index, coalesce(max(insights_usage_pct), 0.0) AS insights_usage,
  coalesce(max(eta_seconds), 0) AS eta, coalesce(max(cpu_time), 0) AS cpu_time, coalesce(max(total_time), 0) AS total_time
  FROM (SELECT DISTINCT job_id, account_id, e AS batch_index FROM accounts, (VALUES (0), (1)) t(e)) s
  LEFT JOIN accounts a ON a.job_id = s.job_id AND a.account_id = s.account_id AND a.batch_index = s.batch_index
  GROUP BY 1, 2, 3""",
)
def padded_series(spark, folder):
    return dashboards.job_detail(job_table(spark, folder))["series"]


# -- life cycle ----------------------------------------------------------------------

# events of one user and day are one job: signups start it, clicks report progress,
# errors and purchases end it
LIFE_SQL = """
life AS (
  SELECT concat('job_', user_id, '_', strftime(ts, '%Y%m%d')) AS job_id, ts,
         CASE event_type WHEN 'signup' THEN 'start' WHEN 'error' THEN 'end' WHEN 'purchase' THEN 'end' ELSE 'progress' END AS kind,
         CASE event_type WHEN 'signup' THEN 'STARTED' WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'SUCCESS'
              ELSE 'RUNNING' END AS status,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS progress,
         CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'TaskCancelledException: stop'
              ELSE concat(event_type, ' ', event_id) END AS message
  FROM events
),
fixed AS (
  SELECT *, CASE kind WHEN 'start' THEN 0 WHEN 'progress' THEN 1 ELSE 2 END AS rank,
         CASE WHEN kind = 'end' AND message LIKE '%TaskCancelledException%' THEN 'CANCELLED' ELSE status END AS state,
         CASE WHEN kind = 'end' AND message LIKE '%TaskCancelledException%' THEN 'Task was cancelled by user.' ELSE message END AS told
  FROM life
)"""


def job_events(events):
    kind = F.col("event_type")
    return events.select(
        F.concat(F.lit("job_"), F.col("user_id").cast("string"), F.lit("_"), F.date_format("ts", "yyyyMMdd")).alias("job_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(kind == "signup", "start").when(kind.isin("error", "purchase"), "end").otherwise("progress").alias("kind"),
        F.when(kind == "signup", "STARTED").when(kind == "error", "FAILED").when(kind == "purchase", "SUCCESS")
        .otherwise("RUNNING").alias("status"),
        F.get_json_object("props", "$.k").cast("int").alias("progress"),
        F.when((kind == "error") & (F.col("event_id") % 3 == 0), "TaskCancelledException: stop")
        .otherwise(F.concat(kind, F.lit(" "), F.col("event_id").cast("string"))).alias("message"),
    )


LIFECYCLE_SQL = "WITH " + LIFE_SQL + """
SELECT job_id, min(ts) FILTER (kind = 'start') AS start_time, max(ts) FILTER (kind = 'end') AS end_time,
       arg_max(state, (rank, ts, state)) AS status,
       arg_max(progress, (ts, progress)) FILTER (kind = 'progress') AS progress,
       arg_max(message, (ts, progress)) FILTER (kind = 'progress') AS last_message,
       arg_max(told, (ts, state)) FILTER (kind = 'end') AS message,
       CASE WHEN max(ts) FILTER (kind = 'end') IS NULL THEN NULL WHEN min(ts) FILTER (kind = 'start') IS NULL THEN -1.0
            ELSE round((epoch_us(max(ts) FILTER (kind = 'end')) - epoch_us(min(ts) FILTER (kind = 'start'))) / 1e6, 2) END
         AS duration_seconds
FROM fixed GROUP BY job_id"""


@query("job_lifecycle", LIFECYCLE_SQL)
def job_lifecycle(spark, folder):
    return jl.lifecycle(job_events(table(spark, folder, "events")))


# -- whole dashboards, one scan each --------------------------------------------------------

_WEEK = f"start_time >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY"


def _top(card, key, where, n):
    return (
        f"SELECT * FROM (SELECT '{card}' AS card, k AS key, CAST(n AS DOUBLE) AS value, CAST(row_number() OVER (ORDER BY n DESC, k) AS INTEGER) AS position"
        f" FROM (SELECT {key} AS k, count(*) AS n FROM c WHERE {where} GROUP BY 1) QUALIFY position <= {n})"
    )


@query(
    "overview_dashboard",
    WITH + f""", c AS (SELECT * FROM jobs WHERE {_WEEK})
SELECT 'kpis' AS card, 'total_tasks' AS key, CAST(count(*) AS DOUBLE) AS value, CAST(NULL AS INTEGER) AS position FROM c
UNION ALL SELECT 'kpis', 'successful_tasks', count(*) FILTER (status = 'SUCCESS'), NULL FROM c
UNION ALL SELECT 'kpis', 'success_rate', coalesce(round(100.0 * count(*) FILTER (status = 'SUCCESS') / nullif(count(*), 0), 1), 0), NULL FROM c
UNION ALL SELECT 'kpis', 'avg_duration', coalesce(round(avg(duration_seconds) FILTER (duration_seconds > 0), 1), 0), NULL FROM c
UNION ALL SELECT 'kpis', 'unique_users', count(DISTINCT user_email) FILTER (user_email LIKE '%@%'), NULL FROM c
UNION ALL SELECT 'by_status', coalesce(nullif(status, ''), 'undefined'), count(*), NULL FROM c GROUP BY 2
UNION ALL SELECT 'by_task_type', coalesce(nullif(task_type, ''), 'Unknown'), count(*), NULL FROM c GROUP BY 2
UNION ALL {_top("top_users", "nullif(user_email, '')", "nullif(user_email, '') IS NOT NULL", 5)}
UNION ALL {_top("top_failed_users", "coalesce(nullif(user_email, ''), 'Unknown')", "status IN ('FAILED', 'FAILURE')", 10)}""",
)
def overview_dashboard(spark, folder):
    return dashboards.overview_cards(job_log(spark, folder), "7d", AS_OF)


def _filled_card(card, spine, source):
    rows = ", ".join(f"('{v}')" for v in spine)
    return f"SELECT '{card}', s.c, CAST(count(x.c) AS DOUBLE), NULL FROM (VALUES {rows}) s(c) LEFT JOIN ({source}) x ON x.c = s.c GROUP BY s.c"


_BUCKET = (
    "CASE WHEN app_usage_pct >= 95 THEN 'Critical (>95%)' WHEN app_usage_pct >= 75 THEN 'Warning (75-95%)' ELSE 'Safe (<75%)' END"
)


@query(
    "ads_dashboard",
    WITH + f""", c AS (SELECT * FROM jobs WHERE {_ADS} AND {_WEEK}), b AS (SELECT * FROM batches WHERE job_id IN (SELECT job_id FROM c))
SELECT 'totals' AS card, 'total_tasks' AS key, CAST(count(*) AS DOUBLE) AS value, CAST(NULL AS INTEGER) AS position FROM c
UNION ALL SELECT 'totals', 'total_batches', count(*), NULL FROM b
UNION ALL SELECT 'totals', 'success_batches', count(*) FILTER (success_count > 0 AND error_count = 0), NULL FROM b
UNION ALL SELECT 'totals', 'total_backoff', coalesce(sum(CASE WHEN has_api THEN k % 4 * 5 ELSE 0 END), 0), NULL FROM c
UNION ALL {_filled_card("usage", ["Safe (<75%)", "Warning (75-95%)", "Critical (>95%)"], f"SELECT {_BUCKET} AS c FROM b")}
UNION ALL {_filled_card("by_kind", ["Daily", "Performance", "Breakdown", "Other"], f"SELECT {_ADS_KIND} AS c FROM c")}
UNION ALL {_filled_card("by_status", ["Success", "Failed", "Cancelled", "Started"], f"SELECT {_GROUP} AS c FROM c")}""",
)
def ads_dashboard(spark, folder):
    return dashboards.ads_cards(job_table(spark, folder), "7d", AS_OF)
