"""API telemetry over the events table: call counts, quotas, errors and waits."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlake.functions import api_errors as ae
from adlake.operators import sets, usage, windows
from adlake.workload.derive import as_table, spread, table
from adlake.workload.joblogs import AS_OF
from adlake.workload.registry import query

HOUR = 3600


def calls(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", F.col("event_type").alias("endpoint"), F.col("ts").cast("timestamp").alias("ts")
    )


@query(
    "hourly_api_calls",
    "SELECT event_type AS endpoint, date_trunc('hour', ts) AS hour, count(*) AS calls FROM events GROUP BY ALL",
)
def hourly_api_calls(spark, folder):
    return windows.counts_by_hour(calls(spark, folder), "endpoint", "ts")


@query(
    "hourly_dense",
    f"""SELECT s.event_type AS endpoint, h AS hour, count(e.event_id) AS calls
FROM (SELECT DISTINCT event_type FROM events) s
CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '{AS_OF}' - INTERVAL 71 HOUR, TIMESTAMP '{AS_OF}', INTERVAL 1 HOUR)) AS h)
LEFT JOIN events e ON e.event_type = s.event_type AND date_trunc('hour', e.ts) = h GROUP BY ALL""",
)
def hourly_dense(spark, folder):
    hourly = windows.counts_by_hour(calls(spark, folder), "endpoint", "ts")
    return windows.dense_hours(hourly, AS_OF, hours=72)


@query("api_total_counts", "SELECT event_type AS endpoint, count(*) AS total FROM events GROUP BY ALL ORDER BY total DESC, endpoint")
def api_total_counts(spark, folder):
    hourly = windows.counts_by_hour(calls(spark, folder), "endpoint", "ts")
    totals = usage.category_totals(hourly, F.col("endpoint"), F.col("calls"))
    return totals.orderBy(F.col("total").desc(), "endpoint")


def _sliding_sql(span):
    return f"""SELECT event_id, event_type AS endpoint, count(*) OVER (PARTITION BY event_type ORDER BY ts
  RANGE BETWEEN INTERVAL '{span} seconds' PRECEDING AND CURRENT ROW) AS in_window FROM events"""


@query("sliding_20s", _sliding_sql("19.999999"))
def sliding_20s(spark, folder):
    return windows.sliding_count(calls(spark, folder), "endpoint", "ts", 20).drop("ts")


@query("sliding_6h", _sliding_sql(f"{6 * HOUR - 1}.999999"))
def sliding_6h(spark, folder):
    """The same count over a long window, where many calls fall together."""
    return windows.sliding_count(calls(spark, folder), "endpoint", "ts", 6 * HOUR, slice_factor=8).drop("ts")


@query(
    "fixed_quota",
    f"""WITH first AS (
  SELECT *, row_number() OVER (PARTITION BY event_type, floor(epoch_us(ts) / 3600000000) ORDER BY ts, event_id) <= 2 AS ok1
  FROM events),
second AS (
  SELECT event_id, row_number() OVER (PARTITION BY event_type, floor(epoch_us(ts) / 86400000000) ORDER BY ts, event_id) <= 20 AS ok2
  FROM first WHERE ok1)
SELECT event_id, event_type AS endpoint, ok1 AND coalesce(ok2, false) AS allowed FROM first LEFT JOIN second USING (event_id)""",
)
def fixed_quota(spark, folder):
    """At most 2 calls an hour and 20 a day per endpoint."""
    rules = [(20, 24 * HOUR), (2, HOUR)]
    return windows.fixed_quota(calls(spark, folder), "endpoint", "ts", ["event_id"], rules).drop("ts")


@query(
    "pending_wait",
    f"""WITH recent AS (
  SELECT event_type AS endpoint, (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(ts)) / 1e6 AS age FROM events
  WHERE ts <= TIMESTAMP '{AS_OF}' AND ts > TIMESTAMP '{AS_OF}' - INTERVAL 12 HOUR),
counts AS (SELECT endpoint, count(*) AS recent FROM recent GROUP BY 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY endpoint ORDER BY age DESC) AS r FROM recent JOIN counts USING (endpoint))
SELECT c.endpoint, c.recent, coalesce(max(greatest(43200 - age, 0.0)), 0.0) AS wait_seconds
FROM counts c LEFT JOIN ranked x ON x.endpoint = c.endpoint AND c.recent + 10 - 15 > 0 AND r = least(c.recent + 10 - 15, c.recent)
GROUP BY 1, 2""",
)
def pending_wait(spark, folder):
    """Wait before 10 more calls fit under 15 calls in 12 hours."""
    return windows.pending_wait(calls(spark, folder), "endpoint", "ts", AS_OF, adding=10, limit=15, seconds=12 * HOUR)


@query(
    "job_duration",
    """WITH s AS (SELECT concat(user_id, '_', strftime(ts, '%Y%m%d')) AS job_id,
  min(ts) FILTER (event_type = 'signup') AS start_time, max(ts) FILTER (event_type IN ('error', 'purchase')) AS end_time
  FROM events GROUP BY 1)
SELECT *, CASE WHEN start_time IS NULL THEN -1.0 ELSE round((epoch_us(end_time) - epoch_us(start_time)) / 1e6, 2) END
  AS duration_seconds FROM s WHERE end_time IS NOT NULL""",
)
def job_duration(spark, folder):
    ev = table(spark, folder, "events").withColumn(
        "job_id", F.concat(F.col("user_id").cast("string"), F.lit("_"), F.date_format("ts", "yyyyMMdd"))
    )
    kind = F.col("event_type")
    return windows.run_length(ev, "job_id", "ts", kind == "signup", kind.isin("error", "purchase"))


# -- answers of batched requests -------------------------------------------------------

CODES = "[4, 17, 32, 613, 80000, 80003, 80004, 10, 190, 500, 503, 400, 403, 404, 1, NULL]"
ANSWERS_SQL = f"""
answers AS (
  SELECT event_id // 20 AS batch_id, CAST(event_id % 20 AS INTEGER) AS request_index, k,
         CASE WHEN k < 50 THEN 200 WHEN k < 60 THEN 403 WHEN k < 75 THEN 500 ELSE 400 END AS status_code,
         CASE WHEN k >= 50 THEN {CODES}[k % 16 + 1] END AS error_code,
         CASE WHEN k >= 50 THEN [2446079, 1996, NULL, 99][event_id % 4 + 1] END AS error_subcode,
         event_id
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""
TYPED_SQL = ANSWERS_SQL + """,
typed AS (
  SELECT *, CASE WHEN status_code = 200 THEN NULL WHEN error_code IS NULL THEN 'unknown'
    WHEN error_code IN (4, 17, 32, 613, 80000, 80003, 80004) OR coalesce(error_subcode IN (2446079, 1996), false) THEN 'rate_limit'
    WHEN error_code IN (10, 190) THEN 'permission' WHEN error_code >= 500 THEN 'server_error'
    WHEN error_code >= 400 THEN 'invalid_request' ELSE 'unknown' END AS error_type
  FROM answers
),
waits AS (
  SELECT *, error_type IN ('rate_limit', 'server_error', 'unknown') AS is_retryable,
    CASE error_type WHEN 'rate_limit' THEN CASE WHEN error_code = 4 THEN 300
        WHEN error_code = 17 AND error_subcode = 2446079 THEN 300 WHEN error_code IN (80000, 80004) THEN 600 ELSE 180 END
      WHEN 'server_error' THEN 30 WHEN 'unknown' THEN 60 ELSE 0 END AS backoff_seconds,
    CASE WHEN error_type = 'rate_limit' THEN CASE error_code WHEN 4 THEN 'App rate limit' WHEN 17 THEN 'User rate limit'
      WHEN 32 THEN 'Page rate limit' WHEN 613 THEN 'Custom rate limit' WHEN 80000 THEN 'Ads Insights rate limit'
      WHEN 80003 THEN 'Custom Audience rate limit' WHEN 80004 THEN 'Ads Management rate limit'
      ELSE 'Unknown rate limit' END END AS rate_limit_type
  FROM typed
)"""


def answers(spark, folder):
    k, n = F.get_json_object("props", "$.k").cast("int"), F.col("event_id")
    codes = F.array(*[F.lit(c) for c in (4, 17, 32, 613, 80000, 80003, 80004, 10, 190, 500, 503, 400, 403, 404, 1, None)])
    subs = F.array(*[F.lit(c) for c in (2446079, 1996, None, 99)])
    return table(spark, folder, "events").select("event_id", k.alias("k")).select(
        F.expr("event_id div 20").alias("batch_id"),
        (n % 20).cast("int").alias("request_index"),
        "k",
        F.when(F.col("k") < 50, 200).when(F.col("k") < 60, 403).when(F.col("k") < 75, 500).otherwise(400).alias("status_code"),
        F.when(F.col("k") >= 50, F.get(codes, F.col("k") % 16)).alias("error_code"),
        F.when(F.col("k") >= 50, F.get(subs, (n % 4).cast("int"))).alias("error_subcode"),
        "event_id",
    )


@query(
    "error_backoff",
    f"""WITH {TYPED_SQL} SELECT event_id, error_type, is_retryable, is_retryable AS should_backoff,
  error_type = 'permission' OR (error_type = 'invalid_request' AND error_code IN (400, 403)) AS is_fatal,
  backoff_seconds, rate_limit_type FROM waits""",
)
def error_backoff(spark, folder):
    typed = usage.with_errors(answers(spark, folder))
    return typed.select(
        "event_id", "error_type", "is_retryable", "should_backoff", "is_fatal", "backoff_seconds", "rate_limit_type"
    )


REASON_SQL = """
kinds AS (SELECT batch_id, rate_limit_type, count(*) AS n, min(request_index) AS first_at, max(backoff_seconds) AS wait
          FROM waits WHERE error_type = 'rate_limit' GROUP BY 1, 2),
reasons AS (SELECT batch_id, max(wait) AS response_wait, string_agg(concat(n, 'x ', rate_limit_type), ', ' ORDER BY first_at) AS reason
            FROM kinds GROUP BY 1)"""


@query("error_summary_text", f"WITH {TYPED_SQL}, {REASON_SQL} SELECT * FROM reasons")
def error_summary_text(spark, folder):
    return usage.error_wait(usage.with_errors(answers(spark, folder)))


def batch_summaries(rows):
    """One summary per batch of answers, with two accounts and their use cases."""
    lows = rows.groupBy("batch_id").agg(F.min("k").alias("a"), F.max("k").alias("b"), F.sum("k").alias("s"))

    def use(calls_, cpu, wall):
        return F.struct(
            F.lit("ads_insights").alias("type"), calls_.cast("int").alias("call_count"),
            cpu.cast("int").alias("total_cputime"), wall.cast("int").alias("total_time"),
        )

    def account(name, pct, eta, *uses):
        return F.struct(
            F.lit(name).alias("account_id"), pct.cast("double").alias("insights_usage_pct"),
            eta.cast("int").alias("eta_seconds"), F.array(*uses).alias("business_use_cases"),
        )

    a, b, s = F.col("a"), F.col("b"), F.col("s")
    limits = F.struct(
        (s % 101).cast("double").alias("app_usage_pct"),
        F.array(
            account("act_1", s % 97, s % 89, use(s % 300, a, a)),
            account("act_2", a, (s % 40) * 12, use(a, s % 95, a), use(b, a, s % 93)),
        ).alias("account_details"),
    )
    return lows.select("batch_id", limits.alias("rate_limits"))


_BAND = lambda c, hi, w1, lo, w2: f"CASE WHEN {c} >= {hi} THEN {w1} WHEN {c} >= {lo} THEN {w2} ELSE 0 END"


def _time_sql(calls_, cpu, wall):
    return (
        f"greatest({_BAND(cpu, 90, 300, 70, 120)}, {_BAND(wall, 90, 300, 70, 120)}, "
        f"CASE WHEN {calls_} > 100 AND {wall} < 100 AND {wall} / ({calls_})::DOUBLE < 0.5 THEN 60 ELSE 0 END)"
    )


SUMMARY_SQL = f"""
low AS (SELECT batch_id, min(k) AS a, max(k) AS b, CAST(sum(k) AS BIGINT) AS s FROM answers GROUP BY 1),
asked AS (
  SELECT batch_id,
    greatest({_BAND('s % 101', 95, 300, 75, 60)}, {_BAND('s % 97', 95, 300, 75, 60)}, s % 89, {_BAND('a', 95, 300, 75, 60)},
             (s % 40) * 12) AS usage_wait,
    greatest({_time_sql('s % 300', 'a', 'a')}, {_time_sql('a', 's % 95', 'a')}, {_time_sql('b', 'a', 's % 93')}) AS time_wait
  FROM low
)"""


@query(
    "backoff_decision",
    f"""WITH {TYPED_SQL}, {REASON_SQL}, {SUMMARY_SQL},
waiting AS (SELECT batch_id, CAST(greatest(usage_wait, time_wait) AS INTEGER) AS summary_wait, coalesce(response_wait, 0) AS response_wait, reason
         FROM asked LEFT JOIN reasons USING (batch_id)),
w AS (SELECT *, greatest(summary_wait, response_wait) AS wait FROM waiting)
SELECT batch_id, summary_wait, response_wait, reason,
       CASE WHEN wait > 360 THEN 'abort' WHEN wait > 0 THEN 'wait' ELSE 'none' END AS action,
       CASE WHEN wait > 0 AND wait <= 360 THEN wait + 5 ELSE 0 END AS seconds FROM w""",
)
def backoff_decision(spark, folder):
    rows = answers(spark, folder)
    return usage.batch_decision(usage.with_errors(rows), batch_summaries(rows))


@query(
    "summary_only_backoff",
    f"""WITH {ANSWERS_SQL}, {SUMMARY_SQL}
SELECT batch_id, CASE WHEN usage_wait > 900 THEN 'abort' WHEN usage_wait > 0 THEN 'wait' ELSE 'none' END AS action,
       CAST(CASE WHEN usage_wait > 0 AND usage_wait <= 900 THEN usage_wait + 3 ELSE 0 END AS INTEGER) AS seconds FROM asked""",
)
def summary_only_backoff(spark, folder):
    asked = batch_summaries(answers(spark, folder))
    wait = ae.summary_backoff(F.col("rate_limits"), with_times=False)
    return asked.select("batch_id", ae.decision(wait, ae.SUMMARY_CAP, ae.SUMMARY_EXTRA).alias("d")).select(
        "batch_id", "d.action", "d.seconds"
    )


@query(
    "batch_outcome",
    f"""WITH {ANSWERS_SQL} SELECT batch_id, count(*) FILTER (status_code = 200) AS success_count,
  count(*) FILTER (status_code <> 200) AS error_count FROM answers GROUP BY 1""",
)
def batch_outcome(spark, folder):
    return usage.batch_outcome(answers(spark, folder))


@query(
    "response_routing",
    f"""WITH {ANSWERS_SQL} SELECT event_id,
  CASE WHEN status_code = 200 THEN 'rows' WHEN status_code = 403 THEN 'abort' WHEN status_code >= 500 THEN 'retry' ELSE 'skip' END
    AS breakdown_route,
  CASE WHEN status_code = 200 THEN 'rows' WHEN status_code IN (400, 403) THEN 'abort' WHEN status_code >= 500 THEN 'retry'
    ELSE 'skip' END AS performance_route,
  CASE WHEN status_code = 200 THEN 'rows' ELSE 'retry' END AS daily_route FROM answers""",
)
def response_routing(spark, folder):
    s = F.col("status_code")
    return answers(spark, folder).select(
        "event_id",
        ae.route(s).alias("breakdown_route"),
        ae.route(s, abort_on=(400, 403)).alias("performance_route"),
        ae.route(s, retry="any").alias("daily_route"),
    )


@query(
    "response_request_order",
    f"""WITH {ANSWERS_SQL} SELECT batch_id, request_index, concat('act_', event_id % 40, '/insights') AS requested_url, status_code
FROM answers ORDER BY batch_id, request_index""",
)
def response_request_order(spark, folder):
    rows = answers(spark, folder)
    requests = table(spark, folder, "events").select(
        F.expr("event_id div 20").alias("batch_id"),
        (F.col("event_id") % 20).cast("int").alias("request_index"),
        F.concat(F.lit("act_"), (F.col("event_id") % 40).cast("string"), F.lit("/insights")).alias("requested_url"),
    )
    return usage.in_request_order(rows.select("batch_id", "request_index", "status_code"), requests)


def with_headers(spark, folder):
    """Answers with the headers the API sends: usage as JSON text, names in any case."""
    rows = spread(answers(spark, folder))
    k = F.col("k").cast("string")
    throttle = F.when(F.col("k") % 10 == 9, F.lit("{broken")).otherwise(
        F.concat(F.lit('{"app_id_util_pct": '), k, F.lit(', "acc_id_util_pct": '), ((F.col("k") * 3) % 100).cast("string"), F.lit("}"))
    )
    cases = F.concat(
        F.lit('{"'), (F.col("event_id") % 7).cast("string"),
        F.lit('": [{"type": "ads_insights", "call_count": 1, "total_cputime": 2, "total_time": 3, "estimated_time_to_regain_access": '),
        (F.col("k") * 2).cast("string"), F.lit('}, {"type": "ads_management"}]}'),
    )
    head = lambda name, value: F.struct(F.lit(name).alias("name"), value.alias("value"))
    return as_table(rows.withColumn(
        "headers",
        F.array(
            head("X-FB-Ads-Insights-Throttle", F.lit('{"app_id_util_pct": 100}')),
            head("x-fb-ads-insights-throttle", throttle),
            head("X-Business-Use-Case-Usage", cases),
        ),
    ))


@query(
    "rate_limit_summary",
    f"""WITH {ANSWERS_SQL} SELECT batch_id, concat('act_', event_id % 7) AS account_id,
  CAST(max(CASE WHEN k % 10 = 9 THEN 0 ELSE (k * 3) % 100 END) AS DOUBLE) AS insights_usage_pct,
  max(k * 2) AS eta_seconds, CAST(sum(2) AS BIGINT) AS use_cases FROM answers GROUP BY 1, 2""",
)
def rate_limit_summary(spark, folder):
    return usage.limits_by_account(with_headers(spark, folder))


@query(
    "app_usage_summary",
    f"WITH {ANSWERS_SQL} SELECT batch_id, CAST(max(CASE WHEN k % 10 = 9 THEN 0 ELSE k END) AS DOUBLE) AS app_usage_pct FROM answers GROUP BY 1",
)
def app_usage_summary(spark, folder):
    return usage.app_usage(with_headers(spark, folder))


@query(
    "retry_merge",
    """SELECT l_orderkey AS request_id, l_linenumber AS attempt, CASE l_returnflag WHEN 'A' THEN 200 WHEN 'N' THEN 500 ELSE 400 END AS status_code,
  l_returnflag <> 'A' AND l_linenumber >= 5 AS given_up FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1""",
)
def retry_merge(spark, folder):
    """Line items as attempts of their order's request; the last attempt counts."""
    flag = F.col("l_returnflag")
    attempts = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("request_id"), F.col("l_linenumber").alias("attempt"), "l_partkey", "l_suppkey",
        F.when(flag == "A", 200).when(flag == "N", 500).otherwise(400).alias("status_code"),
    )
    return usage.merge_attempts(attempts, ["request_id"], 5, ["l_partkey", "l_suppkey"]).drop("l_partkey", "l_suppkey")


@query(
    "batch_plan",
    "SELECT CAST((rn - 1) // 35 AS BIGINT) AS batch_id, count(*) AS requests FROM "
    "(SELECT row_number() OVER (ORDER BY c_custkey) AS rn FROM customer) GROUP BY 1",
)
def batch_plan(spark, folder):
    """Customers as ids, numbered into batches of 35 requests."""
    ids = sets.distinct_ids(table(spark, folder, "customer"), "c_custkey")
    return sets.with_batch(ids, "c_custkey", 35).groupBy("batch_id").agg(F.count(F.lit(1)).alias("requests"))


@query(
    "batch_members",
    "SELECT c_custkey, CAST((row_number() OVER (ORDER BY c_custkey) - 1) // 35 AS BIGINT) AS batch_id FROM (SELECT DISTINCT c_custkey FROM customer)",
)
def batch_members(spark, folder):
    """Every customer id with its batch of 35, in id order."""
    ids = sets.distinct_ids(table(spark, folder, "customer"), "c_custkey")
    return sets.with_batch_in_order(ids, "c_custkey", 35)


@query(
    "backoff_from_headers",
    f"""WITH {TYPED_SQL}, {REASON_SQL},
h AS (SELECT batch_id, request_index, CASE WHEN k % 10 <> 9 THEN k END AS app, CASE WHEN k % 10 <> 9 THEN (k * 3) % 100 END AS acc,
             concat('act_', event_id % 7) AS account_id, k * 2 AS eta FROM answers),
app AS (SELECT batch_id, app FROM h WHERE app IS NOT NULL QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY request_index DESC) = 1),
acct AS (SELECT batch_id, greatest({_BAND('coalesce(acc, 0)', 95, 300, 75, 60)}, eta) AS wait FROM h
         QUALIFY row_number() OVER (PARTITION BY batch_id, account_id ORDER BY request_index DESC) = 1),
asked AS (SELECT b.batch_id, CAST(greatest({_BAND('coalesce(app.app, 0)', 95, 300, 75, 60)}, max(acct.wait)) AS INTEGER) AS summary_wait
          FROM (SELECT DISTINCT batch_id FROM answers) b LEFT JOIN app USING (batch_id) LEFT JOIN acct USING (batch_id) GROUP BY b.batch_id, app.app),
w AS (SELECT batch_id, summary_wait, coalesce(response_wait, 0) AS response_wait, reason, greatest(summary_wait, coalesce(response_wait, 0)) AS wait
      FROM asked LEFT JOIN reasons USING (batch_id))
SELECT batch_id, summary_wait, response_wait, reason,
       CASE WHEN wait > 360 THEN 'abort' WHEN wait > 0 THEN 'wait' ELSE 'none' END AS action,
       CASE WHEN wait > 0 AND wait <= 360 THEN wait + 5 ELSE 0 END AS seconds FROM w""",
)
def backoff_from_headers(spark, folder):
    """Wait, abort or go on per batch, from the raw headers of its answers and their errors."""
    rows = with_headers(spark, folder)
    return usage.batch_decision(usage.with_errors(rows), usage.summaries_from_headers(rows))

