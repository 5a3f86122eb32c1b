"""Roll-ups of API usage, errors and retries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions import api_errors as ae
from adlake.operators.latest import latest_per_key
from adlake.operators.unnest import header_value

# Headers that report usage, in lower case.
THROTTLE_HEADER = "x-fb-ads-insights-throttle"
USAGE_HEADER = "x-business-use-case-usage"


def account_usage(rows: DataFrame, keys: Sequence[str] = ("job_id", "account_id")) -> DataFrame:
    """Highest usage and announced wait, number of observations and last tier per account."""
    seen = rows.filter(F.col("account_id").isNotNull())
    return seen.groupBy(*keys).agg(
        F.max("insights_usage_pct").alias("max_insights"),
        F.max("eta_seconds").alias("max_eta"),
        F.count(F.lit(1)).alias("call_count"),
        F.coalesce(
            F.max_by("tier", F.when(F.col("tier").isNotNull(), F.struct("batch_index", "account_index"))), F.lit("N/A")
        ).alias("tier"),
    )


def batch_load(rows: DataFrame, scale: float = 1.0) -> DataFrame:
    """Per batch: app usage and the heaviest account's CPU and wall time.

    ``scale`` is 100 where usage was stored as a fraction.
    """
    return rows.groupBy("job_id", "batch_index").agg(
        (F.max("app_usage_pct") * F.lit(float(scale))).alias("app_usage"),
        F.max("cpu_time").alias("max_cpu"),
        F.max("total_time").alias("max_total_time"),
    )


def account_series(rows: DataFrame) -> DataFrame:
    """One point per (job, account, batch); batches an account is absent from are zeros."""
    spans = rows.groupBy("job_id").agg((F.max("batch_index") + 1).alias("batches"))
    accounts = rows.filter(F.col("account_id").isNotNull()).select("job_id", "account_id").distinct()
    spine = accounts.join(spans, "job_id").select(
        "job_id", "account_id", F.explode(F.sequence(F.lit(0), F.col("batches") - 1)).alias("batch_index")
    )
    points = rows.filter(F.col("account_id").isNotNull()).groupBy("job_id", "account_id", "batch_index").agg(
        F.max("insights_usage_pct").alias("insights_usage"),
        F.max("eta_seconds").alias("eta"),
        F.max("cpu_time").alias("cpu_time"),
        F.max("total_time").alias("total_time"),
    )
    out = spine.join(points, ["job_id", "account_id", "batch_index"], "left")
    return out.select(
        "job_id",
        "account_id",
        "batch_index",
        F.coalesce("insights_usage", F.lit(0.0)).alias("insights_usage"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("eta", "cpu_time", "total_time")],
    )


def limits_by_account(answers: DataFrame, keys: Sequence[str] = ("batch_id",)) -> DataFrame:
    """Rate-limit headers of a batch's answers, summed up per account.

    ``answers`` has ``headers`` as ``[{name, value}]``. Broken or missing header
    JSON counts as absent. Accounts are reported as ``act_<id>``.
    """
    throttle = F.from_json(
        header_value(F.col("headers"), THROTTLE_HEADER), "struct<app_id_util_pct: double, acc_id_util_pct: double>"
    )
    uses = F.from_json(
        header_value(F.col("headers"), USAGE_HEADER),
        "map<string, array<struct<type: string, call_count: int, total_cputime: int, total_time: int,"
        " estimated_time_to_regain_access: int, ads_api_access_tier: string>>>",
    )
    parsed = answers.select(*keys, throttle.alias("t"), uses.alias("u"))
    rows = parsed.select(*keys, "t", F.explode("u").alias("account", "cases"))
    etas = F.transform("cases", lambda c: F.coalesce(c["estimated_time_to_regain_access"], F.lit(0)))
    return (
        rows.groupBy(*keys, F.concat(F.lit("act_"), F.col("account")).alias("account_id"))
        .agg(
            F.max(F.coalesce(F.col("t.acc_id_util_pct"), F.lit(0.0))).alias("insights_usage_pct"),
            F.max(F.coalesce(F.array_max(etas), F.lit(0))).alias("eta_seconds"),
            F.sum(F.greatest(F.size("cases"), F.lit(0))).alias("use_cases"),
        )
    )


USE_CASES = "array<struct<type: string, call_count: int, total_cputime: int, total_time: int, estimated_time_to_regain_access: int>>"


def summaries_from_headers(answers: DataFrame, keys: Sequence[str] = ("batch_id",), order: str = "request_index") -> DataFrame:
    """One ``rate_limits`` struct per batch, read from the raw headers of its answers.

    Both usage headers are parsed as VARIANT, so the accounts of the use-case header (its keys) need
    no schema. Of several headers of one name in an answer the last counts; of the answers of a batch
    the one latest in ``order`` wins: for the app's usage, the last answer whose throttle header gives
    it; for an account, the last answer that reports it, with that answer's account usage. A header
    that is missing or does not parse gives nothing; a batch whose answers report no account has an
    empty account list.
    """
    keys = list(keys)
    spark = answers.sparkSession
    parsed = answers.select(
        *keys, order,
        F.try_parse_json(header_value(F.col("headers"), THROTTLE_HEADER)).alias("t"),
        F.try_parse_json(header_value(F.col("headers"), USAGE_HEADER)).alias("u"),
    )
    app = parsed.select(*keys, order, F.try_variant_get("t", "$.app_id_util_pct", "double").alias("app_usage_pct"))
    app = latest_per_key(app.filter(F.col("app_usage_pct").isNotNull()), keys, order).drop(order)
    reported = parsed.lateralJoin(spark.tvf.variant_explode(F.col("u").outer())).select(
        *keys, order, F.concat(F.lit("act_"), F.col("key")).alias("account_id"),
        F.try_variant_get("t", "$.acc_id_util_pct", "double").alias("insights_usage_pct"),
        F.coalesce(F.try_variant_get("value", "$", USE_CASES), F.array().cast(USE_CASES)).alias("cases"),
    )
    last = latest_per_key(reported, [*keys, "account_id"], order)
    etas = F.transform("cases", lambda c: F.coalesce(c["estimated_time_to_regain_access"], F.lit(0)))
    account = F.struct(
        "account_id", "insights_usage_pct", F.coalesce(F.array_max(etas), F.lit(0)).alias("eta_seconds"),
        F.transform("cases", lambda c: c.dropFields("estimated_time_to_regain_access")).alias("business_use_cases"),
    )
    details = last.groupBy(*keys).agg(F.array_sort(F.collect_list(account)).alias("account_details"))
    batches = answers.select(*keys).distinct()
    both = batches.join(app, keys, "left").join(details, keys, "left")
    limits = F.struct(
        F.coalesce("app_usage_pct", F.lit(0.0)).alias("app_usage_pct"),
        F.coalesce("account_details", F.array().cast(details.schema["account_details"].dataType)).alias("account_details"),
    )
    return both.select(*keys, limits.alias("rate_limits"))


def app_usage(answers: DataFrame, keys: Sequence[str] = ("batch_id",)) -> DataFrame:
    throttle = F.from_json(header_value(F.col("headers"), THROTTLE_HEADER), "struct<app_id_util_pct: double>")
    return answers.groupBy(*keys).agg(F.max(F.coalesce(throttle["app_id_util_pct"], F.lit(0.0))).alias("app_usage_pct"))


def batch_outcome(answers: DataFrame, keys: Sequence[str] = ("batch_id",)) -> DataFrame:
    ok = F.col("status_code") == 200
    return answers.groupBy(*keys).agg(
        F.count_if(ok).alias("success_count"), F.count_if(~ok).alias("error_count")
    )


def with_errors(answers: DataFrame) -> DataFrame:
    """Adds the class of each failed answer and the wait it asks for."""
    code, sub = F.col("error_code"), F.col("error_subcode")
    typed = answers.withColumn("error_type", F.when(F.col("status_code") != 200, ae.error_type(code, sub)))
    kind = F.col("error_type")
    return (
        typed.withColumn("is_retryable", ae.is_retryable(kind))
        .withColumn("should_backoff", ae.should_backoff(kind))
        .withColumn("is_fatal", ae.is_fatal(kind, code))
        .withColumn("backoff_seconds", F.when(kind.isNotNull(), ae.error_backoff(kind, code, sub)).otherwise(0))
        .withColumn("rate_limit_type", ae.rate_limit_name(kind, code))
    )


def error_wait(errors: DataFrame, keys: Sequence[str] = ("batch_id",)) -> DataFrame:
    """Longest rate-limit wait per batch and a text of what hit it, in order of appearance."""
    limited = errors.filter(F.col("error_type") == "rate_limit")
    kinds = limited.groupBy(*keys, "rate_limit_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("request_index").alias("first_at"), F.max("backoff_seconds").alias("wait")
    )
    # at most one entry per error code remains, so the list is short
    part = F.struct("first_at", F.concat(F.col("n").cast("string"), F.lit("x "), F.col("rate_limit_type")).alias("text"))
    return kinds.groupBy(*keys).agg(
        F.max("wait").alias("response_wait"),
        F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda p: p["text"]), ", ").alias("reason"),
    )


def batch_decision(
    errors: DataFrame, summaries: DataFrame, keys: Sequence[str] = ("batch_id",), cap: int = ae.BACKOFF_CAP,
    extra: int = ae.BACKOFF_EXTRA,
) -> DataFrame:
    """Wait, abort or go on, per batch: the longer of what errors and usage ask for.

    ``summaries`` has one row per batch with its ``rate_limits`` struct.
    """
    keys = list(keys)
    asked = summaries.select(*keys, ae.summary_backoff(F.col("rate_limits")).alias("summary_wait"))
    both = asked.join(error_wait(errors, keys), keys, "left")
    wait = F.greatest(F.col("summary_wait"), F.coalesce("response_wait", F.lit(0)))
    return both.select(
        *keys,
        "summary_wait",
        F.coalesce("response_wait", F.lit(0)).alias("response_wait"),
        "reason",
        ae.decision(wait, cap, extra).alias("d"),
    ).select(*keys, "summary_wait", "response_wait", "reason", "d.action", "d.seconds")


def merge_attempts(
    answers: DataFrame, keys: Sequence[str], max_attempts: int, ties: Sequence[str] = ()
) -> DataFrame:
    """The last attempt of every request, and whether it was given up."""
    last = latest_per_key(answers, keys, "attempt", ties)
    failed = F.col("status_code") != 200
    return last.withColumn("given_up", failed & (F.col("attempt") >= max_attempts))


def in_request_order(answers: DataFrame, requests: DataFrame, keys: Sequence[str] = ("batch_id", "request_index")) -> DataFrame:
    return requests.join(answers, list(keys), "left").orderBy(*keys)


def category_totals(df: DataFrame, endpoint: Column, value: Column) -> DataFrame:
    return df.groupBy(endpoint.alias("endpoint")).agg(F.sum(value).alias("total"))
