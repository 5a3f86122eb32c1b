"""The data sets behind the dashboards: one frame per card, nothing is collected here."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.functions.text import SHOP_API_HOST, endpoint_name
from adlake.operators import joblog as jl
from adlake.operators import unnest, usage, windows
from adlake.operators.windows import first_match
from adlake.session import shared_dir


def overview(jobs: DataFrame, time_range: str, as_of, status: str = "all") -> dict[str, DataFrame]:
    """Cards of the overview. Figures cover the whole range, not only the listed rows."""
    chosen = jl.in_range(jobs, time_range, as_of)
    return {
        "kpis": jl.kpis(chosen),
        "by_status": jl.count_by(chosen, "status", missing="undefined"),
        "by_task_type": jl.count_by(chosen, "task_type", missing="Unknown"),
        "top_users": jl.top(jl.count_by(chosen, "user_email"), "user_email", 5),
        "top_failed_users": jl.top(jl.failed_by_user(chosen), "user_email", 10),
        "tasks": jl.recent_jobs(jl.with_status(jobs, status), time_range, as_of, limit=jl.DISPLAY_LIMIT),
    }


def ads(jobs: DataFrame, time_range: str, as_of, scale: float = 1.0) -> dict[str, DataFrame]:
    chosen = jl.ads_jobs(jl.in_range(jobs, time_range, as_of))
    return {
        "totals": jl.batch_totals(chosen),
        "usage": jl.usage_buckets(chosen, scale),
        "by_kind": jl.ads_kinds(chosen),
        "by_status": jl.status_groups(chosen),
        "tasks": jl.recent_jobs(jl.ads_jobs(jobs), time_range, as_of, limit=jl.DISPLAY_LIMIT),
    }


def shop(jobs: DataFrame, calls: DataFrame, time_range: str, as_of, hours: int = 24) -> dict[str, DataFrame]:
    """``calls``: endpoint (a URL) and ts of every API call."""
    chosen = jl.shop_jobs(jl.in_range(jobs, time_range, as_of))
    mine = calls.filter(F.col("endpoint").contains(SHOP_API_HOST)).withColumn("endpoint", endpoint_name(F.col("endpoint")))
    series = windows.dense_hours(windows.counts_by_hour(mine, "endpoint", "ts"), as_of, hours)
    totals = usage.category_totals(series, F.col("endpoint"), F.col("calls"))
    return {
        "totals": jl.kind_counts(chosen),
        "by_kind": jl.shop_kinds(chosen),
        "by_status": jl.status_groups(chosen),
        "api_series": series,
        "api_totals": totals.orderBy(F.col("total").desc(), "endpoint"),
        "tasks": jl.recent_jobs(jl.shop_jobs(jobs), time_range, as_of, limit=jl.DISPLAY_LIMIT),
    }


def job_detail(jobs: DataFrame, scale: float = 1.0) -> dict[str, DataFrame]:
    """Usage of one or more jobs: per batch, per account, and account series padded to all batches."""
    rows = unnest.usage_rows(jobs)
    return {
        "batches": usage.batch_load(rows, scale),
        "accounts": usage.account_usage(rows).orderBy(F.col("call_count").desc(), "job_id", "account_id"),
        "series": usage.account_series(rows),
    }


def combined(jobs: DataFrame, calls: DataFrame, time_range: str, as_of, hours: int = 24) -> dict[str, DataFrame]:
    hourly = windows.counts_by_hour(calls, "endpoint", "ts")
    return {
        "task_logs": jl.recent_jobs(jobs, time_range, as_of),
        "api_total_counts": calls.groupBy("endpoint").agg(F.count(F.lit(1)).alias("calls")),
        "api_timeseries": windows.dense_hours(hourly, as_of, hours),
    }


# -- whole dashboards from one scan ---------------------------------------------------------

CARD = "card string, key string, value double, position int"


def _once(df: DataFrame, name: str) -> DataFrame:
    """An aggregate written once to the shared folder and read again, so that every card reads it and not the log."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _ranked(counts: DataFrame, card: str, n: int) -> DataFrame:
    """The ``n`` largest counts of one card, ties by key; the rank filter keeps ``n`` rows per task before the final sort."""
    order = Window.partitionBy("card").orderBy(F.col("value").desc(), "key")
    return counts.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= n).filter(F.col("card") == card)


def overview_cards(jobs: DataFrame, time_range: str, as_of) -> DataFrame:
    """Every figure card of the overview as one long result (card, key, value, position), from one aggregate.

    One scan of the log feeds a GROUPING SETS aggregate: the whole range, per status, per task type,
    per user, and per user among failed jobs. The aggregate (a row per status, type and user) is
    written once and every card is read from it; the top cards keep their first rows per task before
    the final ranking. Cards: ``kpis`` (total_tasks, successful_tasks,
    success_rate in %, avg_duration of finished jobs, unique_users with a mail address), ``by_status``
    (empty status: 'undefined'), ``by_task_type`` (empty: 'Unknown'), ``top_users`` (5, users without a
    name left out), ``top_failed_users`` (10, no name: 'Unknown'). ``position`` ranks the top cards.
    """
    chosen = jl.in_range(jobs, time_range, as_of)
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    keyed = chosen.select(
        F.coalesce(blank("status"), F.lit("undefined")).alias("by_status"),
        F.coalesce(blank("task_type"), F.lit("Unknown")).alias("by_task_type"),
        blank("user_email").alias("top_users"),
        F.when(F.col("status").isin(*jl.FAILED), F.coalesce(blank("user_email"), F.lit("Unknown"))).alias("top_failed_users"),
        (F.col("status") == "SUCCESS").alias("ok"),
        F.when(F.col("duration_seconds") > 0, F.col("duration_seconds")).alias("ran"),
    )
    cards = ["by_status", "by_task_type", "top_users", "top_failed_users"]
    tallied = _once(keyed.groupingSets([[], *[[c] for c in cards]], *cards).agg(
        F.grouping_id(*cards).alias("gid"), F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("good"), F.avg("ran").alias("ran")
    ), "overview")
    full = (1 << len(cards)) - 1
    # the set of a card leaves only that card's bit clear: gid = full - 2^(cards after it)
    long = None
    for i, c in enumerate(cards):
        part = tallied.filter((F.col("gid") == full - (1 << (len(cards) - 1 - i))) & F.col(c).isNotNull())
        part = part.select(F.lit(c).alias("card"), F.col(c).alias("key"), F.col("n").cast("double").alias("value"))
        long = part if long is None else long.unionByName(part)
    whole = tallied.filter(F.col("gid") == full)
    rate = F.coalesce(F.round(F.lit(100.0) * F.col("good") / F.nullif(F.col("n"), F.lit(0)), 1), F.lit(0.0))
    kpis = whole.select(F.inline(F.array(
        *[F.struct(F.lit(k).alias("key"), v.cast("double").alias("value")) for k, v in (
            ("total_tasks", F.col("n")), ("successful_tasks", F.col("good")), ("success_rate", rate),
            ("avg_duration", F.coalesce(F.round("ran", 1), F.lit(0.0))),
        )]
    ))).select(F.lit("kpis").alias("card"), "key", "value")
    mailed = long.filter((F.col("card") == "top_users") & F.col("key").contains("@")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    users = mailed.select(F.lit("kpis").alias("card"), F.lit("unique_users").alias("key"), "value")
    plain = long.filter(F.col("card").isin("by_status", "by_task_type")).withColumn("position", F.lit(None).cast("int"))
    ranked = _ranked(long, "top_users", 5).unionByName(_ranked(long, "top_failed_users", 10))
    flat = kpis.unionByName(users).withColumn("position", F.lit(None).cast("int"))
    return flat.unionByName(plain).unionByName(ranked)


def ads_cards(jobs: DataFrame, time_range: str, as_of, scale: float = 1.0) -> DataFrame:
    """Every figure card of the ads dashboard as one long result (card, key, value, position), from one scan.

    One aggregate over the ads jobs of the range fills all counters at once: batch totals, jobs per
    kind (first matching rule, else 'Other') and per status group, every fixed category present with 0
    where nobody falls into it; usage buckets count the batches of those jobs by app usage.
    """
    chosen = jl.ads_jobs(jl.in_range(jobs, time_range, as_of))
    api = F.col("api_total_counts")
    clean = F.filter(api["summaries"], lambda s: (s["success_count"] > 0) & (s["error_count"] == 0))
    size = lambda c: F.coalesce(F.greatest(F.size(c), F.lit(0)), F.lit(0))
    used = lambda s: F.coalesce(s["rate_limits"]["app_usage_pct"], F.lit(0.0)) * F.lit(float(scale))
    safe, warning, critical = jl.USAGE_BUCKETS
    in_bucket = {
        safe: lambda s: used(s) < 75, warning: lambda s: (used(s) >= 75) & (used(s) < 95), critical: lambda s: used(s) >= 95,
    }
    kind = first_match(F.col("task_type"), jl.ADS_KINDS, "Other")
    group = jl.status_group(F.col("status"))
    counters = [
        ("totals", "total_tasks", F.count(F.lit(1))),
        ("totals", "total_batches", F.sum(size(api["summaries"]))),
        ("totals", "success_batches", F.sum(size(clean))),
        ("totals", "total_backoff", F.sum(F.coalesce(api["total_backoff_sec"], F.lit(0)))),
        *[("usage", b, F.sum(size(F.filter(api["summaries"], test)))) for b, test in in_bucket.items()],
        *[("by_kind", name, F.count_if(kind == name)) for name in [n for _, n in jl.ADS_KINDS] + ["Other"]],
        *[("by_status", name, F.count_if(group == name)) for name in jl.STATUS_GROUPS],
    ]
    tallied = chosen.agg(*[F.coalesce(agg, F.lit(0)).cast("double").alias(f"c{i}") for i, (_, _, agg) in enumerate(counters)])
    pairs = F.array(*[F.struct(F.lit(card).alias("card"), F.lit(key).alias("key"), F.col(f"c{i}").alias("value"), F.lit(i).alias("position"))
                      for i, (card, key, _) in enumerate(counters)])
    return tallied.select(F.inline(pairs)).select("card", "key", "value", F.lit(None).cast("int").alias("position"))
