"""Sliding counts, fixed quotas, dense series and zero fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.operators.latest import top_per_key


def sliding_count(
    calls: DataFrame, key: str, ts: str, seconds: int, out: str = "in_window", slice_factor: int = 60
) -> DataFrame:
    """Calls of the same key in the ``seconds`` up to and including each call (older end open).

    Linear in the calls: each call adds 1 at its time and takes it away at its time plus the window;
    the count at a moment is the running sum of these steps. Steps are summed per key and moment, and
    the running sum is taken per slice of ``slice_factor`` windows, starting from the carry of all
    earlier slices of the key (one row per slice). A key with a third of all calls is spread over as
    many tasks as it has slices, and no call is counted more than twice. Null keys form a key of their own.
    """
    span = seconds * 1_000_000
    width = span * slice_factor
    marked = calls.withColumn("__us", F.unix_micros(F.col(ts).cast("timestamp")))
    steps = marked.select(F.col(key).alias("__k"), F.col("__us").alias("__t"), F.lit(1).alias("__d")).unionByName(
        marked.select(F.col(key).alias("__k"), (F.col("__us") + F.lit(span)).alias("__t"), F.lit(-1).alias("__d"))
    )
    net = steps.groupBy("__k", "__t").agg(F.sum("__d").alias("__net")).withColumn("__slice", F.floor(F.col("__t") / F.lit(width)))
    totals = net.groupBy("__k", "__slice").agg(F.sum("__net").alias("__total"))
    earlier = Window.partitionBy("__k").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select("__k", "__slice", F.coalesce(F.sum("__total").over(earlier), F.lit(0)).alias("__carry"))
    running = Window.partitionBy("__k", "__slice").orderBy("__t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    level = net.withColumn("__run", F.sum("__net").over(running)).join(carry, ["__k", "__slice"])
    level = level.select("__k", "__t", (F.col("__run") + F.col("__carry")).alias(out))
    joined = marked.join(level, F.col(key).eqNullSafe(F.col("__k")) & (F.col("__us") == F.col("__t")))
    return joined.drop("__us", "__k", "__t")


def pending_wait(
    calls: DataFrame, key: str, ts: str, now, adding: int, limit: int = 100, seconds: int = 20
) -> DataFrame:
    """Per key: how long a caller about to send ``adding`` calls must wait, in seconds.

    The wait ends when so many recent calls are older than the window that only
    ``limit - adding`` are left. The call that decides is therefore the one just
    before the newest ``limit - adding``, found with a bounded top-k per key.
    """
    moment = F.lit(now).cast("timestamp")
    age = (F.unix_micros(moment) - F.unix_micros(F.col(ts).cast("timestamp"))) / F.lit(1e6)
    recent = calls.select(F.col(key), age.alias("__age")).filter((F.col("__age") >= 0) & (F.col("__age") < seconds))
    counts = recent.groupBy(key).agg(F.count(F.lit(1)).alias("recent"))
    place = max(limit - adding + 1, 1)
    decisive = (
        top_per_key(recent, [key], [F.col("__age")], place)
        .groupBy(key)
        .agg(F.max("__age").alias("__age"), F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") == place)
    )
    waits = decisive.select(key, (F.lit(seconds) - F.col("__age")).alias("wait_seconds"))
    return counts.join(waits, key, "left").withColumn("wait_seconds", F.coalesce("wait_seconds", F.lit(0.0)))


def fixed_quota(
    calls: DataFrame, key: str, ts: str, order: Sequence[str], rules: Sequence[tuple[int, int]], out: str = "allowed"
) -> DataFrame:
    """Whether each call fits every ``(limit, period seconds)`` rule of its clock window.

    Rules apply from the shortest period on, and a rule counts only the calls that
    passed the ones before. A call passes when it is not later than the
    ``limit``-th counted call of its window. Those decisive calls are found with a
    bounded top-k per window and joined back, so a busy window is never ranked in
    one task.
    """
    current = calls.withColumn(out, F.lit(True))
    position = F.struct(F.col(ts), *[F.col(c) for c in order])
    for limit, period in sorted(rules, key=lambda r: r[1]):
        window = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(period * 1_000_000))
        slim = current.filter(out).select(F.col(key), window.alias("__w"), position.alias("__p"))
        cut = (
            top_per_key(slim, [key, "__w"], [F.col("__p")], limit)
            .groupBy(key, "__w")
            .agg(F.max("__p").alias("__last"), F.count(F.lit(1)).alias("__n"))
            .filter(F.col("__n") == limit)
            .select(key, "__w", "__last")
        )
        current = (
            current.withColumn("__w", window)
            .join(cut, [key, "__w"], "left")
            .withColumn(out, F.col(out) & (F.col("__last").isNull() | (position <= F.col("__last"))))
            .drop("__w", "__last")
        )
    return current


def counts_by_hour(calls: DataFrame, endpoint: str, ts: str) -> DataFrame:
    return calls.groupBy(F.col(endpoint).alias("endpoint"), F.date_trunc("hour", F.col(ts).cast("timestamp")).alias("hour")).agg(
        F.count(F.lit(1)).alias("calls")
    )


def dense_hours(hourly: DataFrame, as_of, hours: int = 24, endpoints: DataFrame | None = None) -> DataFrame:
    """The last ``hours`` hours per endpoint, oldest first, zero where nothing was called.

    The spine is generated per endpoint, so its size is endpoints × hours.
    """
    last = F.date_trunc("hour", F.lit(as_of).cast("timestamp"))
    first = last - F.make_interval(hours=F.lit(hours - 1))
    names = endpoints if endpoints is not None else hourly.select("endpoint").distinct()
    spine = names.select("endpoint", F.explode(F.sequence(first, last, F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    recent = hourly.filter((F.col("hour") >= first) & (F.col("hour") <= last))
    return spine.join(recent, ["endpoint", "hour"], "left").withColumn("calls", F.coalesce("calls", F.lit(0)))


def count_categories(df: DataFrame, category: Column, names: Sequence[str], out: str = "category") -> DataFrame:
    """Rows per category for a fixed list; categories nobody falls into show 0.

    One pass and one result row, unpivoted at the end: no shuffle by category.
    """
    tallied = df.select(category.alias("__c")).agg(
        *[F.count_if(F.col("__c") == n).alias(f"__{i}") for i, n in enumerate(names)]
    )
    pairs = F.array(*[F.struct(F.lit(n).alias(out), F.col(f"__{i}").alias("n")) for i, n in enumerate(names)])
    return tallied.select(F.inline(pairs))


def first_match(c: Column, rules: Sequence[tuple[str, str]], otherwise: str) -> Column:
    """Name of the first rule whose text occurs in ``c`` (case ignored)."""
    lowered = F.lower(F.coalesce(c, F.lit("")))
    out = None
    for part, name in rules:
        hit = lowered.contains(part)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(otherwise)


def run_length(events: DataFrame, key: str, ts: str, started: Column, ended: Column) -> DataFrame:
    """Seconds from the first start to the last end per key, 2 decimals, -1 without a start."""
    t = F.col(ts).cast("timestamp")
    spans = events.groupBy(key).agg(F.min(F.when(started, t)).alias("start_time"), F.max(F.when(ended, t)).alias("end_time"))
    length = (F.unix_micros("end_time") - F.unix_micros("start_time")) / F.lit(1e6)
    return spans.filter(F.col("end_time").isNotNull()).withColumn(
        "duration_seconds", F.when(F.col("start_time").isNull(), F.lit(-1.0)).otherwise(F.round(length, 2))
    )
