"""Classifying API answers and working out how long a caller has to wait."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Error codes of the ads API and what each class of error means.
RATE_LIMIT_CODES = {
    4: "App rate limit",
    17: "User rate limit",
    32: "Page rate limit",
    613: "Custom rate limit",
    80000: "Ads Insights rate limit",
    80001: "Page (System User token) rate limit",
    80002: "Instagram rate limit",
    80003: "Custom Audience rate limit",
    80004: "Ads Management rate limit",
    80005: "LeadGen rate limit",
    80006: "Messenger rate limit",
    80008: "WhatsApp Business rate limit",
    80009: "Catalog Management rate limit",
    80014: "Catalog Batch rate limit",
}
RATE_LIMIT_SUBCODES = (2446079, 1996)
PERMISSION_CODES = (10, 102, 104, 190, 200)
UNKNOWN_LIMIT = "Unknown rate limit"
USAGE_WAITS = ((95, 300), (75, 60))
TIME_WAITS = ((90, 300), (70, 120))
FAST_CALLS, FAST_WINDOW, FAST_SECONDS, FAST_WAIT = 100, 100, 0.5, 60
BACKOFF_CAP, BACKOFF_EXTRA = 360, 5
SUMMARY_CAP, SUMMARY_EXTRA = 900, 3


def error_type(code: Column, subcode: Column | None = None) -> Column:
    limited = code.isin(*RATE_LIMIT_CODES)
    if subcode is not None:
        limited = limited | F.coalesce(subcode.isin(*RATE_LIMIT_SUBCODES), F.lit(False))
    return (
        F.when(code.isNull(), "unknown")
        .when(limited, "rate_limit")
        .when(code.isin(*PERMISSION_CODES), "permission")
        .when(code >= 500, "server_error")
        .when(code >= 400, "invalid_request")
        .otherwise("unknown")
    )


def is_retryable(kind: Column) -> Column:
    return kind.isin("rate_limit", "server_error", "unknown")


def should_backoff(kind: Column) -> Column:
    return is_retryable(kind)


def is_fatal(kind: Column, code: Column) -> Column:
    return (kind == "permission") | ((kind == "invalid_request") & code.isin(400, 403))


def rate_limit_name(kind: Column, code: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in RATE_LIMIT_CODES.items() for x in pair])
    return F.when(kind == "rate_limit", F.coalesce(F.try_element_at(names, code), F.lit(UNKNOWN_LIMIT)))


def error_backoff(kind: Column, code: Column, subcode: Column) -> Column:
    """Seconds to wait after one failed answer."""
    limited = (
        F.when(code == 4, 300)
        .when((code == 17) & (subcode == RATE_LIMIT_SUBCODES[0]), 300)
        .when(code.isin(80000, 80004), 600)
        .otherwise(180)
    )
    return (
        F.when(kind == "rate_limit", limited)
        .when(kind == "server_error", 30)
        .when(kind == "unknown", 60)
        .otherwise(0)
    )


def _banded(c: Column, bands) -> Column:
    out = None
    for floor, wait in bands:
        out = F.when(c >= floor, wait) if out is None else out.when(c >= floor, wait)
    return out.otherwise(0)


def usage_backoff(usage_pct: Column) -> Column:
    return _banded(F.coalesce(usage_pct, F.lit(0.0)), USAGE_WAITS)


def time_backoff(cpu: Column, wall: Column, calls: Column) -> Column:
    cpu, wall, calls = (F.coalesce(c, F.lit(0)) for c in (cpu, wall, calls))
    hurried = (calls > FAST_CALLS) & (wall < FAST_WINDOW) & (wall < calls * FAST_SECONDS)
    return F.greatest(_banded(cpu, TIME_WAITS), _banded(wall, TIME_WAITS), F.when(hurried, FAST_WAIT).otherwise(0))


def account_backoff(account: Column, with_times: bool = True) -> Column:
    """Wait asked for by one account: its usage, its announced wait and its use cases."""
    parts = [usage_backoff(account["insights_usage_pct"]), F.coalesce(account["eta_seconds"], F.lit(0))]
    if with_times:
        waits = F.transform(
            account["business_use_cases"],
            lambda u: time_backoff(u["total_cputime"], u["total_time"], u["call_count"]),
        )
        parts.append(F.coalesce(F.array_max(waits), F.lit(0)))
    return F.greatest(*parts)


def summary_backoff(limits: Column, with_times: bool = True) -> Column:
    """Wait asked for by one batch summary (its ``rate_limits`` struct)."""
    waits = F.transform(limits["account_details"], lambda a: account_backoff(a, with_times))
    return F.greatest(usage_backoff(limits["app_usage_pct"]), F.coalesce(F.array_max(waits), F.lit(0)))


def decision(wait: Column, cap: int = BACKOFF_CAP, extra: int = BACKOFF_EXTRA) -> Column:
    """``none``, ``wait`` (with the buffer added) or ``abort`` (longer than the cap)."""
    wait = F.coalesce(wait, F.lit(0))
    return F.struct(
        F.when(wait > cap, "abort").when(wait > 0, "wait").otherwise("none").alias("action"),
        F.when((wait > 0) & (wait <= cap), wait + extra).otherwise(0).cast("int").alias("seconds"),
    )


def route(status: Column, abort_on=(403,), retry: str = "server") -> Column:
    """Where an answer goes: ``rows``, ``abort``, ``retry`` or ``skip``.

    ``retry='server'`` retries 5xx only; ``retry='any'`` retries everything but 200.
    """
    out = F.when(status == 200, "rows")
    if retry == "any":
        return out.otherwise("retry")
    return out.when(status.isin(*abort_on), "abort").when((status >= 500) & (status < 600), "retry").otherwise("skip")
