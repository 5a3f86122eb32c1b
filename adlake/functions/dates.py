"""Calendar expressions on date columns. All ranges include both ends."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_count(start: Column, end: Column) -> Column:
    return F.datediff(end, start) + 1


def is_full_month(start: Column, end: Column, strict: bool = True) -> Column:
    """Strict: exactly one calendar month. Loose: starts on a 1st and ends on a month end."""
    on_first = F.dayofmonth(start) == 1
    whole = (end == F.last_day(start)) if strict else (end == F.last_day(end))
    return F.coalesce(on_first & whole, F.lit(False))


def _range(start: Column, end: Column) -> Column:
    return F.struct(start.cast("date").alias("start"), end.cast("date").alias("end"))


def month_ranges(start: Column, end: Column) -> Column:
    """Array of calendar months clipped to ``[start, end]``; empty when start > end."""
    firsts = F.sequence(F.trunc(start, "MM"), end, F.expr("INTERVAL 1 MONTH"))
    clipped = F.transform(
        firsts, lambda m: _range(F.greatest(m.cast("date"), start), F.least(F.last_day(m.cast("date")), end))
    )
    return F.when(start <= end, clipped).otherwise(F.array().cast("array<struct<start: date, end: date>>"))


def step_ranges(start: Column, end: Column, days: Column | int) -> Column:
    """Consecutive pieces of ``days`` days, the last one clipped.

    Built from offsets, so a step that depends on the row works too.
    """
    step = F.lit(days) if isinstance(days, int) else days
    pieces = F.ceil(day_count(start, end) / step).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), F.greatest(pieces, F.lit(1)) - 1),
        lambda i: _range(
            F.date_add(start, (i * step).cast("int")),
            F.least(F.date_add(start, ((i + 1) * step - 1).cast("int")), end),
        ),
    )
    return F.when(start <= end, cut).otherwise(F.array().cast("array<struct<start: date, end: date>>"))


def week_ranges(start: Column, end: Column) -> Column:
    return step_ranges(start, end, 7)


def split_months(start: Column, end: Column, factor: int) -> Column:
    """Monthly pieces, each cut again into at most ``factor`` parts of ceil(days/factor) days."""
    if factor <= 1:
        return month_ranges(start, end)
    return F.flatten(
        F.transform(
            month_ranges(start, end),
            lambda r: step_ranges(
                r["start"], r["end"], F.ceil(day_count(r["start"], r["end"]) / F.lit(factor)).cast("int")
            ),
        )
    )


def reduced_ranges(start: Column, end: Column, factor: int = 2) -> Column:
    """Smaller ranges after an overload: steps of floor(days/factor), at least one day."""
    step = F.greatest(F.lit(1), F.floor(day_count(start, end) / F.lit(factor)).cast("int"))
    return step_ranges(start, end, step)


def trailing_window(as_of: Column, days: int = 30) -> Column:
    return _range(F.date_sub(as_of, days), as_of)


def hour_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd-HH")


def seconds_between(start: Column, end: Column) -> Column:
    """Signed difference in seconds, exact to the microsecond."""
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(1e6)
