"""Reading report payloads: text defaults to '', numbers to 0, dates to NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def number(c: Column) -> Column:
    """Number held as JSON text or JSON number; missing or unparsable gives 0."""
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def day(c: Column, strict: bool = False) -> Column:
    """``yyyy-MM-dd`` text as a date. ``strict`` raises on anything else."""
    return F.to_date(c, "yyyy-MM-dd") if strict else c.try_cast("date")


def or_null(c: Column) -> Column:
    """Empty text counts as missing."""
    return F.nullif(c, F.lit(""))


def first_filled(*cols: Column, default: Column | None = None) -> Column:
    parts = [or_null(c) for c in cols]
    return F.coalesce(*parts, default) if default is not None else F.coalesce(*parts)


def surrogate_key(*parts: Column) -> Column:
    return F.concat_ws("_", *[text(p) for p in parts])


def first_action(actions: Column, action_type: str) -> Column:
    """Value of the first array entry with the given type, 0 when there is none.

    ``array_position`` stops at the first hit and, unlike ``filter`` with a lambda,
    is compiled into the stage; ``get`` gives NULL for position 0 (no hit).
    """
    position = F.array_position(actions["action_type"], F.lit(action_type)).cast("int")
    return number(F.get(actions["value"], position - 1))


def all_zero(*metrics: Column) -> Column:
    """True when every metric is 0 or missing."""
    out = F.lit(True)
    for m in metrics:
        out = out & (number(m) == 0)
    return out
