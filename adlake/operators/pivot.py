"""Action arrays in long form, and named metrics over them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions.jsonx import number


@dataclass(frozen=True)
class Metric:
    """A report metric: a payload scalar, or the first action of a type in an array."""

    name: str
    parent: str
    action_type: str | None = None

    @classmethod
    def of(cls, name: str, field: str) -> Metric:
        """From the short form ``scalar`` or ``parent:action_type``."""
        parent, _, kind = field.partition(":")
        return cls(name, parent, kind or None)

    def column(self, payload: str) -> Column:
        """The metric as a column. Written as SQL text: a wide model has dozens of these,
        and text is one call to the JVM where chained functions are ten."""
        source = f"{payload}.{self.parent}"
        if self.action_type is not None:
            kind = self.action_type.replace("'", "\\'")
            at = f"CAST(array_position({source}.action_type, '{kind}') AS INT) - 1"
            source = f"get({source}.value, {at})"
        return F.expr(f"coalesce(try_cast({source} AS DOUBLE), 0D)").alias(self.name)


def metric_columns(payload: str, metrics: Sequence[Metric]) -> list[Column]:
    return [m.column(payload) for m in metrics]


def long_actions(df: DataFrame, keys: Sequence[str], payload: str, parents: Sequence[str]) -> DataFrame:
    """One row per array entry: keys, parent, position, action_type, value."""
    empty = F.array().cast("array<struct<action_type: string, value: string>>")

    def tagged(parent: str) -> Column:
        def entry(a: Column, i: Column) -> Column:
            return F.struct(
                F.lit(parent).alias("parent"), i.alias("position"), a["action_type"].alias("action_type"),
                number(a["value"]).alias("value"),
            )

        return F.transform(F.coalesce(F.col(payload)[parent], empty), entry)

    return df.select(*keys, F.inline(F.concat(*[tagged(p) for p in parents])))


def pivot_actions(long: DataFrame, keys: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    """Long form back to columns, first entry of each type per key, 0 where there is none.

    The kinds are listed, so no extra job is needed to find them.
    """
    wide = long.groupBy(*keys).pivot("action_type", list(kinds)).agg(F.min_by("value", "position"))
    return wide.select(*keys, *[F.coalesce(F.col(f"`{k}`"), F.lit(0.0)).alias(k) for k in kinds])


def sum_actions(long: DataFrame, keys: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    """Totals per action type over all entries of a key."""
    return long.groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.when(F.col("action_type") == k, F.col("value"))), F.lit(0.0)).alias(k) for k in kinds]
    )


def catalogue_pivot(df: DataFrame, keys: Sequence[str], payload: str, catalogue: DataFrame, max_names: int = 10_000) -> DataFrame:
    """Metrics named by a catalogue table (name, parent, action_type) as columns of ``df``'s rows.

    Each metric is the value of the first entry of its type in its parent array (by position), 0 where
    there is none or it is not a number. The action arrays are unfolded once, joined to the
    catalogue and pivoted over the names the catalogue holds, read at run time: changing the table
    changes the columns. The catalogue is sent whole to every task, so it may hold at most
    ``max_names`` names. Rows keep one output row per key, also without any action.
    """
    entries = catalogue.select("name", "parent", "action_type").dropDuplicates(["parent", "action_type", "name"])
    names = [r[0] for r in entries.select("name").distinct().orderBy("name").limit(max_names + 1).collect()]
    if len(names) > max_names:
        raise ValueError(f"a catalogue of more than {max_names} names")
    parents = sorted({r[0] for r in entries.select("parent").distinct().collect()})
    long = long_actions(df, keys, payload, parents)
    hits = long.join(F.broadcast(entries), ["parent", "action_type"])
    wide = hits.groupBy(*keys).pivot("name", names).agg(F.min_by("value", "position"))
    out = df.select(*keys).join(wide, list(keys), "left")
    return out.select(*keys, *[F.coalesce(F.col(f"`{n}`"), F.lit(0.0)).alias(n) for n in names])
