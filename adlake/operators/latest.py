"""Keeping one version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEEP = "__keep"
#: Versions with several documents that are listed one by one; if there are more, all rows keep their document.
LISTED_VERSIONS = 100_000


def _columns(keys: Sequence[str]) -> list[Column]:
    return [F.col(k) for k in keys]


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows per key.

    The filter on the rank lets Catalyst keep only ``n`` rows per key on the map
    side (WindowGroupLimit), so a key with a third of the rows shuffles at most
    ``n`` rows per task.
    """
    window = Window.partitionBy(*_columns(keys)).orderBy(*order)
    return df.withColumn(KEEP, F.row_number().over(window)).filter(F.col(KEEP) <= n).drop(KEEP)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], version: str = "created_at", ties: Sequence[str] = ()
) -> DataFrame:
    """Newest version per key; equal versions are settled by ``ties``, highest first."""
    order = [F.col(c).desc_nulls_last() for c in (version, *ties)]
    return top_per_key(df, keys, order)


def with_deciding_text(df: DataFrame, version: Sequence[str], column: str, name: str, listed: int = LISTED_VERSIONS) -> DataFrame:
    """``df`` with a column ``name``: the text of ``column`` in rows whose ``version`` columns several rows share, else null.

    For a wide text that only settles the last ties of an order: it then need not be shuffled and sorted
    with every row. A first pass over hashes of the version, without the text, finds the shared ones. At
    most ``listed`` of them are sent to all tasks; if there are more, every row keeps its text.
    """
    hashed = F.xxhash64(*_columns(version)).alias("__version")
    shared = df.select(hashed).groupBy("__version").count().where("count > 1").select("__version").limit(listed + 1)
    more = shared.agg(F.count(F.lit(1)) > listed).scalar()
    marked = df.withColumn("__version", hashed).join(F.broadcast(shared.withColumn("__shared", F.lit(True))), "__version", "left")
    kept = F.when(F.col("__shared").isNotNull() | more, F.col(column))
    return marked.withColumn(name, kept).drop("__version", "__shared")


def last_wins(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """What a map filled in ``seq`` order would hold; rows without a key are skipped."""
    filled = df
    for k in keys:
        filled = filled.filter(F.col(k).isNotNull() & (F.col(k).cast("string") != ""))
    return latest_per_key(filled, keys, version=seq)


def merge_latest(
    target: DataFrame, delta: DataFrame, keys: Sequence[str], version: str = "created_at", ties: Sequence[str] = ()
) -> DataFrame:
    return latest_per_key(target.unionByName(delta), keys, version, ties)


def replace_keys(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete the keys the delta brings, then insert the delta."""
    incoming = delta.select(*keys).distinct()
    return target.join(incoming, list(keys), "left_anti").unionByName(delta)


def override(base: DataFrame, update: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Union in which a row of ``update`` replaces the row of ``base`` with its key."""
    ranked = base.withColumn("__side", F.lit(0)).unionByName(
        update.withColumn("__side", F.lit(1)), allowMissingColumns=True
    )
    return latest_per_key(ranked, keys, version="__side").drop("__side")


def newer_than(df: DataFrame, watermark, version: str = "created_at", inclusive: bool = False) -> DataFrame:
    """Rows past a high-watermark; ``None`` (an empty target) keeps everything."""
    if watermark is None:
        return df
    c = F.col(version)
    mark = F.lit(watermark).cast("timestamp")
    return df.filter(c >= mark if inclusive else c > mark)


def distinct_dimension(
    df: DataFrame, keys: Sequence[str], attributes: Sequence[str], version: str = "created_at"
) -> DataFrame:
    """Newest attribute row per key. The attributes settle ties, so the result is stable.

    A separate DISTINCT would add a shuffle without changing the answer.
    """
    rest = [a for a in attributes if a not in keys]
    return latest_per_key(df.select(*keys, *rest, version), keys, version, ties=rest)
