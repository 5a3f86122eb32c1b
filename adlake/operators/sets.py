"""Semi joins, differences and unions on keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def only_known(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(known.select(*keys), list(keys), "left_semi")


def missing_ids(wanted: DataFrame, have: DataFrame, keys: Sequence[str]) -> DataFrame:
    return wanted.join(have.select(*keys), list(keys), "left_anti")


def distinct_ids(df: DataFrame, column: str) -> DataFrame:
    c = F.col(column)
    return df.filter(c.isNotNull() & (c.cast("string") != "")).select(column).distinct()


def concat(*frames: DataFrame) -> DataFrame:
    """Pages, waves or chunks put together; a column some of them lack is NULL there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def field_union(*lists: Column) -> Column:
    """Field names in first-seen order."""
    return F.array_distinct(F.flatten(F.array(*lists)))


def delete_keys(df: DataFrame, ids: DataFrame | None, key: str) -> DataFrame:
    """Rows left after deleting an id list; ``None`` deletes everything."""
    return df.limit(0) if ids is None else df.join(ids.select(key), key, "left_anti")


def delete_count(df: DataFrame, ids: DataFrame | None, key: str) -> DataFrame:
    gone = df if ids is None else df.join(ids.select(key), key, "left_semi")
    return gone.agg(F.count(F.lit(1)).alias("deleted_count"))


def matching(df: DataFrame, **equals) -> DataFrame:
    """Rows that equal every given value; the filters reach the scan."""
    for name, value in equals.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def with_batch(df: DataFrame, key: str, size: int, buckets: int = 256) -> DataFrame:
    """Number unique ids into batches of ``size`` (0, 1, 2, …), only the last one short.

    Ranks are taken inside hash buckets and shifted by the bucket's start, which
    comes from one small row per bucket, so no task sees the whole list.
    """
    from pyspark.sql import Window

    bucketed = df.withColumn("__b", F.pmod(F.xxhash64(key), F.lit(buckets)))
    sizes = bucketed.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    # at most `buckets` rows: a single-task running sum is bounded
    before = Window.partitionBy(F.lit(0)).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__b").orderBy(key)
    return (
        bucketed.withColumn("__rank", F.row_number().over(inside) - 1)
        .join(starts, "__b")
        .withColumn("batch_id", F.floor((F.col("__start") + F.col("__rank")) / F.lit(size)).cast("bigint"))
        .drop("__b", "__start", "__rank")
    )


def numbered(df: DataFrame, order: Sequence[str], name: str = "row_number") -> DataFrame:
    """Row numbers from 0 in the order of ``order`` (ties in any order), and no task sees all rows.

    A range shuffle puts neighbouring rows in one partition, sorted there; a row's number is its place
    in its partition plus the rows of all partitions before it. Those starts come from one count per
    partition, a table as long as the partition count. Both uses of the sorted rows share one shuffle.
    """
    from pyspark.sql import Window

    low = (1 << 33) - 1
    tagged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    tagged = tagged.withColumn("__part", F.shiftright("__id", 33))
    sizes = tagged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    out = tagged.join(F.broadcast(starts), "__part")
    return out.withColumn(name, F.col("__start") + F.col("__id").bitwiseAND(F.lit(low))).drop("__id", "__part", "__start")


def with_batch_in_order(df: DataFrame, key: str, size: int) -> DataFrame:
    """Number ids into batches of ``size`` in the order of ``key`` (0, 1, 2, …), only the last one short."""
    rows = numbered(df, [key], "__row")
    return rows.withColumn("batch_id", F.floor(F.col("__row") / F.lit(size)).cast("bigint")).drop("__row")
