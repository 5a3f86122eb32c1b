"""Named queries: a Spark function of ``(spark, folder)`` and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(fn(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the test tables have them."""
    stamped = {f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"}
    if not stamped:
        return df
    return df.select(*[F.col(f"`{c}`").cast("timestamp_ntz").alias(c) if c in stamped else F.col(f"`{c}`") for c in df.columns])
