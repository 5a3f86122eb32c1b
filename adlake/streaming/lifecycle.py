"""Job states on a stream of job events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from adlake.operators.joblog import lifecycle
from adlake.streaming.ingest import read_updates, update_stream


def run_lifecycle(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """The batch aggregate, maintained per job; every change is written out."""
    return update_stream(lifecycle(events), path, checkpoint)


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    return read_updates(spark, path, ["job_id"])
