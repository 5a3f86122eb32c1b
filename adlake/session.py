"""Session settings the jobs rely on, and the shared folder they may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs the next operator a shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles methods over 8000 bytecodes. A wide model fused into one
    # such method runs interpreted, three times slower than split projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
#: Set by queries whose rows become many times wider than they are in the file.
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"

#: Shuffle files are removed when the query that wrote them ends, not when the driver happens to collect garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries run inside, and streams started inside, leave no shuffle files. For loads, whose frames are read once."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def tune(spark: SparkSession) -> SparkSession:
    spark.conf.unset(SPLIT_BYTES)  # one query's choice does not hold for the next
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    app: str = "adlake", cores: str = "*", shuffle_partitions: int = 8, checkpoint_dir: str | None = None
) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors would each see a different one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="adlake-")
    return f"{base.rstrip('/')}/adlake/{name}-{uuid.uuid4().hex}"
