"""What several of the operators share: staging, bounded Arrow batches, hashing, words and shingles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.session import shared_dir, tune

SHINGLE_WORDS = 5
#: Rows of a batch handed to Python: keeps the memory of one batch small where texts are very long.
BATCH_ROWS = 512


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the folder all executors share, and read again.

    A lost executor then costs no recomputation, Spark knows the real size of the result, and a
    frame used twice is computed once.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_bucket(column: str, modulus: int) -> Column:
    """crc32 of a value as text, modulo ``modulus``; a null value counts as empty text."""
    return (F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus).cast("int")


def sample_rate(labelled: DataFrame, bound: int) -> float:
    """The share of rows that gives about ``bound`` of them; 1 where there are fewer."""
    return min(1.0, bound / max(1, labelled.count()))


def in_sample(column: Column, rate: float) -> Column:
    """A sample by hash, the same on every run and after every retry."""
    return F.pmod(F.xxhash64(column, F.lit("sample")), F.lit(1_000_000)) < int(rate * 1_000_000)


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits; null text has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles(tokens: Column, n: int = SHINGLE_WORDS) -> Column:
    """Distinct 64-bit hashes of all runs of ``n`` words.

    A text of fewer words, but at least one, has a single shingle: all its words. A text without
    words has none.
    """
    runs = F.transform(F.sequence(F.lit(1), F.size(tokens) - (n - 1)), lambda i: F.xxhash64(*[F.element_at(tokens, i + k) for k in range(n)]))
    whole = F.array(F.xxhash64(F.array_join(tokens, " "), F.lit(1)))
    none = F.array().cast("array<bigint>")
    return F.array_distinct(F.when(F.size(tokens) >= n, runs).when(F.size(tokens) > 0, whole).otherwise(none))


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), elementwise."""
    x = (x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def map_batches(df: DataFrame, schema: str, work: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]]) -> DataFrame:
    """``work`` turns a partition's Arrow batches into dicts of columns, one per output batch."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in work(batches):
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type, from_pandas=False) for c, f in ((columns[f.name], f) for f in target)]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(run, schema)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all ranges ``start .. start + length`` one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
