"""The corpus pipeline: toxicity, line dedup, near-dedup, benchmark decontamination, packing.

Each stage reads what its predecessor kept; its result is written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm import decontaminate, line_dedup, near_dup, packing, toxicity
from adlake.llm.common import prepared, staged, table
from adlake.llm.queries import tokenizer


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id is in ``ids``; rows with a null doc_id stay."""
    gone = ids.select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("__id"), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic; a machine fitted on the labelled documents of the stage's input."""
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return without(docs, staged(toxicity.toxicity(docs, machine).where("predicted = 1").select("doc_id"), "toxic"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier document has; documents of which nothing is left go."""
    prepared(spark)
    rows = line_dedup.line_dedup(docs)
    rows = rows.where((F.col("__cut") == 0) | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("__cut") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return rows.select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    prepared(spark)
    return without(docs, staged(near_dup.near_duplicates(docs).where("not kept").select("doc_id"), "copies"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without(docs, decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, in windows of lexical neighbours."""
    prepared(spark)
    return packing.packed(docs, tokenizer("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]

#: SQL can express neither the fitted machine nor the packing; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
