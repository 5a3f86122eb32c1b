"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are partitioned by the size of their shingle set. A partition's sketch holds an item's
smallest hashes, as many as an item of that size needs so that a text with the wanted share of its
shingles must hold one of them; so no containing document is missed. Candidates are verified
by exact containment. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.common import shingles, staged, words


def shingled(df: DataFrame, key: str) -> DataFrame:
    """(key, sh). Unfold ``sh`` with explode_outer: for explode, Spark infers a filter on its size and
    pushes it below the split into words, which then runs again for every shingle."""
    rows = df.select(F.col(key).cast("long").alias(key), words(F.col("text")).alias("__w")).where(F.col(key).isNotNull() & (F.size("__w") > 0))
    return rows.select(key, shingles(F.col("__w")).alias("sh"))


def sketch(items: DataFrame, containment: float) -> DataFrame:
    """(shingle, item_id, size, needed): the min-hash values of each item, as many as its size partition asks for."""
    sized = items.select("item_id", F.size("sh").alias("size"), F.explode("sh").alias("shingle"))
    part = F.floor(F.log2("size")).cast("int")
    sized = sized.withColumn("part", part).withColumn("needed", F.ceil(containment * F.col("size") - 1e-9).cast("int"))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.xxhash64("shingle"), "shingle"))
    most = F.floor((1 - containment) * (F.pow(F.lit(2.0), F.col("part") + 1) - 1) + 1e-9) + 1  # of the largest size of the partition
    return sized.withColumn("rank", rank).where(F.col("rank") <= most).select("shingle", "item_id", "size", "needed")


def contaminated(docs: DataFrame, benchmark: DataFrame, containment: float = 0.8) -> DataFrame:
    """(doc_id, item_id, shared, item_shingles, containment) of documents that hold an item.

    Shingles are runs of five lower-case words; an item of fewer words is found only as a whole
    text. Items and documents that are null, empty or have a null id never match. Rows that repeat
    an id count as one text with all their shingles. An empty table on either side gives no rows.
    """
    items = shingled(benchmark, "item_id").groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_set("sh"))).alias("sh"))
    items = staged(items, "items")
    probes = staged(sketch(items, containment), "sketch")
    runs = shingled(docs, "doc_id").select("doc_id", F.size("sh").alias("doc_size"), F.explode_outer("sh").alias("shingle"))
    hits = runs.join(probes, "shingle").where("doc_size >= needed").select("doc_id", "item_id").distinct()
    hits = staged(hits, "candidates")
    near = docs.join(hits.select(F.col("doc_id").alias("__id")).distinct(), F.col("doc_id").cast("long") == F.col("__id"), "left_semi")
    all_items = items.select("item_id", F.size("sh").alias("item_shingles"), F.explode("sh").alias("shingle"))
    runs = shingled(near, "doc_id").select("doc_id", F.explode_outer("sh").alias("shingle")).join(all_items, "shingle")
    found = runs.join(hits, ["doc_id", "item_id"]).groupBy("doc_id", "item_id", "item_shingles").agg(F.count_distinct("shingle").alias("shared"))
    found = found.withColumn("containment", F.col("shared") / F.col("item_shingles"))
    return found.where(F.col("shared") >= containment * F.col("item_shingles") - 1e-9).select("doc_id", "item_id", "shared", "item_shingles", "containment")
