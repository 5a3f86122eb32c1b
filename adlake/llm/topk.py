"""Exact top-k by inner product: columnar branch and bound.

Vectors are held in vertical layout and the products accumulate one block of dimensions at a time.
After each block a pair of query and candidate stays only if its sum so far plus the largest
possible rest (the product of the remaining norms) can reach the query's k-th best score; survivors
are compacted before the next block.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.common import map_batches, staged

#: Queries answered in one pass over the candidates: the bound of what a task is sent.
QUERY_BLOCK = 20_000
TILE, ROWS, DIMS = 512, 4096, 16
NONE = -(2**62)


def whole_vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, vec) with ``floor(scale * x)``; one row per vec_id, the smallest vector where there are several.

    Rows with a null id or vector, or with a null or non-finite component, take no part.
    """
    x = F.transform("embedding", lambda v: v.cast("double"))
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    vec = F.transform(x, lambda v: F.floor(v * float(scale)).cast("long"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & good).groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(vec).alias("vec"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column, shorter ones filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def rest_norms(x: np.ndarray) -> np.ndarray:
    """Norm of the dimensions from each block's start on; one column per block, and a zero."""
    blocks = [np.sqrt((x[:, d:] ** 2).sum(1)) for d in range(0, x.shape[1], DIMS)]
    return np.stack([*blocks, np.zeros(len(x))], 1)


class Best:
    """The k best candidates of each query of a block, so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.vectors, self.rest = vectors, rest_norms(vectors)
        self.scores = np.full((len(ids), k), NONE, np.int64)
        self.found = np.full((len(ids), k), -1, np.int64)

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        width = self.vectors.shape[1]
        x = x[:, :width] if x.shape[1] >= width else np.pad(x, ((0, 0), (0, width - x.shape[1])))
        rest = rest_norms(x)
        columns = np.asfortranarray(x)
        for at in range(0, len(self.ids), TILE):
            self.tile(slice(at, at + TILE), ids, columns, rest)

    def tile(self, part: slice, ids: np.ndarray, x: np.ndarray, rest: np.ndarray) -> None:
        own, q, q_rest, least = self.ids[part], self.vectors[part], self.rest[part], self.scores[part, -1].astype(float)
        width = q.shape[1]
        sums = np.zeros((len(x), len(q)))
        rows = None
        for b, d in enumerate(range(0, width, DIMS)):
            if rows is None:
                sums += x[:, d : d + DIMS] @ q[:, d : d + DIMS].T
                alive = sums + rest[:, b + 1, None] * q_rest[None, :, b + 1] * (1 + 1e-9) + 1e-6 >= least
                if alive.mean() < 0.05:
                    rows, cols = np.nonzero(alive)
                    kept = sums[rows, cols]
            else:
                for c in range(d, min(d + DIMS, width)):
                    kept = kept + x[rows, c] * q[cols, c]
                stay = kept + rest[rows, b + 1] * q_rest[cols, b + 1] * (1 + 1e-9) + 1e-6 >= least[cols]
                rows, cols, kept = rows[stay], cols[stay], kept[stay]
        if rows is None:
            sums[ids[:, None] == own[None, :]] = NONE
            if len(x) > self.k:
                least = np.maximum(least, np.partition(sums, len(x) - self.k, axis=0)[len(x) - self.k])
            rows, cols = np.nonzero((sums >= least) & (sums > NONE))
            kept = sums[rows, cols]
        stay = ids[rows] != own[cols]
        rows, cols, kept = rows[stay], cols[stay], kept[stay]
        who = np.concatenate([np.repeat(np.arange(len(q)), self.k), cols])
        score = np.concatenate([self.scores[part].ravel(), kept.astype(np.int64)])
        vec = np.concatenate([self.found[part].ravel(), ids[rows]])
        order = np.lexsort((vec, -score, who))
        who, score, vec = who[order], score[order], vec[order]
        first = np.searchsorted(who, np.arange(len(q)))
        take = first[:, None] + np.arange(self.k)
        self.scores[part], self.found[part] = score[take], vec[take]


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest inner products over all other rows of (vec_id, vec).

    Ties go to the smaller vec_id. Vectors of different length are compared as if the shorter one
    went on with zeros. Without queries, or for a single vector, there are no rows. The queries are
    cut by hash into blocks of about ``query_block``; each block is one pass over all candidates.
    """
    spark = vectors.sparkSession
    width = vectors.agg(F.coalesce(F.max(F.size("vec")), F.lit(0)).alias("w"), F.count(F.when(is_query, 1)).alias("n")).first()
    schema = "query_id long, vec_id long, score long"
    blocks = max(1, ceil(width["n"] / query_block))
    out = spark.createDataFrame([], schema)
    for block in range(blocks):
        got = vectors.where(is_query & (F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block)).toArrow()
        ids = got.column("vec_id").to_numpy().astype(np.int64)
        if not len(ids):
            continue
        q = matrix(got.column("vec"))
        q = np.pad(q, ((0, 0), (0, max(1, width["w"]) - q.shape[1])))

        def work(batches: Iterator[pa.RecordBatch], ids=ids, q=q) -> Iterator[dict]:
            best = Best(ids, q, k)
            held: list[pa.RecordBatch] = []

            def flush():
                t = pa.Table.from_batches(held)
                best.add(t.column("vec_id").to_numpy().astype(np.int64), matrix(t.column("vec")))
                held.clear()

            for b in batches:
                if b.num_rows:
                    held.append(b)
                if sum(x.num_rows for x in held) >= ROWS:
                    flush()
            if held:
                flush()
            at, _ = np.nonzero(best.scores > NONE)
            ok = best.scores > NONE
            yield {"query_id": best.ids[at], "vec_id": best.found[ok], "score": best.scores[ok]}

        out = out.unionByName(map_batches(vectors.select("vec_id", "vec"), schema, work))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(rows: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """``top_k`` of an embeddings table; queries are the rows whose vec_id is divisible by ``every``."""
    vectors = staged(whole_vectors(rows), "vectors")
    return top_k(vectors, F.col("vec_id") % every == 0, k)
