"""Hard-negative mining through an inverted multi-index.

Every vector is split into two halves. A codebook per half (k-means, fitted on a bounded sample) gives
each row two codes; the pair of codes is its cell. A cell's radius per half is the largest distance of
a member's half from its centroid, so ``q·x <= Σ_halves (q_h·c_h + |q_h| r_h)`` for every member x.
An anchor visits cells in the order of that summed bound with the multi-sequence heap (two lists of half
bounds, each sorted once) and stops when the next bound falls under a score it has certified: for
positives, a lower bound of its k-th best same-label row (cell lower bounds ``q·c - |q| r`` and cell
counts per label); for negatives, the bottom of its lowest window. Visited cells are joined with their
members and scored exactly in integers; per-cell best rows are merged per anchor.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adlake.llm.common import in_sample, map_batches, sample_rate, staged

CODES = 16
#: Rows the codebooks are fitted on (a bounded, documented sample; every row is indexed).
SAMPLE_ROWS = 20_000
#: Members of one (cell, part) group, and anchors of one block: bound the memory of one task.
CELL_ROWS = 20_000
ANCHOR_ROWS = 50_000
#: Cell-and-label counts sent to the routing tasks at most; beyond it every cell is visited.
MAX_STATS = 1_000_000
#: Anchors scored against a group at once.
CHUNK = 256
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def valid_rows(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(row, vec_id, label, vec): rows with a vec_id, a label and a whole finite vector; labels of vec_id % 7 = 0 moved on by one (mod 10).

    ``vec`` holds ``floor(scale * x)`` of each component, computed in doubles; a vector shorter than
    another counts as padded with zeros.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    vec = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), vec.alias("vec"))


def to_matrix(column, width: int) -> np.ndarray:
    """Float matrix of list values, zero-padded to ``width``."""
    values = column.to_pylist() if hasattr(column, "to_pylist") else list(column)
    out = np.zeros((len(values), width))
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    return out


def exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of two integral float matrices; Python integers where int64 could overflow."""
    top = max(float(np.abs(x).max(initial=0)), 1.0) * max(float(np.abs(y).max(initial=0)), 1.0) * max(x.shape[1], 1)
    if top < 2.0**62:
        return x.astype(np.int64) @ y.astype(np.int64).T
    to_int = np.vectorize(int, otypes=[object])
    return to_int(x) @ to_int(y).T


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of ``x`` by Lloyd's rounds from ``k`` evenly spaced rows; fewer distinct rows give fewer centroids."""
    distinct = np.unique(x, axis=0)
    if len(distinct) <= k:
        return distinct
    c = distinct[np.linspace(0, len(distinct) - 1, k).astype(int)]
    for _ in range(rounds):
        near = np.argmin((x**2).sum(1)[:, None] - 2 * x @ c.T + (c**2).sum(1)[None, :], axis=1)
        for j in range(len(c)):
            if (near == j).any():
                c[j] = x[near == j].mean(0)
    return c


class Codebooks:
    """Two half-space codebooks and the radii of their cells."""

    def __init__(self, sample: np.ndarray, width: int, codes: int):
        self.width, self.half = width, width // 2
        scaled = np.clip(sample, -(2.0**40), 2.0**40)
        self.books = [kmeans(scaled[:, : self.half], codes), kmeans(scaled[:, self.half :], codes)]
        self.radii = [np.zeros(len(b)) for b in self.books]

    def halves(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[:, : self.half], x[:, self.half :]]

    def assign(self, x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        codes, dist = [], []
        for h, book in zip(self.halves(np.clip(x, -(2.0**40), 2.0**40)), self.books):
            d = np.sqrt(np.maximum(((h[:, None, :] - book[None, :, :]) ** 2).sum(2), 0))
            codes.append(np.argmin(d, axis=1))
            dist.append(d[np.arange(len(h)), codes[-1]])
        return codes, dist

    def bounds(self, q: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Upper and lower bounds per half and code of ``q``'s score with any member, with a margin for rounding."""
        up, low = [], []
        for h, book, r in zip(self.halves(q[None, :])[0:2], self.books, self.radii):
            h = h[0]
            norm = float(np.sqrt((h**2).sum()))
            centre = book @ h
            slack = 1e-9 * (np.abs(book) @ np.abs(h) + norm * r) + 1
            up.append(centre + norm * r + slack)
            low.append(centre - norm * r - slack)
        return up, low


def cells_in_order(up: list[np.ndarray]) -> Iterator[tuple[float, int, int]]:
    """Cells (bound, code 1, code 2) by falling summed bound: the multi-sequence heap over two sorted lists."""
    o1, o2 = np.argsort(-up[0], kind="stable"), np.argsort(-up[1], kind="stable")
    s1, s2 = up[0][o1], up[1][o2]
    heap, seen = [(-(s1[0] + s2[0]), 0, 0)], {(0, 0)}
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, int(o1[i]), int(o2[j])
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(s1) and b < len(s2) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (-(s1[a] + s2[b]), a, b))


def certified_floor(up, low, counts: dict, label: int, k: int) -> float:
    """A score that at least ``k`` rows of ``label`` other than the anchor reach: the k-th largest cell lower bound, counted by members.

    One member is discounted for the anchor itself. Without enough rows nothing is certified (minus infinity).
    """
    have = sorted(((low[0][c1] + low[1][c2], n) for (c1, c2, lab), n in counts.items() if lab == label), reverse=True)
    need = k + 1
    for floor, n in have:
        need -= n
        if need <= 0:
            return floor
    return -np.inf


def mine(embeddings: DataFrame, k: int = 5, every: int = 100, codes: int = CODES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per anchor, positive and negative: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are valid rows whose vec_id is divisible by ``every``. Scores are integer inner products of
    ``floor(256 x)``; higher scores first, ties to the smaller vec_id. A positive is one of the anchor's
    ``k`` best rows of its label with another vec_id; its negatives are the ``k`` best rows of another
    label whose score n keeps ``80 p <= 100 n <= 100 p``. Rows with a null vec_id, label, vector or
    component, or a NaN or infinite component, take no part; repeated rows each count (a repeated
    anchor gives its rows twice); other columns are not read. An empty table, or anchors without
    positives or negatives, give no rows.
    """
    spark = embeddings.sparkSession
    rows = staged(valid_rows(embeddings.select("vec_id", "label", "embedding")), "vectors")
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
    if not n:
        return spark.createDataFrame([], RESULT)
    width = max(int(width), 2)
    sample = rows.where(in_sample(F.col("row"), sample_rate(rows, sample_rows))).select("vec").toArrow()
    books = Codebooks(to_matrix(sample.column("vec"), width), width, codes)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            (c1, c2), (r1, r2) = books.assign(to_matrix(b.column("vec"), width))
            yield {"row": b.column("row"), "vec_id": b.column("vec_id"), "label": b.column("label"), "vec": b.column("vec"), "c1": c1, "c2": c2, "r1": r1, "r2": r2}

    members = staged(map_batches(rows, "row long, vec_id long, label long, vec array<double>, c1 int, c2 int, r1 double, r2 double", assign), "cells")
    for h, name in enumerate(("1", "2")):
        for code, r in members.groupBy(f"c{name}").agg(F.max(f"r{name}")).collect():
            books.radii[h][code] = r
    stats = staged(members.groupBy("c1", "c2", "label").count(), "cell_counts")
    # Counts per cell and label certify a positive's floor; without a bound on their number none is certified.
    certify = stats.count() <= MAX_STATS
    counts = {(c1, c2, lab): cnt for c1, c2, lab, cnt in stats.collect()} if certify else {}
    cells = {(c1, c2): cnt for c1, c2, cnt in stats.groupBy("c1", "c2").agg(F.sum("count")).collect()}
    parts = {cell: max(1, ceil(cnt / CELL_ROWS)) for cell, cnt in cells.items()}
    # rows that repeat an anchor's vec_id are not its candidates, so they count against its floor
    copies = members.groupBy("vec_id").agg(F.count("*").alias("copies"))
    anchors = staged(members.where(F.col("vec_id") % every == 0).select("row", "vec_id", "label", "vec").join(copies, "vec_id"), "anchors")
    blocks = max(1, ceil(anchors.count() / ANCHOR_ROWS))
    split = F.create_map(*[F.lit(v) for (c1, c2), n in parts.items() for v in (c1 * codes + c2, n)])
    grouped = members.withColumn("part", F.pmod(F.xxhash64("row"), F.element_at(split, F.col("c1") * codes + F.col("c2")).cast("long")).cast("int"))
    grouped = grouped.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def route(given: bool):
        """Anchors to the (cell, part) groups they must visit: cells by falling bound, until one falls under the anchor's floor."""

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for b in batches:
                x = to_matrix(b.column("vec"), width)
                out: dict = {c: [] for c in ("row", "c1", "c2", "part", "block")}
                labels = b.column("label").to_pylist()
                floors = b.column("floor").to_pylist() if given else [None] * len(labels)
                copies = b.column("copies").to_pylist()
                for i, row in enumerate(b.column("row").to_pylist()):
                    up, low = books.bounds(x[i])
                    floor = floors[i] if given else (certified_floor(up, low, counts, labels[i], k + copies[i] - 1) if certify else -np.inf)
                    block = row % blocks
                    for bound, c1, c2 in cells_in_order(up):
                        if bound < floor:
                            break
                        for p in range(parts.get((c1, c2), 0)):
                            for c, v in zip(out, (row, c1, c2, p, block)):
                                out[c].append(v)
                yield out

        return work

    def score(windows: bool):
        def work(group: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(group) and len(asked):
                y = to_matrix(group["vec"], width)
                ids, labels = group["vec_id"].to_numpy(), group["label"].to_numpy()
                for at in range(0, len(asked), CHUNK):
                    a = asked.iloc[at : at + CHUNK]
                    s = exact(to_matrix(a["vec"], width), y)
                    for i, anchor in enumerate(a.itertuples(index=False)):
                        other = ids != anchor.vec_id
                        if not windows:
                            out += best(anchor, None, s[i], other & (labels == anchor.label), ids, k)
                            continue
                        for pid, p in zip(anchor.positive_ids, anchor.positive_scores):
                            inside = (80 * p <= 100 * s[i]) & (100 * s[i] <= 100 * p)
                            out += best(anchor, (pid, p), s[i], other & (labels != anchor.label) & np.asarray(inside, bool), ids, k)
            return pd.DataFrame(out, columns=["row", "anchor_id", "positive_id", "positive_score", "vec_id", "score"])

        return work

    found = "row long, anchor_id long, positive_id long, positive_score long, vec_id long, score long"
    keys = ("c1", "c2", "part", "block")
    visits = map_batches(anchors, "row long, c1 int, c2 int, part int, block int", route(False))
    near = grouped.groupBy(*keys).cogroup(visits.join(anchors, "row").groupBy(*keys)).applyInPandas(score(False), found)
    by_anchor = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    positives = staged(near.withColumn("rank", F.row_number().over(by_anchor)).where(f"rank <= {k}"), "positives")

    lists = positives.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("p"))
    # n >= 0.8 p for a window of p >= 0; an anchor without such a positive has no window
    lowest = F.array_min(F.filter("p.score", lambda p: p >= 0))
    floor = ((lowest * 80 + 99) / 100).cast("long").cast("double")
    lists = lists.select("row", F.col("p.vec_id").alias("positive_ids"), F.col("p.score").alias("positive_scores"), floor.alias("floor"))
    asking = anchors.join(lists.where(F.col("floor").isNotNull()), "row")
    visits = map_batches(asking, "row long, c1 int, c2 int, part int, block int", route(True))
    far = grouped.groupBy(*keys).cogroup(visits.join(asking.drop("floor"), "row").groupBy(*keys)).applyInPandas(score(True), found)
    by_pair = Window.partitionBy("row", "positive_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = far.withColumn("rank", F.row_number().over(by_pair)).where(f"rank <= {k}")
    return ranked.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def best(anchor, positive, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, k: int) -> list[tuple]:
    """The ``k`` best allowed rows of one anchor in one group, by score and then smaller vec_id."""
    at = np.flatnonzero(allowed)
    if not len(at):
        return []
    values = np.asarray(scores[at])
    if len(at) > k:
        kth = np.sort(values.astype(float))[-k] if values.dtype == object else np.partition(values, -k)[-k]
        keep = values >= kth
        at, values = at[keep], values[keep]
    order = sorted(range(len(at)), key=lambda j: (-values[j], ids[at[j]]))[:k]
    pid, p = positive if positive else (None, None)
    return [(anchor.row, anchor.vec_id, pid, p, int(ids[at[j]]), int(values[j])) for j in order]
