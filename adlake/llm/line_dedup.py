"""Line dedup by pairwise alignment.

Documents that share a run of lines are found through hashes of line windows: from each line on, as
many lines as give ``min_words`` words. A document is paired with the first holder of each of its
windows (never with all holders), the two are aligned line by line by patience diff, and aligned
blocks of at least ``min_words`` words are deleted from the later document.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from adlake.llm.common import map_batches, staged

MIN_WORDS = 25


def signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def windows(lines: list[int], sizes: list[int], min_words: int) -> set[int]:
    """Hashes of the shortest runs of lines from each line on that have ``min_words`` words."""
    out, end, total = set(), 0, 0
    for i in range(len(lines)):
        while end < len(lines) and total < min_words:
            total += sizes[end]
            end += 1
        if total < min_words:
            break
        out.add(signed(xxh64_intdigest(b"".join(x.to_bytes(8, "little", signed=True) for x in lines[i:end]))))
        total -= sizes[i]
    return out


def anchors(a: list, b: list, a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """Longest chain, in order on both sides, of lines that occur once on each."""
    one, two = Counter(a[a0:a1]), Counter(b[b0:b1])
    where = {b[j]: j for j in range(b0, b1) if two[b[j]] == 1}
    pairs = [(i, where[a[i]]) for i in range(a0, a1) if one[a[i]] == 1 and a[i] in where]
    tops: list[int] = []
    piles: list[int] = []
    before = [-1] * len(pairs)
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(tops, j)
        before[n] = piles[k - 1] if k else -1
        tops[k : k + 1], piles[k : k + 1] = [j], [n]
    chain, n = [], piles[-1] if piles else -1
    while n >= 0:
        chain.append(pairs[n])
        n = before[n]
    return chain[::-1]


def numbered(lines: list) -> list[tuple]:
    """Each line with the number of its occurrence, which makes it unique."""
    seen: Counter = Counter()
    out = []
    for x in lines:
        out.append((x, seen[x]))
        seen[x] += 1
    return out


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places of equal lines, in order. A part without unique common lines is aligned by numbered lines."""
    out, todo = [], [(0, len(a), 0, len(b), a, b)]
    while todo:
        a0, a1, b0, b1, x, y = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        found = anchors(x, y, a0, a1, b0, b1)
        if not found:
            if x is not a:
                continue
            x = [None] * a0 + numbered(a[a0:a1])
            y = [None] * b0 + numbered(b[b0:b1])
            found = anchors(x, y, a0, a1, b0, b1)
        edges = [(a0 - 1, b0 - 1), *found, (a1, b1)]
        out += found
        if found:
            todo += [(i + 1, m, j + 1, n, a, b) for (i, j), (m, n) in zip(edges, edges[1:]) if i + 1 < m and j + 1 < n]
    return sorted(out)


def common_lines(later: list[int], earlier: list[int], sizes: list[int], min_words: int) -> list[int]:
    """Places in ``later`` of aligned blocks of enough words. Aligning goes on with the rest while it finds blocks, so that moved blocks count."""
    rest: list = list(later)
    cut: list[int] = []
    while True:
        blocks: list[list[tuple[int, int]]] = []
        for i, j in patience(rest, earlier):
            if blocks and blocks[-1][-1] == (i - 1, j - 1):
                blocks[-1].append((i, j))
            else:
                blocks.append([(i, j)])
        new = [i for block in blocks if sum(sizes[i] for i, _ in block) >= min_words for i, _ in block]
        if not new:
            return sorted(cut)
        cut += new
        for i in new:
            rest[i] = ("cut", i)


def lined(docs: DataFrame) -> DataFrame:
    """(doc_id, tk, lines, sizes, places) of the lines with words; one row per distinct text of a doc_id."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            out: dict = {"doc_id": b.column("doc_id"), "tk": b.column("tk"), "lines": [], "sizes": [], "places": []}
            for t in b.column("text").to_pylist():
                rows = [(n, x.strip()) for n, x in enumerate(t.split("\n"))]
                rows = [(n, x) for n, x in rows if x]
                out["lines"].append([signed(xxh64_intdigest(x.encode("utf-8", "surrogatepass"))) for _, x in rows])
                out["sizes"].append([len(x.split()) for _, x in rows])
                out["places"].append([n for n, _ in rows])
            yield out

    rows = docs.where("doc_id is not null and text <> ''").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tk"), "text")
    return map_batches(rows, "doc_id long, tk long, lines array<long>, sizes array<int>, places array<int>", work)


def line_cuts(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, tk, cut): places of the lines to delete from the text with hash ``tk``."""
    rows = staged(lined(docs).dropDuplicates(["doc_id", "tk"]), "lined")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            keys, ids, tks = [], [], []
            for doc, tk, lines, sizes in zip(*(b.column(c).to_pylist() for c in ("doc_id", "tk", "lines", "sizes"))):
                found = windows(lines, sizes, min_words)
                keys += found
                ids += [doc] * len(found)
                tks += [tk] * len(found)
            yield {"key": keys, "doc_id": ids, "tk": tks}

    held = staged(map_batches(rows.select("doc_id", "tk", "lines", "sizes"), "key long, doc_id long, tk long", work), "windows")
    first = held.groupBy("key").agg(F.min(F.struct("doc_id", "tk")).alias("f"), F.count("*").alias("n")).where("n > 1")
    first = first.select("key", F.col("f.doc_id").alias("f_id"), F.col("f.tk").alias("f_tk"))
    pairs = held.join(first, "key").where("doc_id > f_id").select("doc_id", "tk", "f_id", "f_tk").distinct()
    earlier = rows.select(F.col("doc_id").alias("f_id"), F.col("tk").alias("f_tk"), F.col("lines").alias("f_lines"))
    both = pairs.join(rows, ["doc_id", "tk"]).join(earlier, ["f_id", "f_tk"]).select("doc_id", "tk", "lines", "sizes", "places", "f_lines")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            cuts = []
            for lines, sizes, places, other in zip(*(b.column(c).to_pylist() for c in ("lines", "sizes", "places", "f_lines"))):
                cuts.append([places[i] for i in common_lines(lines, other, sizes, min_words)])
            yield {"doc_id": b.column("doc_id"), "tk": b.column("tk"), "cut": cuts}

    cuts = map_batches(both, "doc_id long, tk long, cut array<int>", align)
    return cuts.groupBy("doc_id", "tk").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("cut")))).alias("cut"))


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with new texts, plus ``__cut``: how many lines were deleted.

    Lines are compared without white space at their ends; blank lines are kept and take no part.
    Later means the larger doc_id. Rows with a null doc_id, a null or an empty text stay as they
    are; rows that repeat a document are all cut alike. Other columns are kept.
    """
    cuts = staged(line_cuts(docs, min_words), "cuts").where(F.size("cut") > 0)
    cuts = cuts.select(F.col("doc_id").alias("__id"), F.col("tk").alias("__tk"), F.col("cut").alias("__lines"))
    on = (F.col("doc_id").cast("long") == F.col("__id")) & (F.xxhash64("text") == F.col("__tk"))
    # texts and cuts meet by a shuffle at every size: with small cuts sent to all tasks instead, small
    # inputs would move no texts and larger ones all of them, and nothing measured small would tell
    rows = docs.join(cuts.hint("merge"), on, "left").drop("__id", "__tk")
    kept = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains(F.col("__lines"), i))
    text = F.when(F.col("__lines").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return rows.withColumn("text", text).withColumn("__cut", F.coalesce(F.size("__lines"), F.lit(0))).withColumn("__cut", F.greatest("__cut", F.lit(0))).drop("__lines")
