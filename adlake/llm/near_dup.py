"""Near-duplicate documents by DartMinHash.

Every element of a weighted set throws darts into a plane of weight and rank. Where the darts fall
depends on the element alone, so equal elements throw equal darts; a set sees the darts under its
weights. Each dart belongs to one coordinate, and the signature keeps the earliest dart per
coordinate. Ranks are gone through in regions of growing size until all coordinates are filled, so
a large set needs few darts per element. Signatures are cut into bands and joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.common import map_batches, shingles, staged, words

COORDINATES, BAND = 180, 6
FIRST_REGION = 2.0**-5
#: Elements hashed at a time, and pairs of one pivot that share a task.
BLOCK, PIVOT_PAIRS = 300_000, 500
#: Texts of a bucket that its others are checked against before the exact search for the rest.
PIVOTS = 3


def mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


@lru_cache(None)
def poisson_cdf(mean: float) -> np.ndarray:
    n = int(mean + 12 * mean**0.5 + 20)
    return np.cumsum([exp(i * log(mean) - mean - lgamma(i + 1)) for i in range(n)])


def darts(elements: np.ndarray, weights: np.ndarray, region: int, layer: int, lo: float, hi: float, floor: float, top: float):
    """(element place, rank, code) of the darts in one region of ranks and one layer of weights."""
    at = np.flatnonzero(weights > floor)
    h = mix(elements[at], 1 + region * 64 + layer)
    n = np.searchsorted(poisson_cdf((hi - lo) * (top - floor)), uniform(mix(h, 5)), side="right")
    which = np.repeat(np.arange(len(at)), n)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    code = mix(h[which] + nth.astype(np.uint64) * np.uint64(0xD1342543DE82EF95), 7)
    under = floor + (top - floor) * uniform(mix(code, 11)) < weights[at[which]]
    which, code = which[under], code[under]
    return at[which], lo + (hi - lo) * uniform(mix(code, 13)), code


def signatures(elements: np.ndarray, weights: np.ndarray, sizes: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    """One row of ``k`` codes per set; ``elements`` holds the sets one after the other. Empty sets get zeros."""
    out = np.zeros(len(sizes) * k, np.uint64)
    filled = np.zeros(len(sizes) * k, bool)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    region, lo, hi = 0, 0.0, FIRST_REGION
    while len(owner):
        layer, floor, top = 0, 0.0, 1.0
        while floor < weights.max():
            place, rank, code = darts(elements, weights, region, layer, lo, hi, floor, top)
            if layer == 0:
                seen = [(place, rank, code)]
            else:
                seen.append((place, rank, code))
            layer, floor, top = layer + 1, top, top * 2
        place, rank, code = (np.concatenate(x) for x in zip(*seen))
        slot = owner[place] * k + (mix(code, 17) % np.uint64(k)).astype(np.int64)
        new = ~filled[slot]
        slot, rank, code = slot[new], rank[new], code[new]
        order = np.lexsort((code, rank, slot))
        slot, code = slot[order], code[order]
        first = np.ones(len(slot), bool)
        first[1:] = slot[1:] != slot[:-1]
        out[slot[first]], filled[slot[first]] = code[first], True
        going = ~filled.reshape(-1, k).all(1)[owner]
        elements, weights, owner = elements[going], weights[going], owner[going]
        region, lo, hi = region + 1, hi, hi * 2
    return out.reshape(-1, k)


def signed(docs: DataFrame, k: int = COORDINATES, band: int = BAND) -> DataFrame:
    """(doc_id, key, bands): a hash of all words, and the hashes of the bands. Documents without words or id are left out."""
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text")).alias("__w")).where(F.size("__w") > 0)
    rows = rows.select("doc_id", F.md5(F.array_join("__w", " ").cast("binary")).alias("key"), shingles(F.col("__w")).alias("sh"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            col = b.column("sh")
            sizes = np.diff(col.offsets.to_numpy())
            flat = col.flatten().to_numpy().view(np.uint64)
            ends, bands, at = np.cumsum(sizes), [], 0
            while at < len(sizes):
                begin = ends[at] - sizes[at]
                to = max(at + 1, int(np.searchsorted(ends, begin + BLOCK, side="right")))
                part = flat[begin : ends[to - 1]]
                sig = signatures(part, np.ones(len(part)), sizes[at:to], k).reshape(to - at, k // band, band)
                h = np.zeros(sig.shape[:2], np.uint64)
                for i in range(band):
                    h = mix(h ^ sig[:, :, i], 19)
                bands.append((h + np.arange(h.shape[1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64))
                at = to
            if bands:
                yield {"doc_id": b.column("doc_id"), "key": b.column("key"), "bands": list(np.concatenate(bands))}

    return map_batches(rows, "doc_id long, key string, bands array<long>", work)


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets have at least that Jaccard similarity.

    A pivot ``a`` with very many pairs is dealt over several tasks.
    """
    hot = pairs.groupBy("a").agg(F.ceil(F.count("*") / PIVOT_PAIRS).cast("int").alias("parts"))
    left = hot.join(texts.select(F.col("id").alias("a"), F.col("sh").alias("sa")), "a")
    left = left.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    right = pairs.join(hot, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    right = right.select("a", "b", "salt").join(texts.select(F.col("id").alias("b"), F.col("sh").alias("sb")), "b")
    both = right.join(left.select("a", "salt", "sa"), ["a", "salt"])
    same = F.size(F.array_intersect("sa", "sb"))
    both = both.select("a", "b", same.alias("same"), (F.size("sa") + F.size("sb")).alias("total"))
    return both.where(F.col("same") >= similarity * (F.col("total") - F.col("same"))).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(id, root): the smallest id each node of the edges (a, b) is connected to.

    Labels spread along the edges and are shortened by pointer jumping; each round is a written table.
    """
    edges = staged(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = staged(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("root")), "labels")
    while True:
        near = edges.join(labels.select(F.col("id").alias("a"), F.col("root").alias("r")), "a").groupBy(F.col("b").alias("id")).agg(F.min("r").alias("r"))
        next_ = labels.join(near, "id").select("id", F.least("root", "r").alias("root"), F.col("root").alias("old"))
        jump = labels.select(F.col("id").alias("root"), F.col("root").alias("up"))
        next_ = staged(next_.join(jump, "root").select("id", F.least("root", "up").alias("root"), "old"), "labels")
        labels = next_.select("id", "root")
        if next_.where("root <> old").isEmpty():
            return labels


def placed(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """(bucket, id, root) of the buckets whose texts are in several components."""
    place = shared.select("bucket", F.col("b").alias("id")).join(roots, "id", "left").select("bucket", "id", F.coalesce("root", "id").alias("root"))
    mixed = place.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("bucket")
    return staged(place.join(mixed, "bucket"), "places")


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components (id, root) after adding the links (a, b), which are found between components."""
    if links.isEmpty():
        return roots
    at = [roots.select(F.col("id").alias(x), F.col("root").alias(f"r{x}")) for x in "ab"]
    ends = links.join(at[0], "a", "left").join(at[1], "b", "left")
    moved = components(ends.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))).select(F.col("id").alias("root"), F.col("root").alias("to"))
    every = roots.union(links.select("a", "a")).union(links.select("b", "b"))
    every = every.groupBy("id").agg(F.min("root").alias("root"))
    return staged(every.join(moved, "root", "left").select("id", F.coalesce("to", "root").alias("root")), "labels")


def pivot_pairs(place: DataFrame, pivots: int) -> DataFrame:
    """Pairs (a, b) of the bucket's texts with a few of them, chosen by hash, where the components differ."""
    chosen = place.groupBy("bucket").agg(*[F.min_by(F.struct("id", "root"), F.xxhash64("id", F.lit(i))).alias(f"p{i}") for i in range(pivots)])
    chosen = chosen.select("bucket", F.explode(F.array_distinct(F.array(*[f"p{i}" for i in range(pivots)]))).alias("p"))
    pairs = place.join(chosen, "bucket").where("root <> p.root")
    return pairs.select(F.least("id", "p.id").alias("a"), F.greatest("id", "p.id").alias("b")).distinct()


def prefix_pairs(place: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """All pairs (a, b) in different components that can have the similarity, of which one is a stray of a bucket.

    A stray is a text outside the largest component of one of its buckets; two texts of a bucket in
    different components are never both outside the strays. Shingles are ordered from rare to common. Two
    similar sets share a shingle in their first places, and with the first one they share, what follows
    in the shorter rest must still suffice.
    """
    main = place.groupBy("bucket", "root").count().groupBy("bucket").agg(F.max_by("root", F.struct("count", "root")).alias("main"))
    strays = place.join(main, "bucket").groupBy("id", "root").agg(F.max(F.col("root") != F.col("main")).alias("stray"))
    runs = strays.join(texts, "id").select("id", "root", "stray", F.size("sh").alias("n"), F.explode("sh").alias("s"))
    runs = staged(runs, "strays")
    often = runs.groupBy("s").agg(F.count("*").alias("df"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("df", "s"))
    first = runs.join(often, "s").withColumn("k", rank).where(F.col("k") <= F.col("n") - F.ceil(similarity * F.col("n") - 1e-9) + 1).where("df > 1")
    first = staged(first.select("s", "id", "root", "stray", "n", "k"), "prefixes")
    x, y = first.where("stray").alias("x"), first.alias("y")
    size = (F.col("x.n") >= similarity * F.col("y.n")) & (F.col("y.n") >= similarity * F.col("x.n"))
    most = 1 + F.least(F.col("x.n") - F.col("x.k"), F.col("y.n") - F.col("y.k"))
    enough = most >= similarity / (1 + similarity) * (F.col("x.n") + F.col("y.n")) - 1e-9
    pairs = x.join(y, (F.col("x.s") == F.col("y.s")) & (F.col("x.root") != F.col("y.root")) & size & enough)
    return pairs.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """Per document: doc_id, class_id (the smallest doc_id of its group), kept (whether it is that one).

    Groups are the connected components of the pairs whose sets of five-word shingles have at least
    that Jaccard similarity; texts with the same words are one node, the smallest doc_id. Within a
    bucket all texts are checked against the smallest one, then, where several components are left,
    against ``PIVOTS`` others. Pairs of a bucket that are then still in different components are found by
    an exact search over the rarest shingles, so none of similarity is left out. Rows with one doc_id are one document.
    Documents without words are groups of their own; rows with a null doc_id get a null class and are
    kept. An empty table gives no rows.
    """
    rows = staged(signed(docs), "signatures")
    nodes = staged(rows.groupBy("key").agg(F.min("doc_id").alias("id"), F.min_by("bands", "doc_id").alias("bands")), "nodes")
    member = nodes.select("id", F.explode("bands").alias("bucket"))
    pivots = member.groupBy("bucket").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1").select("bucket", "a")
    shared = staged(member.join(pivots, "bucket").select("bucket", "a", F.col("id").alias("b")), "buckets")
    needed = shared.select(F.col("b").alias("id")).distinct()
    # texts move, not their words, which take several times the room; by a shuffle at every size, so that a small input tells of a large one
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(needed.hint("merge"), "id").select("id", words(F.col("text")).alias("__w"))
    texts = texts.groupBy("id").agg(F.min(F.when(F.size("__w") > 0, F.col("__w"))).alias("__w")).where("__w is not null")
    texts = staged(texts.select("id", shingles(F.col("__w")).alias("sh")), "texts")
    first = staged(verified(shared.where("a < b").select("a", "b").distinct(), texts, similarity), "links")
    roots = components(first)
    place = placed(shared, roots)
    roots = merged(roots, staged(verified(pivot_pairs(place, PIVOTS), texts, similarity), "links"))
    place = placed(shared, roots)
    roots = merged(roots, staged(verified(prefix_pairs(place, texts, similarity), texts, similarity), "links"))
    same = rows.join(nodes.select("key", "id"), "key").select("doc_id", "id").join(roots, "id", "left")
    same = same.groupBy("doc_id").agg(F.min(F.coalesce("root", "id")).alias("class_id"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).groupBy("doc_id").count()
    out = ids.join(same, "doc_id", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))
