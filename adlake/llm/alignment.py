"""Cross-tokenizer alignment through inverted pair bitmaps.

Each text is encoded by two tokenizers: A (a byte-level BPE, on a space and the text) and B (a
sentencepiece BPE, which adds the space itself). Byte offsets where tokens of both end cut the two
sequences into aligned groups; each A and B token occurrence ending at one such offset is a link. Per
pair of ids, the documents holding it are a compressed bitmap (Spark's bitmap aggregates: 32,768-bit
buckets, built per task and OR-merged across them); a pair's link count is kept as bit planes of the
multiplicity (plane p holds the documents where bit p of the pair's count in the document is set), so
``links = Σ_p 2^p · popcount(plane p)`` and ``documents = popcount(OR of the planes)``. The postings
(document, pair, multiplicity) then return each pair's count and whether it is its B id's best.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.bpe import byte_letters
from adlake.llm.common import map_batches, ragged, staged

#: Pairs sent whole to every task at most; a larger table is joined by a shuffle.
BROADCAST_PAIRS = 500_000
DOCS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, link_a array<int>, link_b array<int>, link_m array<int>"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Aligner:
    """Both tokenizers, and the bytes of every token id of each."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        from adlake.llm.best_fit import Encoder

        library = Tokenizer.from_file(path_a)
        # A's ids: the library's, by pieces remembered per task and merged by rank; special strings as plain text
        self.encode_a = Encoder(path_a, special=False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = {c: i for i, c in enumerate(byte_letters())}
        token = [library.id_to_token(i) or "" for i in range(library.get_vocab_size())]
        self.bytes_a = [bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in token]
        self.bytes_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b.get_piece_size())]
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.flat_a, self.start_a = np.frombuffer(b"".join(self.bytes_a), np.uint8), np.cumsum(self.size_a) - self.size_a
        self.flat_b, self.start_b = np.frombuffer(b"".join(self.bytes_b), np.uint8), np.cumsum(self.size_b) - self.size_b
        # decimal ids with the separator that follows them: within a group, after its last A id, after its last B id
        self.name_a = {sep: np.array([f"{i}{sep}".encode() for i in range(len(self.bytes_a))], object) for sep in (",", "|")}
        self.name_b = {sep: np.array([f"{i}{sep}".encode() for i in range(len(self.bytes_b))], object) for sep in (",", ";", "")}

    def __call__(self, texts: list[str]) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, groups_sha256, link_a, link_b, link_m) per text; see ``align``."""
        live = [i for i, t in enumerate(texts) if t]
        ids_a = [np.frombuffer(x, "<u4").astype(np.int64) for x in self.encode_a.with_space([texts[i] for i in live])] if live else []
        ids_b = self.b.encode([texts[i] for i in live]) if live else []
        out = [NONE] * len(texts)
        for i, a, b in zip(live, ids_a, ids_b):
            out[i] = self.align(texts[i], a, np.asarray(b, np.int64))
        return out

    def align(self, text: str, a: np.ndarray, b: np.ndarray) -> tuple:
        whole = np.frombuffer((" " + text).encode(), np.uint8)
        for ids, flat, start, size in ((a, self.flat_a, self.start_a, self.size_a), (b, self.flat_b, self.start_b, self.size_b)):
            n = size[ids]
            if n.sum() != len(whole) or not np.array_equal(flat[ragged(start[ids], n)], whole):
                return NONE
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        # both ends are strictly increasing (no token is empty): common ends by a sorted search
        at = np.minimum(np.searchsorted(end_b, end_a), len(end_b) - 1)
        shared = end_b[at] == end_a
        cuts = end_a[shared]
        last_a, last_b = np.flatnonzero(shared) + 1, at[shared] + 1
        words_a = self.name_a[","][a]
        words_a[last_a - 1] = self.name_a["|"][a[last_a - 1]]
        words_b = self.name_b[","][b]
        words_b[last_b - 1] = self.name_b[";"][b[last_b - 1]]
        words_b[-1] = self.name_b[""][b[-1]]
        group_a = np.searchsorted(last_a, np.arange(len(a)), "right")
        group_b = np.searchsorted(last_b, np.arange(len(b)), "right")
        order = np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")
        digest = hashlib.sha256(b"".join(np.concatenate([words_a, words_b])[order])).hexdigest()
        # a link: the A and the B token that end at one cut
        keys, counts = np.unique(a[last_a - 1] << 32 | b[last_b - 1], return_counts=True)
        return (len(a), len(b), len(cuts), len(cuts), digest, (keys >> 32).tolist(), (keys & 0xFFFFFFFF).tolist(), counts.tolist())


NONE = (0, 0, 0, 0, "", [], [], [])


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of ``docs``: its row number, doc_id, the counts of one text and its links (pairs of ids with their multiplicity)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        align = None
        for b in batches:
            align = align or Aligner(path_a, path_b)
            got = align(b.column("text").to_pylist())
            names = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "link_a", "link_b", "link_m")
            yield {"row": b.column("row"), "doc_id": b.column("doc_id"), **{k: [g[i] for g in got] for i, k in enumerate(names)}}

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return map_batches(rows, DOCS, work)


def pair_counts(postings: DataFrame) -> DataFrame:
    """Per id pair: a, b, documents and links, from bitmaps per multiplicity plane OR-merged over tasks."""
    planes = F.expr("filter(sequence(0, 30), p -> (shiftright(m, p) & 1) = 1)")
    place = F.col("row") + 1
    bits = postings.select("a", "b", F.explode(planes).alias("plane"), F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
    maps = bits.groupBy("a", "b", "plane", "bucket").agg(F.bitmap_construct_agg("bit").alias("docs"))
    per_bucket = maps.groupBy("a", "b", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("docs")).alias("docs"), F.sum(F.expr("shiftleft(bitmap_count(docs), plane)")).alias("links")
    )
    return per_bucket.groupBy("a", "b").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))


def alignment(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A text that is null or empty, or whose A or B token bytes do not join to a space and the text
    (sentencepiece normalising it, an unknown piece), has no tokens: zeros and ``''``. Texts are
    encoded whole, at any length; special-token strings inside a text are plain text. Repeated rows
    and rows with a null doc_id are documents of their own, and their links count; other columns are
    not read. A pair's count is its links over all rows; ``n_best`` counts a row's links whose pair
    count is the highest of its B id (ties all count). An empty table gives no rows.
    """
    rows = staged(aligned(docs.select("doc_id", "text"), path_a, path_b), "aligned")
    links = F.arrays_zip(F.col("link_a").alias("a"), F.col("link_b").alias("b"), F.col("link_m").alias("m"))
    postings = rows.select("row", F.explode(links).alias("l")).select("row", "l.a", "l.b", "l.m")
    pairs = staged(pair_counts(postings), "pairs")
    best = pairs.groupBy("b").agg(F.max("links").alias("top"))
    scored = pairs.join(best, "b").select("a", "b", "links", (F.col("links") == F.col("top")).alias("is_best"))
    if scored.count() <= BROADCAST_PAIRS:
        scored = F.broadcast(scored)
    per_row = postings.join(scored, ["a", "b"]).groupBy("row").agg(
        F.sum(F.when(F.col("is_best"), F.col("m")).otherwise(0)).alias("n_best"), F.sum(F.col("m") * F.col("links")).alias("count_sum")
    )
    out = rows.drop("link_a", "link_b", "link_m").join(per_row, "row", "left")
    return out.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"), F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256",
    )
