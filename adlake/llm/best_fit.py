"""Best-fit packing by minimum bin slack: each sequence takes the fullest combination of pieces that fits.

Documents become token ids and an end id. A document longer than the window is cut into window-long
pieces, the first of them shorter where the length is not a multiple of the window; shorter documents
stay whole. Pieces are dealt by hash into shards of about ``SHARD_TOKENS`` tokens. In a shard, one
sequence after another is filled: a subset-sum dynamic program over the lengths still free, held as a
bitset of reachable sums, finds the largest sum that fits the window; the pieces of that sum are
taken out, and the next sequence starts.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain
from math import ceil
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import map_batches, staged

WINDOW = 2048
#: Tokens of the pieces of one shard: bounds the rows one task holds, not what is packed.
SHARD_TOKENS = 4_000_000
#: Bytes of token ids (and their pieces) one task remembers at most.
REMEMBERED_BYTES = 64_000_000
PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cuts(n: int, window: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids: whole up to ``window``, else a short head and full pieces."""
    if n <= window:
        return [(0, n)]
    head = n % window
    return ([(0, head)] if head else []) + [(s, window) for s in range(head, n, window)]


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes, equal to the tokenizer library's, remembered per piece.

    A byte-level vocabulary cuts pre-tokens so that a single space between two characters that are
    not white space always begins one, and no pre-token runs from such a character into a space. A
    text's ids are then the ids of its pieces between such spaces, each piece encoded with its space.
    New pieces are cut into pre-tokens by the vocabulary's pattern and merged together by the
    rank-synchronous merger (``bpe.Merger``), which gives the library's ids about twice as fast on
    text of many distinct words. Texts that hold the special string go to the library whole. What is
    remembered is bounded by ``remembered`` bytes, then forgotten.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED_BYTES, special: bool = True):
        import regex

        from adlake.llm.bpe import Merger
        from adlake.llm.token_counts import PATTERN, SPECIAL, Counter

        self.path, self.library = path, None
        self.merger, self.pattern = Merger(path), regex.compile(PATTERN)
        # ``special``: the special string is one token, as the library has it by default; else plain text
        self.cut, self.special = Counter.pieces, SPECIAL if special else None
        # ``heads``: first pieces of texts, as they are; ``spaced``: later pieces p, standing for " " + p
        self.heads: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}
        self.size, self.remembered = 0, remembered

    def whole(self, text: str) -> bytes:
        if self.library is None:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, known: dict[str, bytes], pieces: list[str], space: str) -> None:
        sizes = np.ones(len(pieces), np.int64)
        tokens: list[str] = []
        for i, x in enumerate(pieces):
            if x.isalpha():  # one run of letters is one pre-token
                tokens.append(space + x)
            else:
                cut = self.pattern.findall(space + x)
                sizes[i] = len(cut)
                tokens += cut
        counts, flat = self.merger(list(map(str.encode, tokens)), symbols=True)
        ends = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(sizes)])]
        data = flat.astype("<u4").tobytes()
        for k, lo, hi in zip(pieces, ends[:-1].tolist(), ends[1:].tolist()):
            known[k] = data[4 * lo : 4 * hi]
        self.size += len(data) + sum(map(len, pieces)) + 100 * len(pieces)

    def with_space(self, texts: list[str]) -> list[bytes]:
        """The ids of a space and each text. Where the text begins with a character that is not white
        space, its first piece is a spaced piece like the others; other texts are encoded with their space."""
        if self.size > self.remembered:
            self.heads, self.spaced, self.size = {}, {}, 0
        cut = [self.cut(None, t) if t and not t[0].isspace() and not (self.special and self.special in t) else None for t in texts]
        self._learn(self.spaced, list(set(chain.from_iterable(c for c in cut if c is not None)).difference(self.spaced)), " ")
        odd = [" " + t for t, c in zip(texts, cut) if c is None]
        done = iter(self(odd)) if odd else iter(())
        return [next(done) if c is None else b"".join(map(self.spaced.__getitem__, c)) for c in cut]

    def __call__(self, texts: list[str]) -> list[bytes]:
        if self.size > self.remembered:
            self.heads, self.spaced, self.size = {}, {}, 0
        cut = [None if self.special and self.special in t else self.cut(None, t) for t in texts]
        self._learn(self.heads, list({c[0] for c in cut if c is not None}.difference(self.heads)), "")
        self._learn(self.spaced, list(set(chain.from_iterable(c[1:] for c in cut if c is not None)).difference(self.spaced)), " ")
        return [self.whole(t) if c is None else self.heads[c[0]] + b"".join(map(self.spaced.__getitem__, c[1:])) for t, c in zip(texts, cut)]


def encode_pieces(docs: DataFrame, path: str, end: int, window: int) -> DataFrame:
    """Per piece: the document's row, its doc_id, piece number, start, length, crc32 of its ids, and the document's id count."""
    tail = np.asarray([end], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encode = None
        for b in batches:
            encode = encode or Encoder(path)
            rows, names = b.column("row").to_pylist(), b.column("doc_id").to_pylist()
            out: dict = {k: [] for k in ("row", "doc_id", "piece", "start", "length", "ids_crc32", "doc_tokens")}
            for i, ids in enumerate(encode(b.column("text").to_pylist())):
                ids += tail
                n = len(ids) // 4
                for p, (s, size) in enumerate(cuts(n, window)):
                    for k, v in zip(out, (rows[i], names[i], p, s, size, crc32(ids[4 * s : 4 * (s + size)]), n)):
                        out[k].append(v)
            yield out

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_batches(rows, PIECES, work)


def fullest(count: np.ndarray, window: int) -> dict[int, int]:
    """How many pieces of each length the fullest combination of at most ``window`` takes; ``count[L]`` pieces of length L are free.

    Bounded subset sum over a bitset of reachable sums; counts are split into powers of two, so each
    length costs a few shifts. Lengths are tried longest first, and the search ends once the window is
    full, since no combination is fuller.
    """
    mask = (1 << (window + 1)) - 1
    reach, steps = 1, []
    for length in np.flatnonzero(count)[::-1]:
        length, left, k = int(length), int(count[length]), 1
        while left:
            take = min(k, left)
            left -= take
            k *= 2
            weight = length * take
            if weight > window:
                break
            steps.append((length, take, reach))
            reach = (reach | (reach << weight)) & mask
            if reach >> window & 1:
                break
        if reach >> window & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


def pack_shard(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece of one shard, by minimum bin slack.

    Equal lengths are interchangeable; pieces of one length are taken in the order given, so the
    result does not depend on anything but that order.
    """
    order = np.argsort(lengths, kind="stable")
    by_length = np.split(order, np.searchsorted(lengths[order], np.arange(1, window + 1)))
    taken = np.zeros(window + 1, np.int64)
    count = np.bincount(lengths, minlength=window + 1).astype(np.int64)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    s = 0
    while count.any():
        at = 0
        for length, take in sorted(fullest(count, window).items(), reverse=True):
            members = by_length[length][taken[length] : taken[length] + take]
            sequence[members] = s
            offset[members] = at + length * np.arange(take)
            at += length * take
            taken[length] += take
            count[length] -= take
        s += 1
    return sequence, offset


def best_fit(docs: DataFrame, path: str, window: int = WINDOW, end: int = 0, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``ids_crc32`` is the unsigned crc32 of the piece's ids as little-endian unsigned 32-bit numbers;
    ``doc_tokens`` counts the document's ids with the end id. Null text counts as empty (the end id
    alone). Repeated rows, null doc_ids and rows of equal text are packed as rows of their own; texts are
    encoded whole, at any length; other columns are not read. Ties between pieces of equal length are
    settled by their order in the shard. An empty table gives no rows.
    """
    pieces = staged(encode_pieces(docs, path, end, window), "pieces")
    total = pieces.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    shards = max(1, ceil(total / shard_tokens))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["row", "piece"], kind="stable").reset_index(drop=True)
        sequence, offset = pack_shard(frame["length"].to_numpy(np.int64), window)
        frame["sequence_id"] = (frame["shard"].to_numpy(np.int64) << 32) | sequence
        frame["offset"] = offset
        return frame[[c.split()[0] for c in PACKED.split(", ")]]

    keyed = pieces.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)))
    return keyed.groupBy("shard").applyInPandas(pack, PACKED)
