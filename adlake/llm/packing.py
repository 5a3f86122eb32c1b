"""Lexical retrieval packing: windows filled with a seed document and its BM25 neighbours.

Documents are dealt by hash into shards of about ``SHARD_DOCS``. Each shard has an inverted index
over its documents' token ids; the document frequencies come from all documents. A seed's unused
neighbours fill its window in order of their score: whole ones first, then one cut to fit. What is
left of a shard is cut into sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cached_property
from itertools import chain, pairwise
from math import ceil
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.bpe import BLOCK, Merger
from adlake.llm.common import map_batches, ragged, staged
from adlake.llm.pretokens import HARD, KEY_BYTES, WordTable, grown, pretokens, word_keys

WINDOW = 2048
SHARD_DOCS = 512
#: Bytes of token ids (and their pieces) one task remembers at most.
REMEMBERED_BYTES = 64_000_000
#: Characters of the texts one task cuts into pre-tokens at a time; only a longer run without white space is a group of its own.
GROUP_CHARS = 1 << 19
#: Pieces handed to the tokenizer library at a time.
LIBRARY_PIECES = 2048
WHITE = re.compile("[ \t\n\r]")
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Encoder:
    """Token ids of texts; the text between two places of white space is a piece, and white space gives no ids.

    The pre-tokens of many texts are found together, in arrays of bytes. Those of up to ``KEY_BYTES``
    bytes are looked up in an array table, longer ones in a dict; only new ones are merged, together,
    by the rank-synchronous merger (``bpe.Merger``), which gives the library's ids. Pieces with
    characters whose normal form or lower case is in doubt go to the library whole, some thousand at
    a time, as what it returns for a piece is hundreds of times the piece. What is remembered is
    dropped once it takes more than ``remembered`` bytes; texts are encoded in groups of about
    ``group`` characters, cut at white space, so memory depends on neither.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED_BYTES, group: int = GROUP_CHARS):
        self.path, self.merger = path, Merger(path)
        self.remembered, self.group = remembered, group
        self.forget()

    @cached_property
    def library(self):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def forget(self) -> None:
        self.words = WordTable()
        self.known: dict[bytes, int] = {}  # entries of longer pre-tokens and of the library's pieces
        self.known_size, self.used = 0, 0
        self.ids = np.zeros(1 << 12, np.uint32)
        self.first, self.count = np.zeros(1 << 10, np.int64), np.zeros(1 << 10, np.int64)

    def size(self) -> int:
        return self.words.nbytes() + self.known_size + self.ids.nbytes + self.first.nbytes + self.count.nbytes

    def store(self, entries: np.ndarray, counts: np.ndarray, flat: np.ndarray) -> None:
        """The ids of new entries, one after the other in ``flat``."""
        if not len(entries):
            return
        top = int(entries[-1]) + 1
        self.first, self.count = grown(self.first, top), grown(self.count, top)
        self.ids = grown(self.ids, self.used + len(flat))
        self.first[entries], self.count[entries] = self.used + np.cumsum(counts) - counts, counts
        self.ids[self.used : self.used + len(flat)] = flat
        self.used += len(flat)

    def merge(self, entries: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> None:
        """Stores the ids of new pre-tokens that lie one after the other in ``data``."""
        ends = np.cumsum(sizes)
        for at in range(0, len(sizes), BLOCK):
            part = sizes[at : at + BLOCK]
            lo, hi = int(ends[at] - sizes[at]), int(ends[at + len(part) - 1])
            self.store(entries[at : at + BLOCK], *self.merger.rows(data[lo:hi], part, True))

    def ask(self, entries: np.ndarray, pieces: list[bytes]) -> None:
        """Stores the library's ids of new pieces."""
        for at in range(0, len(pieces), LIBRARY_PIECES):
            got = self.library.encode_batch_fast([p.decode() for p in pieces[at : at + LIBRARY_PIECES]], add_special_tokens=False)
            ids = [e.ids for e in got]
            self.store(entries[at : at + LIBRARY_PIECES], np.fromiter(map(len, ids), np.int64, len(ids)), np.fromiter(chain.from_iterable(ids), np.uint32))

    def short(self, low: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The entries of pre-tokens that the table can hold."""
        keys = word_keys(low, start, size)
        out = self.words.find(keys)
        new = np.flatnonzero(out == 0)
        order = new[np.lexsort([k[new] for k in keys])]
        head = np.ones(len(order), bool)
        head[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in keys])
        one = order[head]
        entries = self.words.add([k[one] for k in keys])
        self.merge(entries, low[ragged(start[one], size[one])], size[one])
        out[order] = entries[np.cumsum(head) - 1]
        return out

    def other(self, data: bytes, start: np.ndarray, size: np.ndarray, whole: bool) -> list[int]:
        """The entries of longer pre-tokens or, if ``whole``, of pieces for the library."""
        keys = [data[a : a + n] for a, n in zip(start.tolist(), size.tolist())]
        new = [k for k in dict.fromkeys(keys) if k not in self.known]
        entries = self.words.reserve(len(new))
        self.known.update(zip(new, entries.tolist()))
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        self.known_size += int(sizes.sum()) + 150 * len(new)
        if whole:
            self.ask(entries, new)
        else:
            self.merge(entries, np.frombuffer(b"".join(new), np.uint8), sizes)
        return [self.known[k] for k in keys]

    def cut(self, texts: list[str]) -> Iterator[tuple[int, str]]:
        """The texts with their numbers; one longer than a group in several parts that end at white space."""
        for n, t in enumerate(texts):
            at = 0
            while len(t) - at > self.group:
                gap = WHITE.search(t, at + self.group)
                if gap is None:
                    break
                yield n, t[at : gap.end()]
                at = gap.end()
            yield n, t[at:] if at else t

    def parts(self, texts: list[str]) -> list[bytes]:
        """Each text's ids, of texts encoded together."""
        if self.size() > self.remembered:
            self.forget()
        raw = list(map(str.encode, texts))
        data = b"\n".join([*raw, b"\n" * (KEY_BYTES + 1)])
        low, start, size, kind = pretokens(data)
        entry = np.zeros(len(start), np.int64)
        at = np.flatnonzero((size <= KEY_BYTES) & (kind != HARD))
        entry[at] = self.short(low, start[at], size[at])
        # the library gets a piece as it was, as special tokens are found before the text is lower-cased
        for at, source in ((np.flatnonzero((size > KEY_BYTES) & (kind != HARD)), low.tobytes()), (np.flatnonzero(kind == HARD), data)):
            entry[at] = self.other(source, start[at], size[at], source is data)
        counts = self.count[entry]
        flat = self.ids[ragged(self.first[entry], counts)].astype("<u4", copy=False).tobytes()
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
        places = 4 * np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(start, np.concatenate([[0], ends]))]
        return [flat[lo:hi] for lo, hi in pairwise(places.tolist())]

    def __call__(self, texts: list[str], end: int) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers, the end id last."""
        out: list[list[bytes]] = [[] for _ in texts]

        def flush() -> None:
            for n, ids in zip(numbers, self.parts(group)):
                out[n].append(ids)

        numbers: list[int] = []
        group: list[str] = []
        chars = 0
        for n, t in self.cut(texts):
            if group and chars + len(t) > self.group:
                flush()
                numbers, group, chars = [], [], 0
            numbers.append(n)
            group.append(t)
            chars += len(t)
        if group:
            flush()
        tail = np.array([end], "<u4").tobytes()
        return [b"".join([*parts, tail]) for parts in out]


def encoded(docs: DataFrame, path: str, end: int) -> DataFrame:
    """(row, doc_id, ids): ids as little-endian unsigned 32-bit numbers, the end id last."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encode = None
        for b in batches:
            encode = encode or Encoder(path)
            ids = encode(b.column("text").to_pylist(), end)
            yield {"row": b.column("row"), "doc_id": b.column("doc_id"), "ids": ids}

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_batches(rows, "row long, doc_id long, ids binary", work)


def frequencies(rows: DataFrame) -> np.ndarray:
    """In how many documents each id occurs, counted per batch and summed by Spark; bounded by the vocabulary."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            seen = [np.unique(np.frombuffer(x, "<u4")) for x in b.column("ids").to_pylist()]
            if seen:
                ids, n = np.unique(np.concatenate(seen), return_counts=True)
                yield {"id": ids.astype(np.int64), "n": n.astype(np.int64)}

    got = map_batches(rows.select("ids"), "id long, n long", work).groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids, n = got.column("id").to_numpy(), got.column("n").to_numpy()
    out = np.zeros(int(ids.max(initial=0)) + 1, np.int64)
    out[ids] = n
    return out


class Index:
    """BM25 inverted index of one shard."""

    def __init__(self, tails: list[np.ndarray], df: np.ndarray, docs: int, average: float, k1: float = 1.2, b: float = 0.75):
        sizes = np.array([len(t) for t in tails])
        key = np.repeat(np.arange(len(tails), dtype=np.int64), sizes) << 32 | np.concatenate(tails).astype(np.int64)
        key, tf = np.unique(key, return_counts=True)
        self.doc, term = key >> 32, key & 0xFFFFFFFF
        self.n = len(tails)
        self.edges = np.searchsorted(self.doc, np.arange(self.n + 1))
        idf = np.log1p((docs - df[term] + 0.5) / (df[term] + 0.5))
        weight = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * sizes[self.doc] / average))
        order = np.argsort(term, kind="stable")
        terms, first, count = np.unique(term[order], return_index=True, return_counts=True)
        self.place = np.searchsorted(terms, term)
        self.first, self.count = first, count
        self.post_doc, self.post_weight = self.doc[order], weight[order]

    def scores(self, seed: int) -> np.ndarray:
        mine = self.place[self.edges[seed] : self.edges[seed + 1]]
        at = ragged(self.first[mine], self.count[mine])
        return np.bincount(self.post_doc[at], weights=self.post_weight[at], minlength=self.n)


def fill(sizes: list[int], index: Index | None, window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) that hold every id once. ``index`` has the tails after the full windows."""
    out = [[(d, s, window)] for d, n in enumerate(sizes) for s in range(0, n - window + 1, window)]
    start = np.array([n - n % window for n in sizes])
    left = np.array([n % window for n in sizes])
    last: list[tuple[int, int, int]] = []
    for seed in np.lexsort((np.arange(len(sizes)), -left)):
        if not left[seed]:
            continue
        if left.sum() < window:
            last = [(int(d), int(start[d]), int(left[d])) for d in np.flatnonzero(left)]
            break
        now, room = [(int(seed), int(start[seed]), int(left[seed]))], window - int(left[seed])
        left[seed] = 0
        score = index.scores(seed)
        near = np.lexsort((np.arange(len(score)), -score))
        near = near[left[near] > 0]
        for d in near[left[near] <= room]:
            if left[d] <= room:
                now.append((int(d), int(start[d]), int(left[d])))
                room -= int(left[d])
                left[d] = 0
        for d in near:
            if room and left[d]:
                take = min(room, int(left[d]))
                now.append((int(d), int(start[d]), take))
                start[d] += take
                left[d] -= take
                room -= take
        out.append(now)
    size = window
    total = sum(n for _, _, n in last)
    while last:
        while size > total:
            size //= 2
        now, room = [], size
        while room:
            d, s, n = last[0]
            take = min(room, n)
            now.append((d, s, take))
            room -= take
            last = [(d, s + take, n - take), *last[1:]] if take < n else last[1:]
        out.append(now)
        total -= size
    return out


def packed(docs: DataFrame, path: str, window: int = WINDOW, end: int = 1, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null text counts as empty: the document is its end id alone. Repeated rows and null doc_ids are
    packed as rows of their own; texts of any length are packed whole; other columns are not read.
    An empty table gives no rows.
    """
    rows = staged(encoded(docs, path, end), "encoded")
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("ids")), F.lit(0))).first()
    df = frequencies(rows)
    average = max(1.0, total / 4 / max(1, n))
    shards = max(1, ceil(n / shard_docs))

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by("row")
        ids = [np.frombuffer(x, "<u4") for x in t.column("ids").to_pylist()]
        names = t.column("doc_id").to_pylist()
        shard = t.column("shard")[0].as_py()
        tails = [x[len(x) - len(x) % window :] for x in ids]
        index = Index(tails, df, n, average) if any(map(len, tails)) else None
        out: dict = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
        for s, pieces in enumerate(fill([len(x) for x in ids], index, window)):
            at = 0
            for d, start, size in pieces:
                row = (names[d], start, size, crc32(ids[d][start : start + size].tobytes()), len(ids[d]), shard << 32 | s, at)
                for k, v in zip(out, row):
                    out[k].append(v)
                at += size
        return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})

    return rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards))).groupBy("shard").applyInArrow(pack, PIECE)
