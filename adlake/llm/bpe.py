"""Byte-pair merges over many pre-tokens at once.

Pre-tokens lie one after the other in flat arrays (ragged rows). A round finds the lowest rank of
each row with one segmented minimum and merges every place where it occurs, in all rows at the
same time; rows without a mergeable pair leave the arrays. As a merged symbol only takes part in
pairs of higher rank, this gives the same symbols as merging one pair after the other.
"""

from __future__ import annotations

import json

import numpy as np

from adlake.llm.common import ragged

NONE = np.int32(2**31 - 1)
#: Pre-tokens merged together: their arrays stay in a core's cache.
BLOCK = 1 << 13


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: printable bytes for themselves, the others from code point 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class PairTable:
    """Open-addressing lookup from a pair of symbols to its rank."""

    BITS = 19

    def __init__(self, left: np.ndarray, right: np.ndarray):
        self.keys = np.full(1 << self.BITS, -1, np.int64)
        self.ranks = np.full(1 << self.BITS, NONE, np.int32)
        keys = (left.astype(np.int64) << 32) | right
        rank, slot = np.arange(len(keys), dtype=np.int32), self.slot(keys)
        while len(keys):
            free = self.keys[slot] < 0
            first = np.zeros(len(keys), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = free & first
            self.keys[slot[put]], self.ranks[slot[put]] = keys[put], rank[put]
            keys, rank, slot = keys[~put], rank[~put], (slot[~put] + 1) & ((1 << self.BITS) - 1)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right
        slot = self.slot(keys)
        out, found = self.ranks[slot], self.keys[slot]
        out[found != keys] = NONE
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.BITS) - 1)
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out


class Merger:
    """Merges of a tokenizer file of byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int32)
        right = np.array([vocab[b] for _, b in pairs], np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.table = PairTable(left, right)
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int32)
        self.last = np.array([vocab[x + suffix] for x in letters], np.int32)

    def __call__(self, pretokens: list[bytes], symbols: bool = False, block: int = BLOCK):
        """Symbols per pre-token; with ``symbols`` also all symbols in order, flat."""
        counts, flat = [], []
        for at in range(0, len(pretokens), block):
            part = pretokens[at : at + block]
            lengths = np.fromiter(map(len, part), np.int64, len(part))
            n, ids = self.rows(np.frombuffer(b"".join(part), np.uint8), lengths, symbols)
            counts.append(n)
            flat.append(ids)
        empty = np.zeros(0, np.int32)
        return (np.concatenate(counts) if counts else empty.astype(np.int64)), (np.concatenate(flat) if symbols and flat else empty)

    def rows(self, data: np.ndarray, lengths: np.ndarray, symbols: bool):
        """All rows of one block, each of at least one byte unless its length is 0."""
        count = np.zeros(len(lengths), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        sym = self.inner[data]
        row = np.flatnonzero(lengths)  # rows still in work
        size = lengths[row]
        ends = np.cumsum(size)
        sym[ends - 1] = self.last[data[ends - 1]]
        rank = np.full(len(sym), NONE, np.int32)
        rank[:-1] = self.table(sym[:-1], sym[1:])
        rank[ends - 1] = NONE
        while len(row):
            starts = np.cumsum(size) - size
            best = np.minimum.reduceat(rank, starts)
            going = best != NONE
            if not going.all():
                stay = np.repeat(going, size)
                count[row[~going]] = size[~going]
                if symbols:
                    done.append((row[~going], sym[~stay]))
                row, size, best, sym, rank = row[going], size[going], best[going], sym[stay], rank[stay]
                if not len(row):
                    break
            hit = rank == np.repeat(best, size)
            twice = hit[1:] & hit[:-1]
            if twice.any():  # runs of one symbol: every second place, from the left
                at = np.flatnonzero(hit)
                head = np.concatenate([[True], np.diff(at) > 1])
                first = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
                hit[at[(np.arange(len(at)) - first) % 2 == 1]] = False
            place = np.flatnonzero(hit)
            sym[place] = self.merged[rank[place]]
            keep = np.ones(len(sym), bool)
            keep[place + 1] = False
            before = np.cumsum(size)
            size = size - np.add.reduceat(hit, before - size)
            new = place - np.arange(len(place))  # each merge before has taken one symbol away
            rank[place] = rank[place + 1]
            sym, rank = sym[keep], rank[keep]
            last = np.zeros(len(sym), bool)
            last[np.cumsum(size) - 1] = True
            near = np.concatenate([new, new[new > 0] - 1])
            near = near[~last[near]]
            rank[near] = self.table(sym[near], sym[near + 1])
            rank[last] = NONE
        if not symbols:
            return count, sym[:0]
        rows = np.concatenate([r for r, _ in done]) if done else np.zeros(0, np.int64)
        flat = np.concatenate([s for _, s in done]) if done else np.zeros(0, np.int32)
        order = np.argsort(rows, kind="stable")
        sizes = count[rows]
        starts = np.cumsum(sizes) - sizes
        return count, flat[ragged(starts[order], sizes[order])]
