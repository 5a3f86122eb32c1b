"""Pre-tokens of many texts at once, as ranges of an array of bytes, and a table that numbers them.

The pattern is the one of the packing vocabulary: ``'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+``
on normalised, lower-cased text.
"""

from __future__ import annotations

import unicodedata

import numpy as np

from adlake.llm.common import ragged

#: Kinds of characters; the last is the highest.
SPACE, LETTER, DIGIT, OTHER, HARD = range(5)
#: Code points from here on are not judged: their pieces are the library's.
LATIN = 0x250
#: Pre-tokens of so many bytes are numbered by the table.
KEY_BYTES = 16


def characters() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower case of the code points of one or two bytes.

    HARD are those without a plain reading: control characters, odd spaces, those whose lower case is longer,
    and all from U+0250 on. The others are their own normal form.
    """
    kind, lower = np.full(0x800, HARD, np.uint8), np.arange(0x800)
    for code in range(LATIN):
        c = chr(code)
        low = c.lower()
        if c in " \t\n\r":
            kind[code] = SPACE
        elif c.isprintable() and len(low) == 1 and len(low.encode()) == len(c.encode()):
            kind[code] = {"L": LETTER, "N": DIGIT}.get(unicodedata.category(c)[0], OTHER)
            lower[code] = ord(low)
    return kind, lower


KIND, LOWER = characters()
ASCII_KIND = bytes([*KIND[:128].tolist(), *[HARD] * 128])
ASCII_LOWER = bytes([*LOWER[:128].tolist(), *range(128, 256)])


def pretokens(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, starts, sizes, kinds) of UTF-8 text that ends with three blanks or more.

    A piece between white space with a HARD character, or one that may hold a special token, is one range of kind HARD.
    """
    data = np.frombuffer(text, np.uint8)
    kind = np.frombuffer(bytearray(text).translate(ASCII_KIND), np.uint8)
    low = np.frombuffer(bytearray(text).translate(ASCII_LOWER), np.uint8)
    lead = np.flatnonzero((data >= 0xC2) & (data < 0xE0))
    code = (data[lead].astype(np.int64) & 0x1F) << 6 | data[lead + 1] & 0x3F
    kind[lead] = kind[lead + 1] = KIND[code]
    code = LOWER[code]
    low[lead], low[lead + 1] = 0xC0 | code >> 6, 0x80 | code & 0x3F
    kind[:-1][(data[:-1] == ord("<")) & (data[1:] == ord("|"))] = HARD
    if (kind == HARD).any():
        gap = np.concatenate([[0], np.flatnonzero(kind == SPACE)])
        at = np.flatnonzero(np.maximum.reduceat(kind, gap) == HARD)
        begin = gap[at] + (kind[gap[at]] == SPACE)
        kind[ragged(begin, gap[at + 1] - begin)] = HARD
    edge = np.ones(len(kind), bool)
    edge[1:] = kind[1:] != kind[:-1]
    edge |= (kind == DIGIT) & (data & 0xC0 != 0x80)
    start = np.flatnonzero(edge)
    size = np.diff(start, append=len(kind))
    kind = kind[start]
    full = kind != SPACE
    return low, *contracted(low, start[full], size[full], kind[full])


def contracted(low: np.ndarray, start: np.ndarray, size: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A lone apostrophe takes s, t, m, d, re, ve or ll from the letters after it."""
    at = np.flatnonzero((size[:-1] == 1) & (low[start[:-1]] == ord("'")) & (start[1:] == start[:-1] + 1) & (kind[:-1] == OTHER) & (kind[1:] == LETTER))
    if not len(at):
        return start, size, kind
    a, b = low[start[at] + 1], low[start[at] + 2]
    double = (np.isin(a, [*b"rv"]) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
    take = np.where(np.isin(a, [*b"stmd"]), 1, np.where(double, 2, 0))
    size[at] += take
    start[at + 1] += take
    size[at + 1] -= take
    full = size > 0
    return start[full], size[full], kind[full]


MASKS = [np.array([(1 << 8 * min(max(n - at, 0), 8)) - 1 for n in range(KEY_BYTES + 1)], np.uint64) for at in range(0, KEY_BYTES, 8)]


def word_keys(low: np.ndarray, start: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """Each range's bytes as numbers, eight bytes each, filled up with zeros, which no range holds."""
    words = np.lib.stride_tricks.sliding_window_view(low, KEY_BYTES)[start].view("<u8")
    return [words[:, i] & mask[size] for i, mask in enumerate(MASKS)]


def grown(a: np.ndarray, n: int) -> np.ndarray:
    """``a`` with room for ``n`` values at least."""
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])


class WordTable:
    """Open addressing from keys to entry numbers from 1 on; the keys are compared whole, so no two share an entry."""

    def __init__(self, bits: int = 12):
        self.entries = 1
        self.slots = np.zeros(1 << bits, np.int32)
        self.keys = [np.zeros(1 << 10, np.uint64) for _ in MASKS]

    def nbytes(self) -> int:
        return self.slots.nbytes + sum(k.nbytes for k in self.keys)

    def slot(self, keys: list[np.ndarray]) -> np.ndarray:
        x = keys[0] * np.uint64(0x9E3779B97F4A7C15)
        for k in keys[1:]:
            x = (x ^ (x >> np.uint64(32)) ^ k) * np.uint64(0xBF58476D1CE4E5B9)
        return (x >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def find(self, keys: list[np.ndarray]) -> np.ndarray:
        """The entry of each key, 0 where there is none."""
        slot = self.slot(keys)
        out = self.slots[slot].astype(np.int64)
        todo = np.flatnonzero((out > 0) & np.logical_or.reduce([own[out] != k for own, k in zip(self.keys, keys)]))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & (len(self.slots) - 1)
            got = out[todo] = self.slots[slot[todo]]
            todo = todo[(got > 0) & np.logical_or.reduce([own[got] != k[todo] for own, k in zip(self.keys, keys)])]
        return out

    def put(self, entries: np.ndarray) -> None:
        slot = self.slot([k[entries] for k in self.keys])
        while len(entries):
            free = self.slots[slot] == 0
            self.slots[slot[free]] = entries[free]
            stay = self.slots[slot] != entries
            entries, slot = entries[stay], (slot[stay] + 1) & (len(self.slots) - 1)

    def reserve(self, n: int) -> np.ndarray:
        """Entries whose keys are kept elsewhere."""
        self.entries += n
        return np.arange(self.entries - n, self.entries)

    def add(self, keys: list[np.ndarray]) -> np.ndarray:
        """New entries for keys that are neither in the table nor twice in ``keys``."""
        new = self.reserve(len(keys[0]))
        self.keys = [grown(own, self.entries) for own in self.keys]
        for own, k in zip(self.keys, keys):
            own[new] = k
        if 2 * self.entries > len(self.slots):
            self.slots = np.zeros(1 << (4 * self.entries).bit_length(), np.int32)
            self.put(np.flatnonzero(np.logical_or.reduce([own[: self.entries] != 0 for own in self.keys])))
        else:
            self.put(new)
        return new
