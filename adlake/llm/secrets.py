"""Secret scans: fixed patterns, and values in a credential context judged by their guess cost.

The guess cost of a value is the least sum, over all its segmentations, of the costs (log10 of the
guesses) of dictionary words, dates, repeats, keyboard walks and brute-force spans. A value that
costs at least ``min_cost`` is reported as kind ``guess``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from math import log10

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import map_batches

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
CONTEXT = re.compile(r"""(pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|(?:access|private|auth)[_-]?key|credentials?)["']?[ \t]{0,8}(?:[:=]|\bis\b)[ \t]{0,8}["']?([!-~]{6,200})""", re.I | re.A)
HINTS = ("pass", "pwd", "secret", "token", "api", "key", "credential")
#: Common parts of guessable values, in the order of their frequency.
WORDS = """password secret token admin welcome login letmein monkey dragon master hello freedom whatever qwerty user test guest root default
change changeme example sample dummy none null true false key value string your here placeholder summer winter spring autumn love sunshine
princess football baseball shadow access public private server system demo temp the and for with""".split()
RANKS = {w: i + 1 for i, w in enumerate(WORDS)}
LEET = str.maketrans("@4301!$57", "aaeoiisst")
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
NEXT = {(a, b) for row in ROWS for a, b in [*zip(row, row[1:]), *zip(row[1:], row)]}
DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d")


def brute(c: str) -> float:
    return 1.0 if c.isdigit() else 1.415 if c.islower() or c.isupper() else 1.52


@lru_cache(100_000)
def guess_cost(value: str) -> float:
    """log10 of the guesses for a value, by dynamic programming over its prefixes; 0 for an empty one."""
    n, plain = len(value), value.lower().translate(LEET)
    lower = value.lower()
    cost = [0.0] + [float("inf")] * n
    walk, run = 1, 1
    for end in range(1, n + 1):
        best = cost[end - 1] + brute(value[end - 1])
        walk = walk + 1 if end > 1 and (lower[end - 2], lower[end - 1]) in NEXT else 1
        run = run + 1 if end > 1 and value[end - 2] == value[end - 1] else 1
        for size in range(3, walk + 1):
            best = min(best, cost[end - size] + log10(47 * 2 * size) + 0.3)
        for size in range(3, run + 1):
            best = min(best, cost[end - size] + brute(value[end - 1]) + log10(size))
        for size in range(3, min(12, end) + 1):
            rank = RANKS.get(plain[end - size : end])
            if rank:
                cased = 0.3 if lower[end - size : end] == value[end - size : end] else 0.9
                best = min(best, cost[end - size] + log10(rank + 1) + cased)
        for period in range(2, min(8, end // 2) + 1):  # a block repeated
            if value[end - period : end] == value[end - 2 * period : end - period]:
                best = min(best, cost[end - period] + 0.6)
        for size in (4, 6, 7, 8, 10):
            if size <= end and DATE.fullmatch(value, end - size, end):
                best = min(best, cost[end - size] + log10(366 * 60) - (2.5 if size == 4 else 0))
        cost[end] = best
    return cost[n]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns."""
    found = []
    low = text.lower()
    if any(x in low for x in ("passw", "secret", "token", "api")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def guess_spans(text: str, min_cost: float) -> list[tuple[int, int, int]]:
    low = text.lower()
    if not any(x in low for x in HINTS):
        return []
    found = []
    for m in CONTEXT.finditer(text):
        value = m.group(2).rstrip("\"'.,;:)]}>")
        if len(value) >= 6 and guess_cost(value) >= min_cost:
            found.append((m.start(2), 3, m.start(2) + len(value)))
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def secrets(docs: DataFrame, min_cost: float = 10.0) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_guess.

    Spans are code points with an exclusive end. Null text counts as empty: no spans, the hash of an
    empty string. Every row gets an answer, also repeated rows and rows with a null doc_id.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            out: dict = {k: [] for k in ("n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans")}
            for t in b.column("text").to_pylist():
                base = base_spans(t)
                more = guess_spans(t, min_cost)
                for k, name in enumerate(("n_assign", "n_access", "n_hex", "n_guess")):
                    out[name].append(sum(x[1] == k for x in base + more))
                out["base_sha256"].append(sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(base + more))
            yield {"doc_id": b.column("doc_id"), **out}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_batches(rows, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long", work)
