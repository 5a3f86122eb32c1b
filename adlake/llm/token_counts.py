"""Token counts by rank-synchronous array merging.

A text is cut into pre-tokens by the vocabulary's pattern. The distinct pre-tokens of a batch that
were not seen before are merged together in ragged numpy arrays (``bpe.Merger``), the counts are
kept for the task, and a text's count is the sum over its pre-tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.bpe import Merger
from adlake.llm.common import map_batches

#: The pattern of the byte-level vocabulary (a fixed value), with white space as Unicode defines it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: A single space between two characters that are not white space always begins a pre-token.
INNER_SPACE = regex.compile(r"(?<=\P{White_Space}) (?=\P{White_Space})")
#: Where plain splitting at spaces would not be the same: a space next to other white space.
NEAR_SPACES = ("  ", "\n ", " \n", "\t ", " \t", "\r ", " \r")
RARE_SPACE = re.compile("[\x0b\x0c\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
SPECIAL = "<|endoftext|>"
REMEMBERED = 400_000


class Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


class Counter:
    """Counts the tokens of texts; remembers the counts of pieces between spaces, up to a bound.

    A piece is numbered by its text without the space before it; the first piece of a text, which
    has none, is counted for itself.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.path, self.remembered = path, remembered
        self.merger = Merger(path)
        self.pattern = regex.compile(PATTERN)
        self.numbers, self.counts = Numbers(), np.zeros(0, np.int64)
        self.library = None

    def pieces(self, text: str) -> list[str]:
        """The text cut at single inner spaces."""
        odd = any(x in text for x in NEAR_SPACES) or text[:1] == " " or text[-1:] == " " or RARE_SPACE.search(text)
        return INNER_SPACE.split(text) if odd else text.split(" ")

    def exact(self, text: str) -> int:
        """The library's own count, for texts that hold a special string."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def count(self, pieces: list[str], space: str) -> np.ndarray:
        tokens: list[str] = []
        sizes = np.ones(len(pieces), np.int64)
        for i, x in enumerate(pieces):
            if x.isalpha():  # one run of letters is one pre-token
                tokens.append(space + x)
            else:
                cut = self.pattern.findall(space + x)
                sizes[i] = len(cut)
                tokens += cut
        counts, _ = self.merger([t.encode("utf-8", "surrogatepass") for t in tokens])
        return np.diff(np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(sizes)])])

    def __call__(self, texts: list[str]) -> list[int]:
        if len(self.numbers) > self.remembered:
            self.numbers, self.counts = Numbers(), self.counts[:0]
        number = self.numbers.__getitem__
        heads, used, at = [], [], []
        for i, t in enumerate(texts):
            if SPECIAL in t:
                heads.append("")
                continue
            head, *rest = self.pieces(t)
            heads.append(head)
            used.append(np.fromiter(map(number, rest), np.int64, len(rest)))
            at.append(i)
        new = list(islice(self.numbers, len(self.counts), None))
        self.counts = np.concatenate([self.counts, self.count(new, " ")])
        out = self.count(heads, "")
        for i, pieces in zip(at, used, strict=True):
            out[i] += self.counts[pieces].sum()
        return [self.exact(t) if SPECIAL in t else n for t, n in zip(texts, out.tolist(), strict=True)]


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    Null text counts as empty: no bytes, no tokens. Every row gets an answer, also repeated rows and
    rows with a null doc_id; other columns are not read. Texts are counted whole, at any length.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        count = None
        for b in batches:
            if count is None:
                count = Counter(path)
            n = count(b.column("text").to_pylist())
            yield {"doc_id": b.column("doc_id"), "n_bytes": b.column("n_bytes"), "n_tokens": n, "over_limit": [x > limit for x in n]}

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    return map_batches(rows, "doc_id long, n_bytes long, n_tokens long, over_limit boolean", work)
