"""URL filters: fixed host and path rules, else naive Bayes over segmented host and path tokens.

Host names that are several words in one are split by a unigram Viterbi search; the word counts come
from the text of all pages. The urls that a rule decides are the training rows of a multinomial
naive Bayes over hashed tokens, which judges the others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import map_batches

#: Fixed values: (rule, verdict).
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: Words the segmenter knows: the most frequent ones of all pages. Other words are spelt out.
VOCABULARY = 50_000
LONGEST = 20
BUCKETS = 1 << 16
REMEMBERED = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for a null url or one without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls without one."""
    rule = verdict = None
    for text, says in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        where, start = text.split("/", 1)
        fits = ((host == where) | host.endswith(f".{where}")) & path.startswith(f"/{start}")
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def word_counts(pages: DataFrame, vocabulary: int = VOCABULARY) -> dict[str, int]:
    """Counts of the most frequent words in the visible text of all pages."""
    text = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style)\b.*?</\1>|<[^>]*>|&[a-z#0-9]+;", " ")
    word = F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("w")
    counts = pages.select(word).where(f"length(w) between 1 and {LONGEST}").groupBy("w").count()
    return {r["w"]: r["count"] for r in counts.orderBy(F.desc("count"), "w").limit(vocabulary).collect()}


class Segmenter:
    """Splits a name into the words of highest total unigram probability; ties go to the longer last word."""

    def __init__(self, counts: dict[str, int]):
        total = sum(counts.values()) + 1
        self.logp = {w: log(n / total) for w, n in counts.items()}
        self.unknown = log(0.1 / total)
        self.known: dict[str, list[str]] = {}

    def viterbi(self, name: str) -> list[str]:
        best, back = [0.0], [0]
        for end in range(1, len(name) + 1):
            value, start = max((best[s] + self.logp.get(name[s:end], self.unknown - 2.5 * (end - s)), -s) for s in range(max(0, end - LONGEST), end))
            best.append(value)
            back.append(-start)
        out, end = [], len(name)
        while end:
            out.append(name[back[end] : end])
            end = back[end]
        return out[::-1]

    def __call__(self, name: str) -> list[str]:
        if name not in self.known:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            self.known[name] = self.viterbi(name)
        return self.known[name]


PART = re.compile(r"[^\W\d_]+|\d+")


def tokens(host: str, path: str, cut: Segmenter) -> list[str]:
    """``h:`` words of the host, ``p:`` tokens of the path; a number stands for its length and first digit."""
    out = [f"h:{w}" for part in PART.findall(host) for w in (cut(part) if not part.isdigit() else ["0"])]
    return out + [f"p:{p.lower()}" if not p[0].isdigit() else f"p:{len(p)}d{p[0]}" for p in PART.findall(path)]


def bucket(token: str) -> int:
    return crc32(token.encode("utf-8", "surrogatepass")) % BUCKETS


@dataclass
class Bayes:
    """Log-odds of block against allow, per hashed token."""

    prior: float
    odds: np.ndarray

    def score(self, found: list[str]) -> float:
        return self.prior + float(self.odds[[bucket(t) for t in found]].sum()) if found else self.prior


def fit(judged: DataFrame, words: dict[str, int]) -> Bayes:
    """Counts over all rows that a rule decides, summed per batch and then by Spark; the result is bounded by the buckets."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        cut = Segmenter(words)
        for b in batches:
            n = np.zeros((2, BUCKETS + 1), np.int64)
            for host, path, says in zip(*(b.column(c).to_pylist() for c in ("host", "path", "by_rule"))):
                k = int(says == "block")
                n[k, BUCKETS] += 1
                for t in tokens(host, path, cut):
                    n[k, bucket(t)] += 1
            k, at = np.nonzero(n)
            yield {"k": k.astype(np.int32), "at": at.astype(np.int32), "n": n[k, at]}

    got = map_batches(judged.where("by_rule is not null").select("host", "path", "by_rule"), "k int, at int, n long", work).groupBy("k", "at").agg(F.sum("n").alias("n")).collect()
    n = np.zeros((2, BUCKETS + 1))
    for r in got:
        n[r["k"], r["at"]] = r["n"]
    rows, n = n[:, BUCKETS], n[:, :BUCKETS]
    used = max(1, int((n.sum(0) > 0).sum()))
    odds = np.log((n[1] + 1) / (n[1].sum() + used)) - np.log((n[0] + 1) / (n[0].sum() + used))
    return Bayes(float(np.log((rows[1] + 1) / (rows[0] + 1))), odds)


def url_verdicts(pages: DataFrame, rules=RULES, vocabulary: int = VOCABULARY) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, block_odds, host_words.

    A url without a rule is blocked where its log-odds are above 0. Null urls and those without
    ``://`` have an empty host and path and the prior's verdict. Repeated rows and null page_ids get
    an answer each; columns other than page_id, url and html are not read.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("__url"))
    host, path = split_url(F.col("__url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), says.alias("by_rule"))
    words = word_counts(pages, vocabulary)
    model = fit(rows, words)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        cut = Segmenter(words)
        for b in batches:
            odds, split, verdict = [], [], []
            for h, p, says in zip(*(b.column(c).to_pylist() for c in ("host", "path", "by_rule"))):
                found = tokens(h, p, cut)
                odds.append(model.score(found))
                split.append(" ".join(t[2:] for t in found if t[0] == "h"))
                verdict.append(says or ("block" if odds[-1] > 0 else "allow"))
            yield {"page_id": b.column("page_id"), "host": b.column("host"), "path": b.column("path"), "rule": b.column("rule"), "verdict": verdict, "block_odds": odds, "host_words": split}

    return map_batches(rows, "page_id long, host string, path string, rule string, verdict string, block_odds double, host_words string", work)
