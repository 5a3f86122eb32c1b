"""Toxicity scores by a factorization machine over hashed terms.

The machine adds to a linear score the products of learned factors of all pairs of terms that occur
together, so that a pair can weigh more than its terms alone. Terms are hashed words; the fit keeps
those most associated with the label. It is fitted on a bounded sample of labelled rows
(``sample_rows``), gathered as hashed terms; scores cover every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import crc_bucket, in_sample, map_batches, sample_rate

WORD = re.compile(r"\w+")
BUCKETS = 1 << 20
#: Labelled rows used for the fit, at most about this many.
SAMPLE_ROWS = 12_000
TERMS = 1_500
FACTORS = 8
REMEMBERED = 500_000


def hashed_terms(text: str) -> list[int]:
    """Distinct hashed words of a text."""
    return list({crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS for w in set(WORD.findall(text.lower()))})


def association(terms: list[np.ndarray], labels: np.ndarray, keep: int) -> np.ndarray:
    """The ``keep`` hashed terms whose presence tells most about the label (likelihood ratio)."""
    n, positive = len(labels), labels.sum()
    sizes = np.array([len(t) for t in terms])
    flat = np.concatenate([*terms, np.zeros(0, np.int64)]).astype(np.int64)
    df = np.bincount(flat, minlength=BUCKETS).astype(float)
    hit = np.bincount(flat, weights=np.repeat(labels, sizes), minlength=BUCKETS)
    used = np.flatnonzero(df >= max(3, 0.002 * n))
    df, hit = df[used], hit[used]
    gain = np.zeros(len(used))
    for seen, expected in ((hit, df * positive / n), (df - hit, df * (1 - positive / n)), (positive - hit, (n - df) * positive / n), (n - positive - df + hit, (n - df) * (1 - positive / n))):
        gain += seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9))
    order = np.lexsort((used, -gain))[:keep]
    return used[order[gain[order] >= 5]]  # below that, chance alone explains it


@dataclass
class Machine:
    """A fitted machine: the hashed terms it knows, their weights and their factors."""

    terms: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, places: np.ndarray) -> float:
        """Probability of the label for the places (in ``terms``) of the known terms of a text."""
        v = self.factors[places]
        raw = self.bias + self.weights[places].sum() + 0.5 * float((v.sum(0) ** 2 - (v * v).sum(0)).sum())
        return float(1 / (1 + np.exp(-np.clip(raw, -30, 30))))


def fit(terms: list[np.ndarray], labels: np.ndarray, keep: int = TERMS, factors: int = FACTORS, steps: int = 250, decay: float = 5e-4) -> Machine:
    """Fits by Adam on the regularised logistic loss. Without rows the machine scores 0.5."""
    labels = np.asarray(labels, np.float32)
    if not len(labels):
        return Machine(np.zeros(0, np.int64), 0.0, np.zeros(0, np.float32), np.zeros((0, factors), np.float32))
    known = association(terms, labels, keep)
    place = np.full(BUCKETS, -1, np.int64)
    place[known] = np.arange(len(known))
    x = np.zeros((len(labels), len(known)), np.float32)
    for i, t in enumerate(terms):
        at = place[np.asarray(t, np.int64)]
        x[i, at[at >= 0]] = 1
    rate = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
    rng = np.random.default_rng(7)
    p = [np.array([np.log(rate / (1 - rate))], np.float32), np.zeros(len(known), np.float32), rng.normal(0, 0.02, (len(known), factors)).astype(np.float32)]
    m, s = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    for step in range(1, steps + 1):
        b, w, v = p
        sums = x @ v
        raw = b[0] + x @ w + 0.5 * ((sums**2).sum(1) - x @ (v * v).sum(1))
        err = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels) / len(labels)
        grads = [np.array([err.sum()], np.float32), x.T @ err + decay * w, x.T @ (err[:, None] * sums) - (x.T @ err)[:, None] * v + decay * v]
        for i, g in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * g
            s[i] = 0.99 * s[i] + 0.01 * g * g
            p[i] = p[i] - 0.05 * (m[i] / (1 - 0.9**step)) / (np.sqrt(s[i] / (1 - 0.99**step)) + 1e-7)
    return Machine(known, float(p[0][0]), p[1], p[2])


def term_rows(rows: DataFrame) -> DataFrame:
    """(label, terms) of rows of (text, label)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            yield {"label": b.column("label"), "terms": [hashed_terms(t) for t in b.column("text").to_pylist()]}

    return map_batches(rows.select("text", "label"), "label int, terms array<int>", work)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """A machine fitted on labelled documents outside the held-out fold.

    The sample is drawn from the labels by hash and holds about ``sample_rows`` rows, a proven bound
    for the broadcast. Rows with a null id, label or text take no part.
    """
    usable = labels.where("doc_id is not null and toxic is not null").where(crc_bucket("doc_id", 4) != 2)
    usable = usable.groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").cast("int").alias("label"))
    chosen = usable.where(in_sample(F.col("__id"), sample_rate(usable, sample_rows)))
    rows = docs.where("text is not null").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))
    got = term_rows(rows).toArrow()
    order = sorted(zip(got.column("label").to_pylist(), map(sorted, got.column("terms").to_pylist())))
    return fit([np.array(t, np.int64) for _, t in order], np.array([x for x, _ in order]))


def toxicity(docs: DataFrame, machine: Machine, threshold: float = 0.3) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted (1 if the score is at least ``threshold``).

    Null and empty texts get the score of a text without known terms. Every row gets an answer, also
    repeated rows and rows with a null doc_id (its fold is that of an empty id); other columns are
    not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        place = {int(t): i for i, t in enumerate(machine.terms)}
        words: dict[str, int] = {}

        def at(word: str) -> int:
            i = words.get(word)
            if i is None:
                i = words[word] = place.get(crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS, -1)
            return i

        for b in batches:
            scores = []
            if len(words) > REMEMBERED:
                words.clear()
            for t in b.column("text").to_pylist():
                known = {at(w) for w in set(WORD.findall(t.lower()))}
                known.discard(-1)
                scores.append(machine.score(np.array(sorted(known), np.int64)))
            yield {"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "score": scores, "predicted": [int(x >= threshold) for x in scores]}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_bucket("doc_id", 4) == 2).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return map_batches(rows, "doc_id long, held_out boolean, score double, predicted int", work)
