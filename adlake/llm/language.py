"""Language identification by mixtures of languages.

Each language has a character trigram model, trained on a bounded sample of labelled documents
(``sample_rows``). A document is a mixture: expectation-maximisation over the likelihoods of its
words estimates the share of each language, and languages are added to the set as long as the
likelihood gains more than a penalty. The prediction is the language with the largest share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import crc_bucket, in_sample, map_batches, sample_rate, words

LETTERS = regex.compile(r"\p{L}+")
#: Labelled rows used for the trigram counts, at most about this many.
SAMPLE_ROWS = 20_000
REMEMBERED = 300_000
PENALTY = 3.0


@dataclass
class Models:
    """Log-probabilities per language of each known trigram; the last row is for unknown ones."""

    langs: list[str]
    rows: dict[str, int]
    logp: np.ndarray

    def of_words(self, found: list[str]) -> np.ndarray:
        """Log-likelihood of each word under each language."""
        places, sizes, get, unknown = [], [], self.rows.get, len(self.logp) - 1
        for w in found:
            w = f" {w} "
            at = [get(w[i : i + 3], unknown) for i in range(len(w) - 2)]
            places += at
            sizes.append(len(at))
        if not sizes:
            return np.zeros((0, len(self.langs)), np.float32)
        starts = np.cumsum(sizes) - sizes
        return np.add.reduceat(self.logp[places], starts, axis=0)


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Models:
    """Trigram counts of the sampled labelled documents, summed by Spark per language and trigram.

    Held-out rows and rows with a null id, text or language take no part. A trigram seen only once is
    left to the unknown row. The table that reaches the driver is bounded by the sample.
    """
    rows = docs.where("doc_id is not null and text is not null and lang is not null").where(crc_bucket("doc_id", 5) != 0)
    rows = rows.where(in_sample(F.col("doc_id"), sample_rate(rows, sample_rows)))
    word = rows.select("lang", F.explode(words(F.col("text"))).alias("w")).where(F.col("w").rlike(r"^\p{L}+$"))
    word = word.groupBy("lang", "w").count()
    padded = F.concat(F.lit(" "), F.col("w"), F.lit(" "))
    tri = word.select("lang", "count", F.explode(F.transform(F.sequence(F.lit(1), F.length("w")), lambda i: F.substr(padded, i, F.lit(3)))).alias("g"))
    counts = tri.groupBy("lang", "g").agg(F.sum("count").alias("n")).where("n > 1").toPandas().sort_values(["g", "lang"])
    langs = sorted(counts["lang"].unique())
    grams = sorted(counts["g"].unique())
    table = np.zeros((len(grams) + 1, len(langs)))
    index = {g: i for i, g in enumerate(grams)}
    table[counts["g"].map(index).to_numpy(int), counts["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(int)] = counts["n"]
    if langs:
        table = np.log((table + 0.2) / (table.sum(0) + 0.2 * len(table)))
    return Models(langs, index, table.astype(np.float32))


def mixture(p: np.ndarray, counts: np.ndarray, steps: int = 30) -> tuple[np.ndarray, float]:
    """Shares of the columns of ``p`` (likelihoods per word) and the log-likelihood."""
    share = np.full(p.shape[1], 1 / p.shape[1])
    for _ in range(steps):
        r = p * share
        share = (counts[:, None] * r / r.sum(1, keepdims=True)).sum(0) / counts.sum()
        share = np.maximum(share, 1e-9)
    return share / share.sum(), float((counts * np.log(p @ share)).sum())


def select(logp: np.ndarray, counts: np.ndarray, penalty: float) -> tuple[int, float]:
    """(language, share) of the best set: languages join while the likelihood gains more than the penalty."""
    p = np.exp(np.maximum(logp - logp.max(1, keepdims=True), -40)).astype(float)
    single = (counts[:, None] * np.log(p)).sum(0)
    chosen, best, share = [int(single.argmax())], float(single.max()), np.ones(1)
    cost = penalty * np.log(counts.sum() + 1)
    while len(chosen) < p.shape[1]:
        tried = [(mixture(p[:, [*chosen, x]], counts), x) for x in range(p.shape[1]) if x not in chosen]
        (new, value), x = max(tried, key=lambda t: (t[0][1], -t[1]))
        if value - best <= cost:
            break
        chosen, best, share = [*chosen, x], value, new
    top = int(share.argmax())
    return chosen[top], float(share[top])


def pair_gains(logp: np.ndarray, doc: np.ndarray, starts: np.ndarray, single: np.ndarray, steps: int = 6) -> np.ndarray:
    """Per document, the largest gain of adding a second language to the best one; all documents at once."""
    main = single.argmax(1)
    ratio = np.exp(np.clip(logp - logp[np.arange(len(logp)), main[doc]][:, None], -40, 40))
    share = np.full(single.shape, 0.2, np.float32)
    n = np.diff(np.append(starts, len(doc)))[:, None]
    for _ in range(steps):
        s = share[doc]
        r = s * ratio
        share = np.add.reduceat(r / (1 - s + r), starts, axis=0) / n
        share = np.clip(share, 1e-6, 1 - 1e-6).astype(np.float32)
    s = share[doc]
    gain = np.add.reduceat(np.log(1 - s + s * ratio), starts, axis=0)
    gain[np.arange(len(gain)), main] = 0
    return gain.max(1)


def languages(docs: DataFrame, models: Models, penalty: float = PENALTY) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score (the share of the predicted language).

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned. Every row
    gets an answer, also repeated rows and rows with a null doc_id (its fold is that of an empty id).
    Equal likelihoods go to the language first in order.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        number: dict[str, int] = {}
        table = np.zeros((0, len(models.langs)), np.float32)
        for b in batches:
            if len(number) > REMEMBERED:
                number, table = {}, table[:0]
            texts = b.column("text").to_pylist()
            pred, score = ["und"] * len(texts), [0.0] * len(texts)
            new: list[str] = []
            which, ids = [], []
            for i, t in enumerate(texts):
                found = LETTERS.findall(t.lower()) if models.langs else []
                if not found:
                    continue
                for w in set(found).difference(number):
                    number[w] = len(number)
                    new.append(w)
                which.append(i)
                ids.append(np.fromiter(map(number.__getitem__, found), np.int64, len(found)))
            if which:
                table = np.concatenate([table, models.of_words(new)])
                sizes = np.array([len(x) for x in ids])
                starts = np.cumsum(sizes) - sizes
                logp = table[np.concatenate(ids)]
                single = np.add.reduceat(logp, starts, axis=0, dtype=np.float64)
                gains = pair_gains(logp, np.repeat(np.arange(len(ids)), sizes), starts, single)
                for k, i in enumerate(which):
                    if gains[k] > 0.5 * penalty * np.log(sizes[k] + 1):  # the quick fit is not at its maximum yet
                        own, times = np.unique(ids[k], return_counts=True)
                        lang, share = select(table[own], times.astype(float), penalty)
                    else:
                        lang, share = int(single[k].argmax()), 1.0
                    pred[i], score[i] = models.langs[lang], share
            yield {"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "lang_pred": pred, "score": score}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_bucket("doc_id", 5) == 0).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return map_batches(rows, "doc_id long, held_out boolean, lang_pred string, score double", work)
