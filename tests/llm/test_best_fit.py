"""Best-fit packing against the tokenizer library and against an exhaustive packing of small cases."""

import itertools
from zlib import crc32

import numpy as np

from adlake.llm import best_fit
from adlake.llm.queries import tokenizer


def fewest_bins(items, window):
    for k in range(1, len(items) + 1):
        for deal in itertools.product(range(k), repeat=len(items)):
            load = [0] * k
            for b, w in zip(deal, items):
                load[b] += w
            if max(load) <= window:
                return k
    return 0


def test_cuts():
    assert best_fit.cuts(1, 8) == [(0, 1)]
    assert best_fit.cuts(8, 8) == [(0, 8)]
    assert best_fit.cuts(9, 8) == [(0, 1), (1, 8)]
    assert best_fit.cuts(16, 8) == [(0, 8), (8, 8)]


def test_each_sequence_is_the_fullest_and_the_count_is_least_on_small_cases():
    rng = np.random.default_rng(5)
    for _ in range(150):
        items = rng.integers(1, 11, rng.integers(1, 7))
        sequence, offset = best_fit.pack_shard(items, 10)
        assert sequence.max() + 1 == fewest_bins(list(items), 10)
        for s in np.unique(sequence):
            at = np.flatnonzero(sequence == s)
            ordered = at[np.argsort(offset[at])]
            assert list(offset[ordered]) == list(np.cumsum(items[ordered]) - items[ordered])
            assert items[at].sum() <= 10


def test_ties_of_equal_lengths_follow_the_given_order():
    sequence, offset = best_fit.pack_shard(np.array([5, 5, 5, 5]), 10)
    assert list(sequence) == [0, 0, 1, 1] and list(offset) == [0, 5, 0, 5]


def test_pieces_against_the_library(spark):
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    long_text = "alpha beta gamma delta " * 3000
    rows = [(1, "hello world"), (2, None), (3, ""), (3, ""), (None, "no id here"), (4, long_text), (5, "hello world"), (6, "<|endoftext|> inside")]
    docs = spark.createDataFrame([(*r, "clash", 7, 8) for r in rows], "doc_id long, text string, row string, shard int, piece int")
    got = best_fit.best_fit(docs, path).toPandas()
    library = Tokenizer.from_file(path)
    expected = {}
    for doc_id, text in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        expected.setdefault(doc_id, []).append(sorted((s, n, crc32(ids[s : s + n].tobytes()), len(ids)) for s, n in best_fit.cuts(len(ids), 2048)))
    for doc_id, runs in expected.items():
        mine = got[got.doc_id.isna()] if doc_id is None else got[got.doc_id == doc_id]
        assert sorted(zip(mine.start, mine.length, mine.ids_crc32, mine.doc_tokens)) == sorted(p for r in runs for p in r)
    assert (got.groupby("sequence_id").length.sum() <= 2048).all()
    for _, seq in got.sort_values("offset").groupby("sequence_id"):
        assert list(seq.offset) == list(seq.length.cumsum() - seq.length)
    assert got.groupby("sequence_id").ngroups == -(-got.length.sum() // 2048)
    assert best_fit.best_fit(docs.where("false"), path).count() == 0


def test_remembered_pieces_give_the_library_ids():
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = ["It's a test, isn't it?", "two  spaces", " lead", "trail ", "line\n next", "tab\t x", "nbsp here", "", "<|endoftext|>x y", "émigré café 123 4,5"]
    encode = best_fit.Encoder(path, remembered=50)
    for _ in range(2):
        got = encode(texts)
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]
