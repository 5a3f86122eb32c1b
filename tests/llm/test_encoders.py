"""The packing encoder's ids and bounds, the merger's block, and the plan of the line deletion."""

import numpy as np

from adlake.llm import bpe, line_dedup, packing, pretokens
from adlake.llm.queries import tokenizer

ODD = [
    "Don't I'LL x's it'S '' a'b 'tis 12ab3 a_b-c <|endoftext|> x<|endoftext|>y <| a", "ÉCOLE Straße İstanbul ŉ ǅ ſ ª µ Ÿ ﬁ ²", "é àb \x0b\x0cz \x1c a\x85b\xa0q \x7f",
    "日本語 ΟΔΟΣ нет", "", "   ", "a\r\nb\tc", "'S'RE'VE x'", "<|STARTOFTEXT|> a~b!!c..", "ÀÈ'S ß'll ×÷ ¿Qué?",
]


def test_packing_ids_equal_the_library(monkeypatch):
    path = tokenizer("word_bpe_49k.json")
    monkeypatch.setattr(packing, "LIBRARY_PIECES", 3)
    encode = packing.Encoder(path, remembered=50, group=40)
    for _ in range(2):
        got = encode(ODD, 1)
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [[*encode.library.encode(t, add_special_tokens=False).ids, 1] for t in ODD]


def test_the_library_gets_few_pieces_at_a_time():
    encode = packing.Encoder(tokenizer("word_bpe_49k.json"))
    library, sizes = encode.library, []

    class Counted:
        def encode_batch_fast(self, pieces, **options):
            sizes.append(len(pieces))
            return library.encode_batch_fast(pieces, **options)

    encode.library = Counted()
    encode([" ".join(f"дом{n}" for n in range(5000))], 1)
    assert sum(sizes) == 5000 and max(sizes) <= packing.LIBRARY_PIECES


def test_merges_do_not_depend_on_the_block():
    merge = bpe.Merger(tokenizer("byte_bpe_50k.json"))
    words = [b"", *[f" word{n}ing".encode() for n in range(300)]]
    counts, flat = merge(words, symbols=True, block=7)
    whole = merge(words, symbols=True)
    assert (counts == whole[0]).all() and (flat == whole[1]).all()
    assert bpe.BLOCK <= 1 << 14


def test_texts_meet_their_cuts_by_a_shuffle_at_every_size(spark):
    docs = spark.createDataFrame([(1, "a " * 30), (2, "a " * 30), (3, "b")], "doc_id long, text string")
    rows = line_dedup.line_dedup(docs)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert {r["doc_id"]: r["__cut"] for r in rows.collect()} == {1: 0, 2: 1, 3: 0}


def test_pretokens_are_merged_once_and_the_library_gets_only_doubtful_pieces(monkeypatch):
    encode = packing.Encoder(tokenizer("word_bpe_49k.json"))
    merged, asked = [], []
    rows, library = encode.merger.rows, encode.library
    monkeypatch.setattr(encode.merger, "rows", lambda data, sizes, symbols: merged.append(len(sizes)) or rows(data, sizes, symbols))

    class Asked:
        def encode_batch_fast(self, pieces, **options):
            asked.extend(pieces)
            return library.encode_batch_fast(pieces, **options)

    encode.library = Asked()
    words = [f"{a}{b}" for a in ("thin", "éle", "øre", "ÿ", "internationalisation") for b in "abcdefgh".replace("b", "ß")]
    texts = [" ".join(f"{w}{end} {w.upper()}{end}" for w in words) + " 日本 日本 x’s" for end in ("", ".", ",", "!!", "'s", "7")]
    for _ in range(2):
        got = encode(texts, 1)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [[*library.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    # each word, once more with ss where its upper case has that, and the endings
    assert sum(merged) <= 2 * len(words) + 6 and sorted(asked) == ["x’s", "日本"]


def test_every_character_of_two_bytes_equals_the_library():
    encode = packing.Encoder(tokenizer("word_bpe_49k.json"))
    texts = [f"a{c}b {c} {c}{c}'s 1{c}'{c} '{c}ll I'{c}M" for c in map(chr, range(0x900))]
    assert [np.frombuffer(g, "<u4").tolist() for g in encode(texts, 1)] == [[*e.ids, 1] for e in encode.library.encode_batch_fast(texts, add_special_tokens=False)]


def test_long_texts_are_encoded_in_parts_and_nothing_is_lost():
    path = tokenizer("word_bpe_49k.json")
    texts = ["ab'll cd, 日本 " * 400, "", " ", "x" * 3000, "a\n" * 100, "don't"]
    parts, whole = packing.Encoder(path, group=64), packing.Encoder(path)
    assert max(len(t) for _, t in parts.cut(texts[:1])) < 80 and "".join(t for _, t in parts.cut(texts[:1])) == texts[0]
    assert parts(texts, 1) == whole(texts, 1) == [np.array([*whole.library.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes() for t in texts]
    assert whole([], 1) == []


def test_word_table_keeps_keys_that_share_a_slot():
    table = pretokens.WordTable(bits=4)
    keys = [np.arange(1, 5001, dtype=np.uint64) << np.uint64(40), np.arange(5000, dtype=np.uint64) % np.uint64(7)]
    first, _, second = table.add([k[:2000] for k in keys]), table.reserve(10), table.add([k[2000:4000] for k in keys])
    assert len({*first, *second}) == 4000 and 0 not in first
    assert (table.find(keys) == [*first, *second, *[0] * 1000]).all()
