"""Cross-tokenizer alignment against plain loops over token ends and corpus-wide counting."""

import hashlib
from collections import Counter

import sentencepiece
from tokenizers import Tokenizer

from adlake.llm import alignment
from adlake.llm.bpe import byte_letters
from adlake.llm.queries import tokenizer


def walk(text, lib_a, lib_b):
    """Groups and links of one text from the byte ends of its tokens, or None without tokens."""
    if not text:
        return None
    letters = {c: i for i, c in enumerate(byte_letters())}
    a = lib_a.encode(" " + text, add_special_tokens=False).ids
    b = lib_b.encode(text)
    ba = [bytes(letters[c] for c in lib_a.id_to_token(i)) for i in a]
    bb = [bytes([int(lib_b.id_to_piece(i)[3:5], 16)]) if lib_b.is_byte(i) else lib_b.id_to_piece(i).replace("▁", " ").encode() for i in b]
    whole = (" " + text).encode()
    if b"".join(ba) != whole or b"".join(bb) != whole:
        return None
    ends_a, ends_b, at = [], [], 0
    for x in ba:
        at += len(x)
        ends_a.append(at)
    at = 0
    for x in bb:
        at += len(x)
        ends_b.append(at)
    by_end = {}
    for j, e in enumerate(ends_b):
        by_end.setdefault(e, []).append(j)
    links = [(a[i], b[j]) for i, e in enumerate(ends_a) for j in by_end.get(e, [])]
    cuts = sorted(set(ends_a) & set(ends_b))
    groups, lo = [], 0
    for c in cuts:
        groups.append(([a[i] for i, e in enumerate(ends_a) if lo < e <= c], [b[j] for j, e in enumerate(ends_b) if lo < e <= c]))
        lo = c
    return a, b, groups, links


def test_against_a_plain_walk(spark):
    path_a, path_b = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
    lib_a = Tokenizer.from_file(path_a)
    lib_a.encode_special_tokens = True
    lib_b = sentencepiece.SentencePieceProcessor(model_file=path_b)
    texts = [
        (1, "The cat sat on the mat."), (2, "The cat sat on the mat."), (None, "naïve café, déjà vu!"), (3, None), (4, ""),
        (5, "ﬁne ligature"), (6, "<|endoftext|> and <s> stay text"), (7, "word " * 300), (8, "The dog sat."), (9, "  two  spaces"),
    ]
    docs = spark.createDataFrame([(*t, "x", 1) for t in texts], "doc_id long, text string, row string, links int")
    got = sorted((tuple(r) for r in alignment.alignment(docs, path_a, path_b).collect()), key=str)

    walked = [(doc_id, walk(text, lib_a, lib_b)) for doc_id, text in texts]
    count = Counter(link for _, w in walked if w for link in w[3])
    top = Counter()
    for (x, y), n in count.items():
        top[y] = max(top[y], n)
    want = []
    for doc_id, w in walked:
        if w is None:
            want.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = w
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        n_best = sum(count[link] == top[link[1]] for link in links)
        want.append((doc_id, len(a), len(b), len(groups), len(links), n_best, sum(count[link] for link in links), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert sum(1 for r in want if r[1]) >= 7


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.alignment(docs, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")).count() == 0
