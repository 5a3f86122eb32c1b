"""Hard-negative mining against a brute-force reading of its contract."""

import math

import numpy as np

from adlake.llm import hard_negatives


def brute(rows, k=5, every=100):
    valid = []
    for vec_id, vec, label in rows:
        if vec_id is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        valid.append((vec_id, [math.floor(256 * float(x)) for x in vec], label))

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for aid, av, al in valid:
        if aid % every:
            continue
        scored = sorted(((dot(av, v), i, lab) for i, v, lab in valid if i != aid), key=lambda t: (-t[0], t[1]))
        for pscore, pid, _ in [t for t in scored if t[2] == al][:k]:
            window = [t for t in scored if t[2] != al and 80 * pscore <= 100 * t[0] <= 100 * pscore][:k]
            out += [(aid, pid, r + 1, nid, pscore, nscore) for r, (nscore, nid, _) in enumerate(window)]
    return sorted(out)


def test_against_brute_force_with_odd_rows(spark):
    rng = np.random.default_rng(11)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 8)], int(rng.integers(0, 4))) for i in range(420)]
    rows += [(500, None, 1), (600, [0.1] * 8, None), (700, [float("nan")] + [0.1] * 7, 1), (800, [float("inf")] * 8, 1), (900, [None] + [0.2] * 7, 2)]
    rows += [(None, [0.5] * 8, 1), (1000, [0.25] * 4, 2), (1100, [0.25] * 8, 2), (1100, [0.25] * 8, 2), (1200, [0.0] * 8, 3), (1300, [0.0] * 8, 3)]
    frame = spark.createDataFrame([(*r, "clash", 1, 2, 3) for r in rows], "vec_id long, embedding array<float>, label int, row string, c1 int, part int, block int")
    got = sorted(tuple(r) for r in hard_negatives.mine(frame, codes=4, sample_rows=200).collect())
    floats = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in rows]
    assert got == brute(floats)
    assert len(got) > 20


def test_empty_table_and_no_anchor(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(empty).count() == 0
    few = spark.createDataFrame([(1, [0.1, 0.2], 1), (2, [0.2, 0.1], 2)], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(few).count() == 0


def test_multi_sequence_order_is_by_falling_sum():
    up = [np.array([3.0, 1.0, 2.0]), np.array([0.5, 4.0])]
    got = list(hard_negatives.cells_in_order(up))
    assert [b for b, _, _ in got] == sorted((a + b for a in up[0] for b in up[1]), reverse=True)
    assert len({(i, j) for _, i, j in got}) == 6


def test_exact_products_beyond_doubles():
    x = np.array([[2.0**40, 1.0]])
    y = np.array([[2.0**40, 3.0], [2.0**40, 2.0]])
    assert list(hard_negatives.exact(x, y)[0]) == [2**80 + 3, 2**80 + 2]
