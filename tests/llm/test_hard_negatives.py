"""Hard negatives against brute force; the tree's intervals and pruning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import hard_negatives as hn

ROWS = "vec_id long, label long, terms array<long>, row string, shard string, along string"


def brute_force(rows, is_anchor, low=80, high=100, k=5):
    rows = sorted({(i, lab, tuple(t)) for i, lab, t in rows
                   if i is not None and lab is not None and t is not None and None not in t})
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, lab, t in rows:
        if not is_anchor(i):
            continue
        scored = sorted((-dot(t, u), j, other) for j, other, u in rows if j != i)
        for p, j, _ in [c for c in scored if c[2] == lab][:k]:
            inside = [c for c in scored if c[2] != lab and low * -p <= 100 * -c[0] <= high * -p][:k]
            out += [(i, j, r, n, -p, -s) for r, (s, n, _) in enumerate(inside, 1)]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "r", "s", "a") for r in rows], ROWS)
    return sorted(map(tuple, hn.mine(df, F.col("vec_id") % 10 == 0, **kw).collect()))


@pytest.mark.parametrize("seed,shard", [(0, 16), (1, 50), (2, 8192)])
def test_equals_brute_force(spark, seed, shard):
    rng = np.random.default_rng(seed)
    rows = [(i, int(rng.integers(0, 4)), rng.integers(-30, 30, 6).tolist()) for i in range(150)]
    rows += [(1000 + i, 1, rows[0][2]) for i in range(40)]                   # a very common vector and label
    assert mined(spark, rows, shard=shard) == brute_force(rows, lambda i: i % 10 == 0)


def test_window_and_counts_are_parameters(spark):
    rng = np.random.default_rng(4)
    rows = [(i, i % 3, rng.integers(-9, 9, 3).tolist()) for i in range(60)]
    got = mined(spark, rows, positives=2, negatives=2, per_cent=(50, 120), shard=20)
    assert got == brute_force(rows, lambda i: i % 10 == 0, 50, 120, 2)


def test_nulls_repeats_lengths_and_empty(spark):
    rows = [(0, 1, [5, 5]), (0, 1, [5, 5]), (1, 1, [4, 6]), (2, 2, [4]), (3, 2, [5, 4, 9]), (None, 1, [5, 5]), (4, None, [5, 5]),
            (5, 2, None), (6, 2, [None, 1]), (10, 3, []), (20, 1, [-5, -5]), (30, 2, [2**20, 2**20])]
    assert mined(spark, rows) == brute_force(rows, lambda i: i % 10 == 0)
    assert mined(spark, []) == []
    assert mined(spark, [(10, 1, [1])]) == []


def test_rows_of_embeddings(spark):
    df = spark.createDataFrame([(1, [0.5, -0.001], 3), (2, [float("nan"), 1.0], 3), (3, [None, 1.0], 3), (4, None, 3), (5, [1.0], None)],
                               "vec_id long, embedding array<float>, label int")
    assert [tuple(r) for r in hn.integer_rows(df, F.col("label")).collect()] == [(1, 3, [128, -1])]


def test_tree_intervals_hold_and_prune():
    rng = np.random.default_rng(7)
    matrix = np.concatenate([rng.integers(-5, 5, (400, 4)), rng.integers(200, 210, (100, 4))])
    labels = rng.integers(0, 3, 500)
    tree = hn.RTree(np.arange(500), np.arange(500), labels, matrix, leaf=8, fanout=4)
    for low, high, least, most in tree.levels:
        assert (low <= high).all() and (least <= most).all()
    assert len(tree.levels[-1][0]) == 1
    query, seen = np.array([1, 1, 1, 1]), []
    best = hn.Best(3)
    plain = hn.RTree.search

    def counting(self, q, may_hold, open_to, take):
        plain(self, q, may_hold, open_to, lambda rows, scores: (seen.append(len(scores)), take(rows, scores)))

    hn.RTree.search = counting
    try:
        hn.search_windows(tree, query, -1, 1, True, [best])
    finally:
        hn.RTree.search = plain
    assert sum(seen) < 250  # the near-origin rows are never reached
    want = sorted((-int(s), int(i)) for i, s in enumerate(matrix @ query) if labels[i] == 1)[:3]
    assert [(s, i) for s, i, _ in best.found] == want
