import random

import numpy as np
import pytest

from martloom.llm import setsketch as sk


def sets(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))) if words else frozenset()


def brute(docs):
    own = [(i, sets(t)) for i, t in docs]
    root = list(range(len(own)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(own)):
        for b in range(a):
            x, y = own[a][1], own[b][1]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(own):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, len(s), least[find(k)], i == least[find(k)]) for k, (i, s) in enumerate(own))


def corpus(seed, groups, copies, edits):
    rng = random.Random(seed)
    docs = []
    for _ in range(groups):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(3, 160))]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, edits)):
                words[rng.randrange(len(words))] = f"w{rng.randint(0, 5000)}"
            docs.append(" ".join(words))
            base = words if rng.random() < 0.3 else base  # chains
    rng.shuffle(docs)
    return list(enumerate(docs))


def test_against_brute_force(spark, make_docs):
    docs = corpus(5, 14, 12, 3)
    n = len(docs)
    docs += [(n, ""), (n + 1, " \t\n"), (n + 2, "a b"), (n + 3, "A  B"), (n + 4, "É É É"), (n + 5, "é é é"),
             (n + 6, "word " * 20_000), (n + 7, "Word\n" * 15_000)]
    out = sk.near_duplicates(make_docs(docs)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out) == brute(docs)


def test_null_ids_and_repeated_rows(spark, make_docs):
    docs = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "only without an id here"), (2, None)]
    out = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in sk.near_duplicates(make_docs(docs)).collect()), key=str)
    assert out == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 1, None, True), (2, 0, 2, True)], key=str)
    assert sk.near_duplicates(make_docs([])).count() == 0


def test_rows_without_ids_are_linked_by_similarity(spark, make_docs):
    words = [f"w{i}" for i in range(120)]
    near = [" ".join([*words[:k], "other", *words[k + 1:]]) for k in (10, 60)]
    alone = [f"z{i}" for i in range(120)]
    docs = [(7, " ".join(words)), (None, near[0]), (None, near[1]), (None, near[1]),
            (None, " ".join(alone)), (None, " ".join([*alone[:50], "x", *alone[51:]])), (None, "")]
    out = sk.near_duplicates(make_docs(docs)).collect()
    assert sorted((r.component_id, r.kept) for r in out if r.component_id is not None) == [(7, False)] * 3 + [(7, True)]
    pair = [r for r in out if r.component_id is None and r.n_shingles]
    assert len(pair) == 2 and sorted(r.kept for r in pair) == [False, True]
    assert [r.kept for r in out if not r.n_shingles] == [True]


@pytest.mark.parametrize("similarity", [0.2, 0.6, 0.85, 0.95])
def test_sketches_estimate_merge_and_collide(similarity):
    rng = np.random.default_rng(1)
    n, pairs = 400, 60
    shared = round(2 * n * similarity / (1 + similarity))
    a = [rng.integers(0, 2**63, n, np.uint64) for _ in range(pairs)]
    b = [np.concatenate([x[:shared], rng.integers(0, 2**63, n - shared, np.uint64)]) for x in a]
    ka, kb = (np.array([sk.registers_of(x) for x in s]) for s in (a, b))
    size = np.full(pairs, n)
    assert abs(sk.estimate(ka, kb, size, size).mean() - similarity) < 0.03
    union = np.array([sk.registers_of(np.concatenate([x, y])) for x, y in zip(a, b, strict=True)])
    assert (sk.merge(ka, kb) == union).all()
    if similarity >= 0.85:
        assert (sk.bands_of(ka) == sk.bands_of(kb)).any(axis=1).all()


def test_estimate_uses_set_sizes():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 1000, np.uint64)
    pair = [sk.registers_of(a)[None], sk.registers_of(a[:500])[None]]
    assert abs(sk.estimate(*pair, np.array([1000]), np.array([500]))[0] - 0.5) < 0.12


def test_large_neighbourhoods_in_cells(spark, make_docs, monkeypatch):
    """Blocks of three classes: links between blocks are found like links inside one."""
    monkeypatch.setattr(sk, "CELL", 3)
    monkeypatch.setattr(sk, "PACK", 2)
    docs = corpus(8, 5, 25, 2)
    out = sk.near_duplicates(make_docs(docs)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out) == brute(docs)


def test_links_of_a_cell():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 60, np.uint64)
    sets = [np.unique(np.concatenate([base[k:], rng.integers(0, 2**63, k, np.uint64)])) for k in (0, 2, 5, 20, 60)]
    want = np.array([[len(np.intersect1d(a, b)) * 100 >= 85 * len(np.union1d(a, b)) for b in sets] for a in sets])
    assert (sk.verified_links(sets, sets, np.ones((5, 5), bool)) == want).all()
    assert not sk.verified_links(sets, sets, np.zeros((5, 5), bool)).any()
    pairs = np.argwhere(np.triu(np.ones((6, 6), bool), 1))
    assert len(sk.forest(pairs, 6)) == 5 and sk.forest(pairs[:0], 6) == []
