import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import suffix_dedup as sd


def brute(docs):
    """docs: (id, text) rows; what each row should answer."""
    rows = [(sd.NO_ID if i is None else i, (t or "").encode()) for i, t in docs]
    first = {}
    for i, b in rows:
        for k in range(len(b) - sd.WIDTH + 1):
            w = b[k : k + sd.WIDTH]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, b in rows:
        gone = bytearray(len(b))
        for k in range(len(b) - sd.WIDTH + 1):
            if first[b[k : k + sd.WIDTH]] < i:
                gone[k : k + sd.WIDTH] = b"\1" * sd.WIDTH
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((None if i == sd.NO_ID else i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    letters = "ab é"
    passages = ["".join(rng.choice(letters) for _ in range(rng.randint(45, 120))) for _ in range(4)]
    docs = []
    for i in rng.sample(range(10 * n), n):
        parts = ["".join(rng.choice("abcdefgh \né") for _ in range(rng.randint(0, 150)))]
        while rng.random() < 0.6:
            parts += [rng.choice(passages), "".join(rng.choice("xyz") for _ in range(rng.randint(0, 3)))]
        docs.append((i, "".join(parts)))
    docs += [(10 * n + 1, docs[0][1]), (10 * n + 2, docs[0][1]), (docs[1][0], docs[2][1]), (docs[1][0], docs[1][1])]
    return [*docs, (None, docs[3][1]), (None, docs[4][1]), (20 * n, None), (20 * n + 1, ""), (20 * n + 2, "a" * 400),
            (20 * n + 3, "a" * 300), (20 * n + 4, "ab" * 200), (20 * n + 5, "short")]


@pytest.mark.parametrize(("seed", "options"), [
    (1, {}), (2, {"part_bytes": 500, "bucket_bytes": 700}), (3, {"part_bytes": 400, "hot_contexts": 1}),
    (4, {"part_bytes": 2000, "hot_contexts": 0})])
def test_against_brute_force(spark, make_docs, seed, options):
    docs = corpus(seed, 40)
    out = sd.dedup_passages(make_docs(docs), **options).collect()
    assert sorted(map(tuple, out), key=str) == brute(docs)


def test_long_text_and_empty_table(spark, make_docs):
    text = "".join(random.Random(1).choice("abcdef ") for _ in range(300_000))
    out = {r.doc_id: r for r in sd.dedup_passages(make_docs([(1, text), (2, "x" + text[1000:200_000] + "y")])).collect()}
    assert (out[1].n_removed, out[2].n_removed, out[2].n_spans) == (0, 199_000, 1)
    assert sd.dedup_passages(make_docs([])).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1), min_size=sd.CHARACTERS, max_size=sd.CHARACTERS), max_size=60))
def test_sort_suffixes(rows):
    characters = np.array(rows, np.uint64).reshape(-1, sd.CHARACTERS)
    order, group = sd.sort_suffixes(characters)
    ordered = [tuple(characters[i]) for i in order]
    assert ordered == sorted(map(tuple, characters.tolist()))
    names = {}
    assert all(names.setdefault(int(g), r) == r for g, r in zip(group, ordered, strict=True))
    assert len(names) == len(set(ordered))


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=50, max_size=160) | st.binary(max_size=3).map(lambda b: (b or b"a") * 60))
def test_equal_windows_have_equal_anchors(data):
    a = np.frombuffer(data, np.uint8)
    seen = {}
    place, _ = sd.anchors(a)
    for k, q in enumerate(place[: len(a) - sd.WIDTH + 1]):
        assert 0 <= q - k <= sd.LEAD
        assert seen.setdefault(data[k : k + sd.WIDTH], q - k) == q - k
