import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import packing

tokenizers = pytest.importorskip("tokenizers")
PATH = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    t = tokenizers.Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


PIECES = [" ", "  ", "\n", "\t", "a", "Bc", "é", ".", ",", "'s", "1", "　", "\xa0", "​", "<|endoftext|>", "\x1c",
          "日本", "😀", "'", ".,", "́", "\x85", "²"]


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), max_size=5))
def test_chunked_ids_equal_whole_ids(texts):
    t = tokenizers.Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    got = packing.token_bytes(PATH).encode(texts)
    assert got == [np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=120), st.integers(1, 6))
def test_best_fit_against_a_list_of_bins(lengths, most):
    bins, free, opened = packing.BestFit(64, most), {}, 0
    for n in lengths:
        fits = [f for f in free.values() if f >= n]
        found, offset = bins.place(n)
        if fits:
            assert free[found] == min(fits)
        else:
            if len(free) == most:
                fullest = min(free.values())
                closed = [b for b, f in free.items() if f == fullest]
                del free[closed[-1]]
            assert found == opened
            opened, free[found] = opened + 1, 64
        assert offset == 64 - free[found]
        free[found] -= n
        if not free[found]:
            del free[found]
        assert sorted(free.values()) == sorted(f for f, b in enumerate(bins.bins) for _ in b)
        free = {b: f for f, own in enumerate(bins.bins) for b in own}


def test_pack(spark, make_docs, plain):
    texts = {1: "a b c", 2: None, 3: "", 4: "word " * 3000, 5: "x " * 1023, 6: "é\n" * 40, None: "no id"}
    rows = [*texts.items(), (1, "a b c")]
    out = packing.pack(make_docs(rows), PATH, pieces_per_task=4).collect()
    by_doc, by_sequence = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(by_doc[1]) == 2
    for doc_id, text in texts.items():
        ids, at = [*plain(text or ""), 2], 0
        pieces = sorted(by_doc[doc_id], key=lambda r: r.piece)[: 1 if doc_id == 1 else None]
        assert len(pieces) == -(-len(ids) // 1024)
        for k, p in enumerate(pieces):
            own = np.array(ids[p.start : p.start + p.length], "<u4").tobytes()
            assert (p.piece, p.start, p.ids_crc32) == (k, at, zlib.crc32(own))
            assert p.length == 1024 or k == 0
            at += p.length
        assert at == len(ids)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(make_docs([]), PATH).count() == 0


def test_both_encoders_give_the_same_ids(plain):
    """The fast encoder is in use, and equal to the tokenizer over all characters it is given and on long runs."""
    encoder = packing.token_bytes(PATH)
    assert encoder.fast is not None
    safe = [c for c in map(chr, range(0x250)) if not packing._OTHERS.search(c)]
    texts = [p.format(c=c) for c in safe for p in ("{c}", "a{c}b", " {c} x", "1{c}{c}2", "{c}\n {c}")] + ["a" * 30_000, " " * 30_000, "!?" * 9_000]
    assert [encoder.fast(t) for t in texts] == [plain(t) for t in texts]
    long = "word  and\n" * 50_000
    assert len(long) > packing.LONG and encoder.encode([long]) == [np.array(plain(long), "<u4").tobytes()]
