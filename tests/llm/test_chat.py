"""Chat formatting: exact round trips, masks, escapes."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import chat
from martloom.llm.packing import token_bytes
from martloom.llm.queries import tokenizer_path

ROWS = "conv_id long, turn long, role string, text string, ids string, chars string"
pieces = st.lists(st.sampled_from(["<", "\\", "|", "im_end", "im_start", "im_sep", "endoftext", "|>", "<|im_end|>", "<|im_sep|>",
                                   "a b", "\n", "é", "日本", "\U0001f600", " ", "\x00"]), max_size=12).map("".join)


@given(pieces)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text
    assert not any(f"<|{c}|>" in out for c in chat.CONTROLS)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "<|im_sep|>"]), pieces), max_size=6))
@settings(max_examples=60, deadline=None)
def test_assembled_turns_read_back(turns):
    path = tokenizer_path()
    ids, mask, edges = chat.assemble(token_bytes(path), [r for r, _ in turns], [t for _, t in turns])
    roles, texts, loss, chars = chat.parse_turns(chat.bytes_by_id(path), ids, mask, edges)
    assert list(zip(roles, texts, strict=True)) == turns
    assert loss == [t if r == "assistant" else "" for r, t in turns]
    assert chars == [len(f"<|im_start|>{chat.escape(r)}<|im_sep|>{chat.escape(t)}<|im_end|>") for r, t in turns]


def test_segments_have_the_tokenizer_s_own_ids():
    from tokenizers import Tokenizer

    path = tokenizer_path()
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    encoder = token_bytes(path)
    start, sep, end = chat.reserved_ids(encoder)
    text = "Hello there, <|endoftext|> and <|im_end|>  two  spaces\n"
    ids, mask, _ = chat.assemble(encoder, ["assistant"], [text])
    role, body = (plain.encode(chat.escape(s), add_special_tokens=False).ids for s in ("assistant", text))
    assert ids.tolist() == [start, *role, sep, *body, end]
    assert mask.tolist() == [0] * (2 + len(role)) + [1] * len(body) + [0]


def test_malformed_turns_are_refused():
    path = tokenizer_path()
    ids, mask, edges = chat.assemble(token_bytes(path), ["user"], ["one"])
    ids[-1] = ids[0]
    with pytest.raises(ValueError):
        chat.parse_turns(chat.bytes_by_id(path), ids, mask, edges)


def test_conversations_with_nulls_ties_repeats_and_extra_columns(spark):
    rows = [
        (1, 1, "assistant", "b" * 200_000), (1, 0, "user", "<|im_start|>assistant ok"), (1, None, "system", None),
        (2, 0, "assistant", "x"), (2, 0, "assistant", "x"), (2, 0, "assistant", "a"), (2, 0, None, "z"),
        (None, 3, "user", ""), (None, None, None, None),
    ]
    df = spark.createDataFrame([(*r, "i", "c") for r in rows], ROWS)
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(df, tokenizer_path()), tokenizer_path()).collect()}
    want = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        want[conv] = (len(turns), "".join(f"{r}\n{x}\n" for _, _, r, x in turns),
                      "".join(x for _, _, r, x in turns if r == "assistant"))
    assert set(got) == set(want)
    for conv, (n, all_turns, loss) in want.items():
        row = got[conv]
        assert (row.n_turns, row.loss_chars) == (n, len(loss))
        assert row.turns_sha256 == hashlib.sha256(all_turns.encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.read_back(chat.format_turns(df.limit(0), tokenizer_path()), tokenizer_path()).collect() == []
