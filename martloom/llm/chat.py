"""Chat formatting by token-level assembly.

A turn becomes ``<|im_start|> role <|im_sep|> text <|im_end|>``. Role and text
are encoded separately and the three marks are spliced in as reserved ids above
the vocabulary, so no text, whatever it holds, can produce one. The loss mask
is the prefix sum of +1 where a learned text begins and -1 where it ends.

So that the rendered string is unambiguous too, a control string occurring in
a role or text gets one more backslash after its ``<`` (``<|im_end|>`` becomes
``<\\|im_end|>``, and that becomes ``<\\\\|im_end|>``); reading back takes one away.

Turns are formatted where they are read. Only the digests of
:func:`read_back` need a conversation's turns in order: its rows then stream
through one task, a batch at a time, as SHA-256 is one chain.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.packing import TokenBytes, byte_values, token_bytes

# Fixed values of the template.
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROLS = ("im_start", "im_sep", "im_end", "endoftext")
LEARNED = ("assistant",)

_NAMES = "|".join(CONTROLS)
_PLAIN = re.compile(rf"<(\\*)\|({_NAMES})\|>")
_ESCAPED = re.compile(rf"<\\(\\*)\|({_NAMES})\|>")
ROWS_AT_ONCE = 512

FORMATTED = "conv_id long, turn long, ids array<int>, loss_mask array<tinyint>"
TURNS = "conv_id long, turn long, role string, text string, loss string, chars long"
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")


def escape(text: str) -> str:
    return _PLAIN.sub(r"<\\\1|\2|>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|\2|>", text)


@lru_cache(maxsize=2)
def bytes_by_id(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary, the reserved marks after them."""
    tokenizer, byte_of = token_bytes(path).tokenizer, byte_values()
    tokens = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    return [bytes(byte_of.get(c, 63) for c in t) for t in tokens] + [m.encode() for m in (START, SEP, END)]


def reserved_ids(encoder: TokenBytes) -> tuple[int, int, int]:
    """Ids of turn start, separator and turn end: the first three above the vocabulary."""
    first = encoder.tokenizer.get_vocab_size()
    return first, first + 1, first + 2


def assemble(encoder: TokenBytes, roles: Sequence[str], texts: Sequence[str],
             learned: Sequence[str] = LEARNED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all turns one after the other, their loss mask, and where each turn begins (and the end)."""
    start, sep, end = (np.array([i], "<u4").tobytes() for i in reserved_ids(encoder))
    role_ids = encoder.encode([escape(r) for r in roles])
    text_ids = encoder.encode([escape(t) for t in texts])
    pieces = [p for r, t in zip(role_ids, text_ids, strict=True) for p in (start, r, sep, t, end)]
    ids = np.frombuffer(b"".join(pieces), "<u4").astype(np.int32)
    edges = np.concatenate([[0], np.cumsum([len(p) // 4 for p in pieces])]).astype(np.int64)
    steps = np.zeros(len(ids) + 1, np.int8)
    ours = np.flatnonzero([r in learned for r in roles])
    np.add.at(steps, edges[5 * ours + 3], 1)
    np.add.at(steps, edges[5 * ours + 4], -1)
    return ids, np.cumsum(steps[:-1], dtype=np.int8), edges[::5]


def format_turns(conversations: DataFrame, tokenizer: str, learned: Sequence[str] = LEARNED) -> DataFrame:
    """``conv_id, turn, ids, loss_mask`` of every row: the turn's token ids and,
    beside each, 1 where the loss counts (the texts of ``learned`` roles) else 0.

    Needs ``conv_id, turn, role, text``; other columns are ignored. NULL roles
    and texts are empty, NULL ids and turns are kept, repeated rows are turns
    of their own, long texts are encoded whole, an empty table gives no rows.
    """
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = token_bytes(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = batch.slice(at, ROWS_AT_ONCE)
                ids, mask, edges = assemble(encoder, rows.column("role").to_pylist(), rows.column("text").to_pylist(), learned)
                lists = [pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(v)) for v in (ids, mask)]
                yield pa.record_batch([rows.column("conv_id"), rows.column("turn"), *lists],
                                      names=["conv_id", "turn", "ids", "loss_mask"])

    slim = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                                F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return slim.mapInArrow(build, FORMATTED)


def parse_turns(vocabulary: list[bytes], ids: np.ndarray, mask: np.ndarray,
                edges: np.ndarray) -> tuple[list[str], list[str], list[str], list[int]]:
    """Roles, texts, texts under the mask (all unescaped) and rendered lengths of the turns between ``edges``."""
    start, sep, end = range(len(vocabulary) - 3, len(vocabulary))
    marks = np.flatnonzero(ids >= start)
    first, last = edges[:-1], edges[1:] - 1
    if len(marks) != 3 * len(first) or not (
            np.array_equal(marks[::3], first) and np.array_equal(marks[2::3], last)
            and np.array_equal(ids[marks], np.tile([start, sep, end], len(first)))):
        raise ValueError("a turn is not start, role, separator, text, end")
    pieces = [vocabulary[i] for i in ids.tolist()]
    places = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
    raw = b"".join(pieces)
    flips = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]])))
    under = [""] * len(first)
    for a, b in flips.reshape(-1, 2).tolist():
        under[int(np.searchsorted(first, a, "right")) - 1] += unescape(raw[places[a] : places[b]].decode())
    roles, texts, chars = [], [], []
    for a, b, c in marks.reshape(-1, 3).tolist():
        role, text = (raw[places[x + 1] : places[y]].decode() for x, y in ((a, b), (b, c)))
        roles.append(unescape(role))
        texts.append(unescape(text))
        chars.append(len(START) + len(role) + len(SEP) + len(text) + len(END))
    return roles, texts, under, chars


def read_turns(formatted: DataFrame, tokenizer: str) -> DataFrame:
    """``conv_id, turn, role, text, loss, chars`` read back from ids and masks:
    the original role and text, the text under the mask, the rendered length.
    A turn that is not well formed is an error."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = bytes_by_id(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = batch.slice(at, ROWS_AT_ONCE)
                lists = rows.column("ids")
                edges = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
                got = parse_turns(vocabulary, lists.flatten().to_numpy(), rows.column("loss_mask").flatten().to_numpy(), edges)
                columns = [pa.array(v, t) for v, t in zip(got, (pa.string(),) * 3 + (pa.int64(),), strict=True)]
                yield pa.record_batch([rows.column("conv_id"), rows.column("turn"), *columns],
                                      names=["conv_id", "turn", "role", "text", "loss", "chars"])

    return formatted.select("conv_id", "turn", "ids", "loss_mask").mapInArrow(parse, TURNS)


class Digest:
    """Running digests of one conversation."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, role: str, text: str, loss: str, chars: int) -> None:
        self.turns.update(f"{role}\n{text}\n".encode())
        self.loss.update(loss.encode())
        self.n_turns += 1
        self.loss_chars += len(loss)
        self.chars += chars

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def in_order(batches: Iterator[pa.RecordBatch], columns: Sequence[str], begin: Callable) -> Iterator[pa.RecordBatch]:
    """One row a conversation from rows sorted by conversation, with one running state at a time."""
    state, seen = None, False
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = [c.split()[0] for c in DIGESTS.split(", ")]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    for batch in batches:
        done = []
        for conv_id, *values in zip(batch.column("conv_id").to_pylist(), *(batch.column(c).to_pylist() for c in columns), strict=True):
            if not seen or conv_id != state.conv_id:
                if seen:
                    done.append(state.row())
                state, seen = begin(conv_id), True
            state.add(*values)
        if done:
            yield table(done)
    if seen:
        yield table([state.row()])


def read_back(formatted: DataFrame, tokenizer: str) -> DataFrame:
    """One row a conversation: turns, digests of them and of the text under the mask, rendered length.

    Turns follow by ``turn``, NULLs first; turns of one number by role, then
    text. Rows with a NULL ``conv_id`` are one conversation.
    """
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    turns = read_turns(formatted, tokenizer).repartition("conv_id").sortWithinPartitions("conv_id", *order)
    return turns.mapInArrow(lambda batches: in_order(batches, ("role", "text", "loss", "chars"), Digest), DIGESTS)
