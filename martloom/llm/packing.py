"""Best-fit packing of tokenised documents into fixed-length sequences.

Bounded-space online best-fit: a fixed number of open bins, found through a
bitset keyed by free space (bit f is set while a bin with f free tokens is
open). A piece goes to the open bin with the least sufficient space; where
none fits and all bins are open, the fullest closes first.

Documents are tokenised where they are read. A document longer than a sequence
is cut into full pieces and one shorter leading piece; only pieces shorter
than a sequence are packed, as slim rows without their tokens, spread over
tasks that each hold a bounded number of them.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import checkpointed, parts_for

CAPACITY = 1024
END = 2
OPEN_BINS = 256
PIECES_PER_TASK = 20_000
TEXTS_AT_ONCE = 256
LONG = 400_000   # characters; of the two encoders, which give equal ids, longer texts go to the slower
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"
# Characters that every Unicode version classes alike as letters, digits, white space or others; texts
# with any other go to the tokenizer itself.
_OTHERS = re.compile("[^\t\n\r\x20-\x7e\u00a1-\u024f]")


def byte_values() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable bytes
    are written as themselves, the others, in order, as the characters from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class TokenBytes:
    """Texts -> their ids as little-endian unsigned 32-bit integers.

    Ids are those of the ``tokenizers`` file at ``path``. Where the file is a
    plain byte-level BPE whose ids follow its merges, the same vocabulary as
    ranks gives the same ids faster through ``tiktoken``; texts that hold
    characters outside the classes both agree on, or are very long, are encoded by the
    tokenizer.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path, encoding="utf-8") as file:
            self.fast = self._ranked(json.load(file))

    @staticmethod
    def _ranked(spec: dict):
        """The same encoder from ranks, None unless the file is known to be equal to one."""
        import tiktoken

        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (model["type"] == "BPE" and spec.get("normalizer") is None and spec.get("post_processor") is None
                 and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
                 and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                                    "fuse_unk", "byte_fallback", "ignore_merges")))
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        if not plain or any(model["vocab"].get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
            return None
        byte_of, special = byte_values(), {t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if i not in special}
        # fixed value: the pattern by which byte-level vocabularies of this kind split a text
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, texts: list[str]) -> list[bytes]:
        slow = [i for i, t in enumerate(texts) if self.fast is None or len(t) > LONG or _OTHERS.search(t)]
        whole = dict(zip(slow, self.tokenizer.encode_batch_fast([texts[i] for i in slow], add_special_tokens=False), strict=True))
        return [_packed(whole[i].ids if i in whole else self.fast(t)) for i, t in enumerate(texts)]


def _packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder != "little":
        out.byteswap()
    return out.tobytes()


@lru_cache(maxsize=2)
def token_bytes(path: str) -> TokenBytes:
    return TokenBytes(path)


def pieces_of(doc_id: int | None, ids: bytes, capacity: int = CAPACITY) -> Iterator[tuple]:
    """Pieces of one document; the first is the shorter one."""
    n = len(ids) // 4
    first = n % capacity or min(n, capacity)
    at, piece, length = 0, 0, first
    while at < n:
        yield doc_id, piece, at, length, zlib.crc32(ids[4 * at : 4 * (at + length)])
        at, piece, length = at + length, piece + 1, capacity


class BestFit:
    """Open bins by free space; ``place`` returns (bin, offset) of a piece."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> None:
        self.capacity, self.open_bins = capacity, open_bins
        self.bits = 0
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.count = self.opened = 0

    def _drop(self, free: int) -> int:
        found = self.bins[free].pop()
        if not self.bins[free]:
            self.bits &= ~(1 << free)
        self.count -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        enough = self.bits >> length
        if enough:
            free = length + (enough & -enough).bit_length() - 1
            found = self._drop(free)
        else:
            if self.count == self.open_bins:
                self._drop((self.bits & -self.bits).bit_length() - 1)
            found, free = self.opened, self.capacity
            self.opened += 1
        left = free - length
        if left:
            self.bins[left].append(found)
            self.bits |= 1 << left
            self.count += 1
        return found, self.capacity - free


def tokenised_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    tail = np.array([end], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = token_bytes(tokenizer)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            texts = batch.column("text").to_pylist()
            for at in range(0, len(ids), TEXTS_AT_ONCE):
                encoded = encoder.encode([t or "" for t in texts[at : at + TEXTS_AT_ONCE]])
                rows = [p for d, e in zip(ids[at : at + TEXTS_AT_ONCE], encoded, strict=True) for p in pieces_of(d, e + tail, capacity)]
                columns = zip(*rows, strict=True)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (
                    pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
         pieces_per_task: int = PIECES_PER_TASK, end: int = END) -> DataFrame:
    """Pieces of all documents with their sequence and place in it.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. NULL or
    empty texts are the end id alone; very long texts are encoded whole and cut
    into full pieces; pieces of one length go where the order of their hashes
    puts them. NULL ids and repeated rows are documents
    of their own. An empty table gives no rows. Sequence ids are unique, not
    consecutive: even ones hold a full piece each, odd ones are packed.
    """
    pieces = checkpointed(tokenised_pieces(docs, tokenizer, capacity, end))
    full = pieces.filter(F.col("length") == capacity).select(
        "*", (2 * F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    short = pieces.filter(F.col("length") < capacity)
    tasks = parts_for(short.count(), pieces_per_task)

    def fill(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("mixed", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")])
        bins = BestFit(capacity, open_bins)
        placed = [bins.place(n) for n in rows["length"].to_pylist()]
        base = key[0].as_py() << 33
        out = rows.drop_columns(["mixed", "task"])
        out = out.append_column("sequence_id", pa.array([2 * (base + b) + 1 for b, _ in placed], pa.int64()))
        return out.append_column("offset", pa.array([o for _, o in placed], pa.int64()))

    mixed = F.xxhash64("doc_id", "piece", "ids_crc32")
    packed = short.withColumn("mixed", mixed).withColumn("task", F.pmod("mixed", F.lit(tasks))).groupBy(
        "task").applyInArrow(fill, PACKED)
    return full.unionByName(packed)
