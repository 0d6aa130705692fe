"""Byte-exact removal of repeated passages by a distributed suffix array.

A byte goes if a string of ``WIDTH`` bytes that covers it also starts in a
document with a smaller id. Only suffixes that can share such a string are
sorted: each window of ``WIDTH`` bytes names as its anchor the k-gram of least
hash inside it, equal windows name equal anchors, and only windows whose
anchor stands in several documents go on. Windows around one anchor travel as
one context.

In a bucket a window whose 64-bit hash no other has is equal to none and leaves.
The suffixes at the others are ordered by deep-shallow sorting: multikey
quicksort on 8-byte characters, in which groups equal so far go on to the next
character, down to a shallow depth; groups that are still tied there (long
common prefixes) become blind tries, which find the character where a group
first branches, split it there, and never look at the characters in between.

Documents are dealt to parts of bounded size. An anchor with very many
different contexts (the edge of a passage found everywhere) has its windows
dealt by their own content, so no bucket collects all surroundings of a
frequent passage; whichever way a window goes, the result is the same.
A part's runs and contexts are found once: its contexts go to their buckets, its
runs travel beside them and come back with the buckets' answers, one bit for
each window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import parts_for, text_or_empty

WIDTH = 50
GRAM = 20
LEAD = WIDTH - GRAM          # bytes before an anchor that a window may reach
SPAN = LEAD + WIDTH          # bytes of a context
RECORD = SPAN + 2            # and its first and last window
CHARACTER = 8
SHALLOW = 2                  # characters of the multikey sort
CHARACTERS = -(-WIDTH // CHARACTER)
PART_BYTES = 8 * 1024 * 1024
BUCKET_BYTES = 8 * 1024 * 1024
LEAST_PARTS = 16
CHUNK_BYTES = 1 << 17         # hashed at a time: its arrays stay in a processor's cache
HOT_CONTEXTS = 1000          # contexts beyond one a part from which an anchor's windows are dealt singly
RECORDS_AT_ONCE = 8192
MOST_TOLD = 127              # contexts a part counts of one anchor; more are told as so many
NO_ID = np.iinfo(np.int64).max
_C = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], np.uint64)
_LOW, _HIGH = np.uint64(0xFFFFFFFF), np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _C[1]
    x = (x ^ (x >> np.uint64(27))) * _C[2]
    return x ^ (x >> np.uint64(31))


def _words(a: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as one integer (positions near the end left out)."""
    x = a.astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] | (x[step:] << np.uint64(8 * step))
    return x


def anchors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window start the place of its anchor, and every place's k-gram hash.

    The anchor is the leftmost k-gram of least (32-bit) hash in the window.
    """
    w = _words(a)
    n = len(a) - GRAM + 1
    h = mix(w[:n] * _C[0] + w[CHARACTER : CHARACTER + n] * _C[2] + w[GRAM - CHARACTER : GRAM - CHARACTER + n] * _C[3])
    key = (h & ~_LOW) | np.arange(n, dtype=np.uint64)
    size, least = 1, key
    while 2 * size <= LEAD + 1:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = LEAD + 1 - size
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    return (least & _LOW).astype(np.int64), h


class Part:
    """Documents of a part as one byte string, and the runs of windows with a common anchor."""

    def __init__(self, ids: list[int | None], texts: list[str | None], buckets: int) -> None:
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.ids = np.array([NO_ID if i is None else i for i in ids], np.int64)
        self.sizes = np.array([len(r) for r in raw], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        found = []
        at = 0
        while at < len(raw):
            upto = max(at + 1, int(np.searchsorted(self.offsets, self.offsets[at] + CHUNK_BYTES, "right")) - 1)
            found.append(self._runs(at, upto))
            at = upto
        first, last, place, code, doc, around = map(np.concatenate, zip(*found, strict=True)) if found else [
            np.zeros(0, np.int64)] * 6
        self.first, self.last, self.place, self.doc = first, last, place, doc
        self.around = around.astype(np.uint64)  # a hash of the context
        code = code.astype(np.uint64)
        # bucket in the upper half, 32 hash bits in the lower
        self.code = ((code >> _HIGH) % np.uint64(buckets) << _HIGH) | (code & _LOW)

    def _runs(self, at: int, upto: int) -> tuple[np.ndarray, ...]:
        base = self.offsets[at]
        a = self.bytes[base : self.offsets[upto]]
        if len(a) < WIDTH:
            return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.int64, np.uint64))
        place, h = anchors(a)
        counts = np.maximum(self.sizes[at:upto] - WIDTH + 1, 0)
        doc = np.repeat(np.arange(at, upto), counts)
        inside = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = self.offsets[doc] - base + inside
        place = place[start]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 0) | (np.diff(start) != 1)])) if len(start) else start
        end = np.concatenate([new[1:], [len(start)]]).astype(np.int64) - 1 if len(new) else new
        q, first, last = place[new], start[new], start[end]
        around = (last - first).astype(np.uint64)
        for edge in (first, last):  # k-grams that cover the first and the last window
            for step in (0, (WIDTH - GRAM) // 2, WIDTH - GRAM):
                around = mix(around * _C[0] ^ h[edge + step])
        return first + base, last + base, q + base, mix(h[q] ^ _C[3]), doc[new], around

    def codes(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchor codes, ascending, and a byte for each.

        The byte holds how many contexts the anchor has here (``MOST_TOLD`` or
        more), with the top bit set if several documents hold it.
        """
        if not len(self.code):
            return self.code, np.zeros(0, np.uint8)
        order = np.argsort(self.code)
        code, ids = self.code[order], self.ids[self.doc][order]
        new = np.concatenate([[True], code[1:] != code[:-1]])
        cut = np.flatnonzero(new)
        several = np.minimum.reduceat(ids, cut) != np.maximum.reduceat(ids, cut)
        # contexts differ only where a code stands more than once
        contexts = np.ones(len(cut), np.int64)
        group = np.cumsum(new) - 1
        again = np.flatnonzero(np.diff(np.append(cut, len(code)))[group] > 1)
        if len(again):
            around, group = self.around[order[again]], group[again]
            inner = np.lexsort((around, group))
            around, group = around[inner], group[inner]
            fresh = (around[1:] != around[:-1]) & (group[1:] == group[:-1])
            contexts += np.bincount(group[1:][fresh], minlength=len(cut))
        return code[cut], (np.minimum(contexts, MOST_TOLD) | several.astype(np.int64) << 7).astype(np.uint8)

    def contexts(self, shared: np.ndarray, hot: np.ndarray, buckets: int) -> Contexts:
        return Contexts(self, shared, hot, buckets)


class Contexts:
    """Distinct contexts of a part's shared anchors; windows of hot anchors one by one.

    Beside them the runs of windows they come from: how many a record has, their first starts.
    """

    def __init__(self, part: Part, shared: np.ndarray, hot: np.ndarray, buckets: int) -> None:
        def among(codes: np.ndarray) -> np.ndarray:
            at = np.minimum(np.searchsorted(codes, part.code), max(len(codes) - 1, 0))
            return codes[at] == part.code if len(codes) else np.zeros(len(part.code), bool)

        is_hot = among(hot)
        plain = np.flatnonzero(among(shared) & ~is_hot)
        heated = np.flatnonzero(is_hot)
        counts = part.last[heated] - part.first[heated] + 1
        single = np.repeat(part.first[heated], counts) + np.arange(counts.sum()) - np.repeat(
            np.cumsum(counts) - counts, counts)
        begin = np.concatenate([part.place[plain] - LEAD, single])
        first = np.concatenate([part.first[plain], single])
        last = np.concatenate([part.last[plain], single])
        doc = np.concatenate([part.doc[plain], np.repeat(part.doc[heated], counts)])
        records = np.zeros((len(begin), RECORD), np.uint8)
        steps = np.arange(SPAN)
        for at in range(0, len(begin), 16384):
            cut = slice(at, at + 16384)
            where = begin[cut, None] + steps
            used = (where >= first[cut, None]) & (where < last[cut, None] + WIDTH)
            records[cut, :SPAN] = np.where(used, part.bytes[np.clip(where, 0, max(len(part.bytes) - 1, 0))], 0)
        records[:, SPAN], records[:, SPAN + 1] = first - begin, last - begin
        bucket = np.concatenate([mix(part.code[plain] * _C[0]), mix((_characters(records[len(plain):, :WIDTH]) * _ODD).sum(
            axis=1, dtype=np.uint64))]) % np.uint64(buckets)
        # by bucket and hash; equal neighbours are one record
        keys = _record_keys(records)
        digest = mix((keys * _RECORD_ODD).sum(axis=1, dtype=np.uint64)) >> np.uint64(24)
        order = np.argsort(bucket << np.uint64(40) | digest, kind="stable")
        keys, bucket = keys[order], bucket[order]
        new = np.ones(len(order), bool)
        new[1:] = (keys[1:] != keys[:-1]).any(axis=1) | (bucket[1:] != bucket[:-1])
        cut = np.flatnonzero(new)
        self.records = records[order][cut]
        self.bucket = bucket[cut].astype(np.int64)
        own = part.ids[doc]
        self.least = np.minimum.reduceat(own[order], cut) if len(cut) else np.zeros(0, np.int64)
        # runs follow by record; a run has its record's windows, which all go if the record
        # also stands in a document of this part with a smaller id
        self.first = first[order]
        self.runs = np.diff(np.append(cut, len(order)))
        self.later = np.repeat(self.least, self.runs) < own[order]


def window_counts(records: np.ndarray) -> np.ndarray:
    """How many windows each record has."""
    return records[:, SPAN + 1].astype(np.int64) - records[:, SPAN] + 1


def _odd(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, count, np.uint64) * np.uint64(2) + np.uint64(1)


_ODD, _RECORD_ODD = _odd(CHARACTERS, 5), _odd(-(-RECORD // CHARACTER), 6)
_BASE = _C[0]
_BASE_WIDTH = np.uint64(pow(int(_BASE), WIDTH, 2**64))


def _characters(rows: np.ndarray) -> np.ndarray:
    """Rows of WIDTH bytes as big-endian 8-byte characters, padded with zeros."""
    padded = np.zeros((len(rows), CHARACTERS * CHARACTER), np.uint8)
    padded[:, : rows.shape[1]] = rows
    return padded.view(">u8").astype(np.uint64)


def _record_keys(records: np.ndarray) -> np.ndarray:
    padded = np.zeros((len(records), -(-RECORD // 8) * 8), np.uint8)
    padded[:, :RECORD] = records
    return padded.view(">u8").astype(np.uint64)


def _split(order: np.ndarray, group: np.ndarray, at: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Sort the places ``at`` of ``order`` by ``value`` within their groups; the new group number of every place.

    Groups are numbered in order, so members of one stay together.
    """
    rank = np.unique(value, return_inverse=True)[1]
    inner = np.argsort(group[at] * np.int64(len(at) + 1) + rank, kind="quicksort")
    order[at], rank = order[at][inner], rank[inner]
    new = np.concatenate([[True], group[1:] != group[:-1]]) if len(group) else np.zeros(0, bool)
    new[at[1:]] |= (np.diff(rank) != 0) & (group[at][1:] == group[at][:-1])
    return np.cumsum(new) - 1


def multikey_quicksort(characters: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by their first ``depth`` characters, and the group of equal ones of each place.

    Character by character: one quicksort partitions every group by it, and
    what is equal goes on to the next; a row alone in its group is done.
    """
    n = len(characters)
    order, group = np.arange(n), np.zeros(n, np.int64)
    for c in range(depth):
        size = np.bincount(group, minlength=1)
        at = np.flatnonzero(size[group] > 1)
        if not len(at):
            break
        group = _split(order, group, at, characters[order[at], c])
    return order, group


def blind_tries(characters: np.ndarray, order: np.ndarray, group: np.ndarray, depth: int) -> np.ndarray:
    """Order the rows of every group that are equal up to ``depth``; the final groups of equal rows.

    All tries grow together, a level a round: a node is a group and the
    character at which it first branches (where some row first differs from
    the group's head), its children are the rows by that character. A group
    without a branch is a leaf of equal rows.
    """
    width = characters.shape[1]
    known = np.full(int(group[-1]) + 1 if len(group) else 0, depth)  # characters a group's rows share
    while True:
        size = np.bincount(group, minlength=1)
        at = np.flatnonzero((size[group] > 1) & (known[group] < width)) if len(group) else group
        if not len(at):
            return group
        heads = np.concatenate([[0], np.cumsum(size)[:-1]])
        least = int(known[group[at]].min())
        differs = characters[order[at], least:] != characters[order[heads[group[at]]], least:]
        branch = np.where(differs.any(axis=1), differs.argmax(axis=1) + least, width)
        node = np.full(len(size), width)
        np.minimum.at(node, group[at], branch)
        known = node
        parting = at[node[group[at]] < width]
        if not len(parting):
            return group
        before = group
        group = _split(order, group, parting, characters[order[parting], node[group[parting]]])
        first = np.concatenate([[True], group[1:] != group[:-1]])
        known = np.minimum(node[before[first]] + 1, width)


def sort_suffixes(characters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of suffixes and, in that order, the group of equal ones each belongs to.

    ``characters`` has a row of big-endian characters for each suffix.
    """
    depth = min(SHALLOW, characters.shape[1])
    order, group = multikey_quicksort(characters, depth)
    return order, blind_tries(characters, order, group, depth)


def _window_hashes(records: np.ndarray) -> np.ndarray:
    """[record, start] hash of the window at each start."""
    sums = np.zeros((SPAN + 1, len(records)), np.uint64)
    columns = np.ascontiguousarray(records[:, :SPAN].T).astype(np.uint64) + np.uint64(1)
    for k in range(SPAN):
        sums[k + 1] = sums[k] * _BASE + columns[k]
    return (sums[WIDTH:] - sums[:-WIDTH] * _BASE_WIDTH).T


def _blocks(row: np.ndarray, records: int) -> Iterator[tuple[int, slice]]:
    """Ascending record numbers in blocks of records: (first record, its places in ``row``)."""
    for c in range(0, records, RECORDS_AT_ONCE):
        a, b = np.searchsorted(row, [c, c + RECORDS_AT_ONCE])
        yield c, slice(int(a), int(b))


def _suffixes(records: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Characters of the windows at ``at`` in records ``row`` (ascending)."""
    out = np.empty((len(row), CHARACTERS), np.uint64)
    for c, cut in _blocks(row, len(records)):
        wide = np.zeros((min(RECORDS_AT_ONCE, len(records) - c), SPAN + 2 * CHARACTER), np.uint64)
        wide[:, :SPAN] = records[c : c + RECORDS_AT_ONCE, :SPAN]
        for step in (1, 2, 4):  # the bytes from each place on, big-endian
            wide = (wide[:, :-step] << np.uint64(8 * step)) | wide[:, step:]
        for k in range(CHARACTERS):
            out[cut, k] = wide[row[cut] - c, at[cut] + CHARACTER * k]
    out[:, -1] &= ~np.uint64(0) << np.uint64(8 * (CHARACTER * CHARACTERS - WIDTH))
    return out


def least_ids(records: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For every window of the records, in order, the least id of an equal window among them."""
    counts = window_counts(records)
    row = np.repeat(np.arange(len(records)), counts)
    at = np.repeat(records[:, SPAN].astype(np.int64), counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    out = ids[row]
    # a window whose hash stands alone is equal to no other
    hashes = np.empty(len(row), np.uint64)
    for c, cut in _blocks(row, len(records)):
        hashes[cut] = _window_hashes(records[c : c + RECORDS_AT_ONCE])[row[cut] - c, at[cut]]
    order = np.argsort(hashes)
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = hashes[order[1:]] == hashes[order[:-1]]
    again = np.sort(order[same[1:] | same[:-1]])
    del hashes, order, same
    if len(again):
        characters = _suffixes(records, row[again], at[again])
        order, group = sort_suffixes(characters)
        heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        found = np.empty(len(again), np.int64)
        found[order] = np.minimum.reduceat(out[again][order], heads)[group]
        out[again] = found
    return out


def _pieces(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    if not len(bucket):
        return
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    for a, b in zip(cuts, [*cuts[1:], len(bucket)], strict=True):
        yield int(bucket[a]), slice(a, b)


MESSAGE = "kind int, part long, bucket long, one binary, two binary"
_FIELDS = [("kind", pa.int32()), ("part", pa.int64()), ("bucket", pa.int64()), ("one", pa.binary()), ("two", pa.binary())]
ANSWER = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
SHARED, RECORDS, RUNS, FOUND = 1, 2, 3, 4


def _messages(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_FIELDS)
    return pa.table({name: pa.array(c, t) for (name, t), c in zip(_FIELDS, columns, strict=True)})


def _bits(mask: np.ndarray) -> bytes:
    return np.packbits(mask).tobytes()


def _mask(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def _in_order(rows: pa.Table) -> pa.Table:
    """A part's rows in one order wherever it is read: its runs name places in their bytes."""
    return rows.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _part_of(docs: pa.Table, buckets: int) -> Part:
    return Part(docs["doc_id"].to_pylist(), docs["text"].to_pylist(), buckets)


def _shared(part: Part, notes: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The part's shared codes and its hot ones, by the buckets' answers."""
    codes = np.unique(part.code)
    at = dict(_pieces((codes >> _HIGH).astype(np.int64)))
    shared, hot = np.zeros(len(codes), bool), np.zeros(len(codes), bool)
    for bucket, one, two in zip(*(notes[c].to_pylist() for c in ("bucket", "one", "two")), strict=True):
        cut = at[bucket]
        shared[cut], hot[cut] = _mask(one, cut.stop - cut.start), _mask(two, cut.stop - cut.start)
    return codes[shared], codes[hot]


def removed_bytes(size: int, windows: np.ndarray, runs: np.ndarray, first: np.ndarray, later: np.ndarray,
                  earlier: np.ndarray) -> np.ndarray:
    """True for every byte of a part of ``size`` bytes to remove.

    Records have ``windows`` windows and ``runs`` runs, which begin at
    ``first``. ``earlier`` goes through the records' windows: an equal one
    stands in a document with a smaller id than the record's least; ``later``
    goes through the runs and says the same of their records within the part.
    """
    cover = np.zeros(size + 1, np.int32)
    of_run = np.repeat(np.arange(len(runs)), runs)
    base = np.cumsum(windows) - windows
    for at in range(0, len(first), 65536):
        cut = slice(at, at + 65536)
        n = windows[of_run[cut]]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        gone = earlier[np.repeat(base[of_run[cut]], n) + step] | np.repeat(later[cut], n)
        start = (np.repeat(first[cut], n) + step)[gone]
        np.add.at(cover, start, 1)
        np.add.at(cover, start + WIDTH, -1)
    return np.cumsum(cover[:-1]) > 0


def dedup_passages(docs: DataFrame, part_bytes: int = PART_BYTES, bucket_bytes: int = BUCKET_BYTES,
                   hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs`` (``doc_id, text``).

    Texts are UTF-8 bytes (NULL: empty); matches never cross documents and are
    judged on the input. A missing id counts as larger than any other. Rows
    that repeat an id remove nothing from each other. Very long texts are read
    whole; of equal passages in one document none goes for the other. Other
    columns are ignored; an empty table gives no rows.
    """
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = parts_for(total, part_bytes, LEAST_PARTS)
    buckets = parts_for(total, bucket_bytes, LEAST_PARTS)
    # by the text too: rows without an id, or of one id, are not all in one part
    dealt = source.withColumn("part", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)))

    def tell_codes(key: tuple, rows: pa.Table) -> pa.Table:
        codes, held = _part_of(rows, buckets).codes()
        return _messages([(SHARED, key[0].as_py(), b, (codes[cut] & _LOW).astype(np.uint32).tobytes(), held[cut].tobytes())
                          for b, cut in _pieces((codes >> _HIGH).astype(np.int64))])

    def find_shared(key: tuple, notes: pa.Table) -> pa.Table:
        values = [np.frombuffer(v, np.uint32) for v in notes["one"].to_pylist()]
        held = np.frombuffer(b"".join(notes["two"].to_pylist()), np.uint8)
        distinct, back, parts_ = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
        shared = (parts_ > 1) | (np.bincount(back, weights=held >> 7, minlength=len(distinct)) > 0)
        hot = np.bincount(back, weights=(held & MOST_TOLD).astype(np.int64) - 1, minlength=len(distinct)) >= hot_contexts
        cuts = np.cumsum([len(v) for v in values])[:-1]
        return _messages([(SHARED, p, key[0].as_py(), _bits(s), _bits(h)) for p, s, h in zip(
            notes["part"].to_pylist(), np.split(shared[back], cuts), np.split(hot[back], cuts), strict=True)])

    def tell_contexts(rows: pa.Table, notes: pa.Table) -> pa.Table:
        if not rows.num_rows or not notes.num_rows:
            return _messages([])
        number = notes["part"][0].as_py()
        part = _part_of(_in_order(rows), buckets)
        found = part.contexts(*_shared(part, notes), buckets)
        of_records = window_counts(found.records).astype(np.uint8).tobytes() + found.runs.astype("<u4").tobytes()
        of_runs = found.first.astype("<u4").tobytes() + _bits(found.later)
        return _messages([(RECORDS, number, b, found.records[cut].tobytes(), found.least[cut].tobytes())
                          for b, cut in _pieces(found.bucket)]
                         + [(RUNS, number, -1 - number, of_records, of_runs)])

    def sort_bucket(key: tuple, notes: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:  # a part's runs, on their way back to it
            return notes
        sent = [np.frombuffer(r, np.uint8).reshape(-1, RECORD) for r in notes["one"].to_pylist()]
        records = np.concatenate(sent)
        ids = np.concatenate([np.frombuffer(i, np.int64) for i in notes["two"].to_pylist()])
        earlier = least_ids(records, ids) < np.repeat(ids, window_counts(records))
        cuts = np.cumsum([int(window_counts(r).sum()) for r in sent])[:-1]
        return _messages([(FOUND, p, key[0].as_py(), _bits(x), len(x).to_bytes(8, "little")) for p, x in zip(
            notes["part"].to_pylist(), np.split(earlier, cuts), strict=True)])

    def answer(rows: pa.Table, notes: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({n: pa.array([], t) for n, t in zip(
                ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), [*[pa.int64()] * 4, pa.string()], strict=True)})
        rows = _in_order(rows)
        raw = [t.encode("utf-8", "surrogatepass") for t in rows["text"].to_pylist()]
        edges = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        kind = notes["kind"].to_numpy()
        runs = notes.filter(pa.array(kind == RUNS))
        gone = np.zeros(edges[-1], bool)
        if runs.num_rows:
            of_records, of_runs = runs["one"][0].as_py(), runs["two"][0].as_py()
            n = len(of_records) // 5
            windows = np.frombuffer(of_records[:n], np.uint8).astype(np.int64)
            per_record = np.frombuffer(of_records[n:], "<u4").astype(np.int64)
            n = int(per_record.sum())
            first, later = np.frombuffer(of_runs[: 4 * n], "<u4").astype(np.int64), _mask(of_runs[4 * n :], n)
            heard = notes.filter(pa.array(kind == FOUND)).sort_by("bucket")
            earlier = np.concatenate([np.zeros(0, bool), *(
                _mask(x, int.from_bytes(n, "little")) for x, n in zip(heard["one"].to_pylist(), heard["two"].to_pylist(), strict=True))])
            gone = removed_bytes(int(edges[-1]), windows, per_record, first, later, earlier)
        out = []
        for text, a, b in zip(raw, edges[:-1], edges[1:], strict=True):
            mask = gone[a:b]
            removed = int(np.count_nonzero(mask))
            spans = int(np.count_nonzero(mask[1:] & ~mask[:-1]) + bool(mask[0])) if removed else 0
            kept = np.frombuffer(text, np.uint8)[~mask].tobytes() if removed else text
            out.append((int(b - a), removed, spans, hashlib.sha256(kept).hexdigest()))
        sizes, removed, spans, digests = zip(*out, strict=True)
        return pa.table({"doc_id": rows["doc_id"], "n_bytes": pa.array(sizes, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                         "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(digests, pa.string())})

    codes = dealt.groupBy("part").applyInArrow(tell_codes, MESSAGE)
    shared = codes.groupBy("bucket").applyInArrow(find_shared, MESSAGE)
    contexts = dealt.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(tell_contexts, MESSAGE)
    heard = contexts.groupBy("bucket").applyInArrow(sort_bucket, MESSAGE)
    return dealt.groupBy("part").cogroup(heard.groupBy("part")).applyInArrow(answer, ANSWER)
