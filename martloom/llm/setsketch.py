"""Near-duplicate documents by SetSketch registers.

A document's set of word shingles becomes ``REGISTERS`` small integers: for
each of as many hash functions the minimum of an exponential variable over the
set, on a logarithmic scale of base ``BASE`` and truncated to 16 bits. Sketches
of two sets merge by the larger register, and equal registers get likelier
with similarity, so bands of registers find candidates. A candidate's Jaccard
similarity is first estimated by maximum likelihood from how many registers
are larger, smaller and equal, then verified on the full sets.

Documents with equal sets are one class from the start. Classes that bands
join, directly or in a chain, form a neighbourhood; it is dealt in cells of two
blocks of bounded size, which compare their classes in arrays and emit only a
spanning forest of the verified links, so no group of copies is ever expanded
into rows of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import checkpointed, parts_for

SHINGLE = 5
LINK = 85                # per cent of the union that the intersection must reach
BANDS, ROWS = 35, 5      # a pair at 0.8 shares no band with probability below 1e-6
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, 65535
MARGIN = 0.16            # about five standard deviations of the estimate at the threshold
BLOCK = 512
CACHED_WORDS = 300_000
CELL = 512                 # classes in a block of a large neighbourhood
PACK = 1500                # classes of small neighbourhoods in a task's group
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def _odd(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, count, np.uint64) * np.uint64(2) + np.uint64(1)


_PLACES, _FACTORS, _TERMS, _BAND = _odd(SHINGLE, 1), _odd(REGISTERS, 2), _odd(REGISTERS, 3), _odd(ROWS, 4)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _WordHash()


def shingles_of(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles (A-Z lower-cased) of a whole text.

    A text with fewer words than a shingle is one shingle; without words the
    set is empty.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and ASCII white space
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    places = _PLACES if width == SHINGLE else _odd(width, 1)
    n = max(len(words) - width + 1, 1)
    total = np.full(n, min(len(words), width), np.uint64)
    for i in range(min(width, len(words))):
        total += hashes[i : i + n] * places[i]
    return np.unique(mix(total))


def registers_of(shingles: np.ndarray) -> np.ndarray:
    """The sketch of a non-empty set of 64-bit hashes."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), BLOCK):
        least = np.minimum(least, (shingles[at : at + BLOCK, None] * _FACTORS + _TERMS).min(axis=0))
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64 * (1 - 2.0**-52)) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def bands_of(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; ``registers`` is (sketches, REGISTERS)."""
    rows = registers.reshape(-1, BANDS, ROWS).astype(np.uint64)
    return mix((rows * _BAND).sum(axis=2, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX[0]).view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum likelihood Jaccard similarity of pairs of sketches with known set sizes.

    A register of the first set is the larger with probability
    ``p(u - v J)`` and the smaller with ``p(v - u J)``, for the shares u and v
    of the sizes and ``p(x) = -log_b(1 - x (b - 1) / b)``.
    """
    larger, smaller = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    equal = REGISTERS - larger - smaller
    u = (size_a / (size_a + size_b))[:, None]
    v = 1 - u
    grid = np.linspace(0, 1, 101)[None, :] * np.minimum(u / v, v / u)

    def p(x: np.ndarray) -> np.ndarray:
        return np.clip(-np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE), 1e-9, 1 - 1e-9)

    up, down = p(u - v * grid), p(v - u * grid)
    fit = larger * np.log(up) + smaller * np.log(down) + equal * np.log(np.clip(1 - up - down, 1e-9, 1))
    return np.take_along_axis(grid, fit.argmax(axis=1)[:, None], axis=1)[:, 0]


def sketched(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, n_shingles, node, registers``.

    ``mark`` is a hash of the text, ``node`` the class of equal sets, NULL for an empty set.
    """
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, regs = [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles_of(text)
                sizes.append(len(s))
                nodes.append(xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63 if len(s) else None)
                regs.append(registers_of(s).tobytes() if len(s) else None)
            yield pa.record_batch([batch.column("doc_id"), batch.column("mark"), pa.array(sizes, pa.int64()),
                                   pa.array(nodes, pa.int64()), pa.array(regs, pa.binary())],
                                  names=["doc_id", "mark", "n_shingles", "node", "registers"])

    return _marked(docs).mapInArrow(sketch, "doc_id long, mark long, n_shingles long, node long, registers binary")


def _marked(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")


def band_members(classes: DataFrame) -> DataFrame:
    """``band, node, n_shingles`` for bands that at least two classes share."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            regs = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
            yield pa.record_batch([pa.array(bands_of(regs).ravel()),
                                   pa.array(np.repeat(batch.column("node").to_numpy(), BANDS)),
                                   pa.array(np.repeat(batch.column("n_shingles").to_numpy(), BANDS))],
                                  names=["band", "node", "n_shingles"])

    rows = classes.select("node", "n_shingles", "registers").mapInArrow(keys, "band long, node long, n_shingles long")
    shared = rows.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("band")
    return rows.join(shared, "band")


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def verified_links(a: list[np.ndarray], b: list[np.ndarray], candidates: np.ndarray, link: int = LINK) -> np.ndarray:
    """Which candidate pairs (a matrix) are linked on their full sets.

    Intersections come from an index of the second list: a set's shingles are
    looked up and their postings counted.
    """
    size_b = np.array([len(x) for x in b])
    owner = np.repeat(np.arange(len(b)), size_b)
    flat = np.concatenate(b)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    out = np.zeros(candidates.shape, bool)
    for i in np.flatnonzero(candidates.any(axis=1)):
        low, high = np.searchsorted(flat, a[i]), np.searchsorted(flat, a[i], "right")
        shared = np.bincount(owner[_ranges(low, high - low)], minlength=len(b))
        out[i] = candidates[i] & (shared > 0) & (100 * shared >= link * (len(a[i]) + size_b - shared))
    return out


def candidate_pairs(regs_a: np.ndarray, regs_b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray,
                    link: int = LINK) -> np.ndarray:
    """Pairs that share a band, whose sizes allow a link, and whose estimated
    similarity is not clearly below the threshold."""
    small, large = np.minimum.outer(size_a, size_b), np.maximum.outer(size_a, size_b)
    out = 100 * small >= link * large
    keys_a, keys_b = bands_of(regs_a), bands_of(regs_b)
    share = np.zeros(out.shape, bool)
    for band in range(BANDS):
        share |= keys_a[:, band, None] == keys_b[None, :, band]
    i, j = np.nonzero(out & share)
    for at in range(0, len(i), 8192):
        x, y = i[at : at + 8192], j[at : at + 8192]
        good = estimate(regs_a[x], regs_b[y], size_a[x], size_b[y]) >= link / 100 - MARGIN
        out[x, y] = good
    return out & share


def forest(pairs: np.ndarray, n: int) -> list[tuple[int, int]]:
    """A spanning forest of the graph of ``pairs`` (rows of two numbers below ``n``)."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for x, y in pairs.tolist():
        p, q = find(x), find(y)
        if p != q:
            root[q] = p
            kept.append((x, y))
    return kept


def cell_links(rows: pa.Table, link: int = LINK) -> pa.Table:
    """Links of a cell: between its two blocks, or inside each neighbourhood of a pack."""
    rows = rows.sort_by([("root", "ascending"), ("block", "ascending"), ("node", "ascending")])
    nodes, roots, blocks = (rows[c].to_numpy() for c in ("node", "root", "block"))
    sizes = rows["n_shingles"].to_numpy()
    regs = np.frombuffer(b"".join(rows["registers"].to_pylist()), np.uint16).reshape(-1, REGISTERS)
    texts = rows["text"].to_pylist()
    left, right = [], []
    for part in np.split(np.arange(len(nodes)), np.flatnonzero(np.diff(roots)) + 1):
        sets = [shingles_of(texts[i]) for i in part]
        first = part[blocks[part] == blocks[part[0]]]
        second = part[len(first):] if len(first) < len(part) else part
        inside = len(first) == len(part)
        found = candidate_pairs(regs[first], regs[second], sizes[first], sizes[second], link)
        if inside:
            found = np.triu(found, 1)
        if found.any():
            offset = second[0] - part[0]
            good = np.argwhere(verified_links(sets[: len(first)], sets[offset : offset + len(second)], found, link))
            for x, y in forest(good + [0, offset], len(part)):
                left.append(nodes[part[x]])
                right.append(nodes[part[y]])
    return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})


def contract(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``node, root`` after joining the roots of every edge ``a, b``.

    Each step hangs a root under its least neighbour, follows the parents once
    and replaces roots, until no edge crosses.
    """
    while True:
        crossing = edges.join(labels.toDF("a", "x"), "a").join(labels.toDF("b", "y"), "b").filter("x <> y")
        both = crossing.select(F.explode(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))).alias("e"))
        parent = checkpointed(both.groupBy("e.x").agg(F.min("e.y").alias("y")).select("x", F.least("x", "y").alias("parent")))
        if parent.isEmpty():
            return labels
        higher = parent.select(F.col("x").alias("parent"), F.col("parent").alias("higher"))
        up = parent.join(higher, "parent", "left").select(F.col("x").alias("root"), F.coalesce("higher", "parent").alias("up"))
        labels = checkpointed(labels.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")))


def components(classes: DataFrame, docs: DataFrame, link: int = LINK) -> DataFrame:
    """``node, root`` for every class (``node, n_shingles, registers, doc_id, mark``)
    that shares a band with another."""
    members = checkpointed(band_members(classes))
    alone = checkpointed(members.select("node", F.col("node").alias("root")).distinct())
    pivots = members.groupBy("band").agg(F.min("node").alias("b"))
    stars = members.join(pivots, "band").filter("node <> b").select(F.col("node").alias("a"), "b").distinct()
    near = contract(alone, checkpointed(stars))

    found = near.join(classes, "node")
    named = found.withColumnsRenamed({"doc_id": "own_id", "mark": "own_mark"})
    texts = _marked(docs).join(named, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("mark") == F.col("own_mark"))).select(
        "node", "root", "n_shingles", "registers", "text").dropDuplicates(["node"])  # equal rows of a representative
    counts = near.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    placed = texts.join(counts, "root").withColumn("blocks", F.ceil(F.col("n") / CELL)).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    packs = parts_for(alone.count(), PACK)
    # a neighbourhood of one block shares a pack with others; a block of a large one goes to a cell with each block
    small = placed.filter("blocks = 1").withColumn("cell", F.struct(
        F.lit(0).cast("bigint").alias("root"), F.pmod(F.xxhash64("root"), F.lit(packs)).alias("i"), F.lit(0).cast("bigint").alias("j")))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    large = placed.filter("blocks > 1").select("*", other).withColumn("cell", F.struct(
        F.col("root").alias("root"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
    cells = small.unionByName(large.drop("other")).drop("n", "blocks")
    links = cells.groupBy("cell").applyInArrow(lambda t: cell_links(t, link), "a long, b long")
    return contract(alone, checkpointed(links.distinct()))


def near_duplicates(docs: DataFrame, link: int = LINK) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, mark`` for every row of ``docs`` (``doc_id, text``).

    ``mark`` is the hash (xxhash64) of the row's text.

    Documents are linked where ``100 * intersection >= link * union`` of their
    shingle sets; a component's id is its smallest doc_id. Documents without
    words are linked with nothing. Rows that repeat a doc_id are answered by
    their own text. Rows without an id are linked like others and belong to the
    component of the ids they reach; a component without any id has the id NULL
    and keeps the rows of its least ``mark``. Texts are read whole. An empty table gives no rows.
    """
    sketches = checkpointed(sketched(docs))
    classes = checkpointed(sketches.filter("node IS NOT NULL").groupBy("node").agg(
        F.max("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"),
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")).alias("at")).select(
        "node", "n_shingles", "registers", "at.doc_id", "at.mark"))
    labels = components(classes, docs, link)
    rows = sketches.select("doc_id", "mark", "n_shingles", "node")
    known = rows.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = known.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"), F.min("mark").alias("least_mark"))
    out = known.join(least, "root", "left").withColumn("component_id", F.coalesce("least", "doc_id"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")) & (
        F.col("component_id").isNotNull() | F.coalesce(F.col("mark") == F.col("least_mark"), F.lit(True)))
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "mark")
