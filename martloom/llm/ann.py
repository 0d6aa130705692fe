"""Approximate nearest neighbours: a neighbour graph by NN-descent, greedy graph search for queries.

Nodes live in blocks (by a hash of their id). A round of NN-descent is three
Spark joins of block messages: neighbours tell each other of the edge (reverse
lists), every node sends its vector to the nodes it neighbours, and there all
pairs of neighbours with a new edge are compared; better neighbours found go
back and are merged. Messages travel packed as arrays, one row per pair of
blocks. The graph starts from random-projection leaves.

Search expands, per query, the best nodes not yet expanded, until the best
``beam`` found are all expanded. Queries live in blocks and the graph in
regions; a hop is four joins of packed messages (nodes to expand, neighbours
back, candidates to their vectors, scores back), so neither vector is repeated
for each pair of a query and a candidate. Neighbours are by direction, nearness
is the inner product; so a search starts from the query's own node and from the
longest vectors, which any query may be near to.

A round or a hop moves many times the input. The files it was shuffled through
and the table before it are removed when its own table is stored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import parts_for
from martloom.session import remove_path, stored_table

NEIGHBOURS = 64
TREES = 4
LEAF = 128
LEAF_MOST = 512
PIECE = 4096             # vectors of a leaf in one group; a larger leaf (one direction) is dealt by blocks, other ones in every tree
BLOCK = 2048
ROUNDS = 16              # at most; a round with few changes ends the descent
FEW = 0.01               # share of edges that are new
PER_CENTRE = 10          # candidates a node takes from one centre
BEAM = 64
EXPANDED = 32            # of the beam in one hop
LONGEST = 256            # longest vectors a search also starts from
REGIONS = 64             # of the graph in a search, more where one would hold more than VALUES components
VALUES = 1 << 21         # vector components that a search's region, or its queries in one task, have at most
QUERIES = 512            # queries of a block
PAIRS = 4096             # scored at once
HUB = 512                # holders of one node compared together; more are dealt anew every round
_C = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def block_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    x = ids.astype(np.int64).view(np.uint64) * _C[0]
    x = (x ^ (x >> np.uint64(30))) * _C[1]
    x = (x ^ (x >> np.uint64(27))) * _C[2]
    return ((x ^ (x >> np.uint64(31))) % np.uint64(blocks)).astype(np.int64)


def usable(vector: Column) -> Column:
    """Not NULL, no NULL or non-finite component, not zero."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))) & F.exists(
        vector, lambda x: x != 0)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _stored(df: DataFrame, *spent: str) -> tuple[DataFrame, str]:
    """``df`` as a stored table and its path; the shuffle files of the job and the tables at ``spent`` are gone."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        out = stored_table(df)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    for path in spent:
        remove_path(df.sparkSession, path)
    return out


def _split(target: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Rows by target block."""
    order = np.argsort(target, kind="stable")
    cuts = np.flatnonzero(np.diff(target[order])) + 1
    for rows in np.split(order, cuts):
        if len(rows):
            yield int(target[rows[0]]), rows


def _table(fields: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.table({n: pa.array(c, t) for (n, t), c in zip(fields, columns, strict=True)})


def _joined(table: pa.Table, column: str, kind, width: int = 0) -> np.ndarray:
    out = np.frombuffer(b"".join(table[column].to_pylist()), kind)
    return out.reshape(-1, width) if width else out


def top_edges(src: np.ndarray, dst: np.ndarray, score: np.ndarray, fresh: np.ndarray, k: int) -> np.ndarray:
    """Rows of the ``k`` best distinct edges of each source; an old copy of an edge wins over a new one."""
    narrow = len(src) > 0 and min(src.min(), dst.min()) >= 0 and max(src.max(), dst.max()) < 1 << 31
    if narrow:  # the keys of a sort fit in one integer
        src, dst = src.astype(np.int64), dst.astype(np.int64)
        order = np.argsort(src << 32 | dst << 1 | (fresh != 0), kind="stable")
    else:
        order = np.lexsort((fresh, dst, src))
    same = np.zeros(len(order), bool)
    same[1:] = (src[order][1:] == src[order][:-1]) & (dst[order][1:] == dst[order][:-1])
    order = order[~same]
    if narrow and score.dtype == np.float32:
        bits = (0 - score[order]).view(np.uint32)
        bits = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31))
        order = order[np.argsort(src[order].astype(np.uint64) << np.uint64(32) | bits, kind="stable")]
    else:
        order = order[np.lexsort((dst[order], -score[order], src[order]))]
    heads = np.flatnonzero(np.concatenate([[True], np.diff(src[order]) != 0])) if len(order) else np.zeros(0, np.int64)
    place = np.arange(len(order)) - np.repeat(heads, np.diff(np.append(heads, len(order))))
    return order[place < k]


_STATE = "block long, dim int, ids binary, vectors binary, src binary, dst binary, score binary, fresh binary"
_STATE_FIELDS = [("block", pa.int64()), ("dim", pa.int32()), *((n, pa.binary()) for n in
                                                            ("ids", "vectors", "src", "dst", "score", "fresh"))]
_EDGES = "block long, src binary, dst binary, score binary"
_EDGE_FIELDS = [("block", pa.int64()), *((n, pa.binary()) for n in ("src", "dst", "score"))]
_NOTES = "block long, dim int, centre binary, member binary, fresh binary, worst binary, ids binary, vectors binary"
_NOTE_FIELDS = [("block", pa.int64()), ("dim", pa.int32()), *((n, pa.binary()) for n in
                                                           ("centre", "member", "fresh", "worst", "ids", "vectors"))]


class _Block:
    """A block's nodes and their edges."""

    def __init__(self, row: pa.Table) -> None:
        self.block, self.dim = row["block"][0].as_py(), row["dim"][0].as_py()
        self.ids = _joined(row, "ids", np.int64)
        self.vectors = _joined(row, "vectors", np.float16, self.dim)
        self.src, self.dst = _joined(row, "src", np.int64), _joined(row, "dst", np.int64)
        self.score, self.fresh = _joined(row, "score", np.float32), _joined(row, "fresh", np.uint8)

    def row(self, src: np.ndarray, dst: np.ndarray, score: np.ndarray, fresh: np.ndarray) -> pa.Table:
        return _table(_STATE_FIELDS, [(self.block, self.dim, self.ids.tobytes(), self.vectors.tobytes(), src.tobytes(),
                                       dst.tobytes(), score.tobytes(), fresh.tobytes())])


def _pack_nodes(key: tuple, rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("vec_id")
    ids = rows["vec_id"].to_numpy()
    ids, at = np.unique(ids, return_index=True)  # of rows that repeat an id one is a node
    lists = rows["embedding"].to_pylist()
    dim = max(len(v) for v in lists)
    x = np.zeros((len(ids), dim))
    for i, r in enumerate(at):
        x[i, : len(lists[r])] = lists[r]
    x /= np.abs(x).max(axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    none = b""
    return _table(_STATE_FIELDS, [(key[0].as_py(), dim, ids.tobytes(), x.astype(np.float16).tobytes(), none, none, none, none)])


def _leaves(depth: int, trees: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in range(batch.num_rows):
            block = _Block(pa.Table.from_batches([batch.slice(row, 1)]))
            for tree in range(trees):
                planes = np.random.default_rng(1000 + tree).standard_normal((block.dim, depth + 8)).astype(np.float32)
                signs = block.vectors.astype(np.float32) @ planes > 0
                code = (signs.astype(np.int64) << np.arange(depth + 8)[::-1]).sum(axis=1)
                for leaf, at in _split(code >> 8):
                    out.append((tree, leaf, block.block, block.dim, block.ids[at].tobytes(), block.vectors[at].tobytes(),
                                (code[at] & 255).astype(np.uint8).tobytes()))
        if out:
            yield _table([("tree", pa.int32()), ("leaf", pa.int64()), ("block", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()),
                          ("vectors", pa.binary()), ("code", pa.binary())], out).combine_chunks().to_batches()[0]


def _widened(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of rows that may differ in dimension."""
    dim = max(rows["dim"].to_pylist())
    parts = []
    for d, v in zip(rows["dim"].to_pylist(), rows["vectors"].to_pylist(), strict=True):
        x = np.frombuffer(v, np.float16).reshape(-1, d)
        parts.append(np.pad(x, ((0, 0), (0, dim - d))))
    return _joined(rows, "ids", np.int64), np.concatenate(parts)


def _edge_rows(src: np.ndarray, dst: np.ndarray, score: np.ndarray, blocks: int) -> pa.Table:
    return _table(_EDGE_FIELDS, [(b, src[at].tobytes(), dst[at].tobytes(), score[at].tobytes())
                                 for b, at in _split(block_of(src, blocks))])


def _leaf_edges(k: int, blocks: int, rows: pa.Table) -> pa.Table:
    ids, vectors = _widened(rows)
    order = np.lexsort((ids, _joined(rows, "code", np.uint8)))
    src, dst, score = [], [], []
    for at in range(0, len(order), LEAF_MOST):
        part = order[at : at + LEAF_MOST]
        if len(part) < 2:
            continue
        x = vectors[part].astype(np.float32)
        s = x @ x.T
        np.fill_diagonal(s, -np.inf)
        near = np.argpartition(-s, min(k, len(part) - 1) - 1, axis=1)[:, : min(k, len(part) - 1)]
        src.append(np.repeat(ids[part], near.shape[1]))
        dst.append(ids[part][near].ravel())
        score.append(np.take_along_axis(s, near, axis=1).ravel())
    if not src:
        return _table(_EDGE_FIELDS, [])
    return _edge_rows(np.concatenate(src), np.concatenate(dst), np.concatenate(score).astype(np.float32), blocks)


def _merge(k: int, state: pa.Table, found: pa.Table) -> pa.Table:
    if not state.num_rows:
        return _table(_STATE_FIELDS, [])
    block = _Block(state)
    src = np.concatenate([block.src, _joined(found, "src", np.int64)])
    dst = np.concatenate([block.dst, _joined(found, "dst", np.int64)])
    score = np.concatenate([block.score, _joined(found, "score", np.float32)])
    fresh = np.concatenate([np.zeros(len(block.src), np.uint8), np.ones(len(src) - len(block.src), np.uint8)])
    best = top_edges(src, dst, score, fresh, k)
    return block.row(src[best], dst[best], score[best], fresh[best])


def _reverse(blocks: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges told to the block of their end; the score column holds the new flag."""
    for batch in batches:
        for row in range(batch.num_rows):
            b = _Block(pa.Table.from_batches([batch.slice(row, 1)]))
            rows = [(t, b.dst[at].tobytes(), b.src[at].tobytes(), b.fresh[at].tobytes())
                    for t, at in _split(block_of(b.dst, blocks))]
            if rows:
                yield _table(_EDGE_FIELDS, rows).combine_chunks().to_batches()[0]


def _notes(k: int, blocks: int, state: pa.Table, told: pa.Table) -> pa.Table:
    """Every node of the block sends its vector to the nodes it neighbours, either way."""
    if not state.num_rows:
        return _table(_NOTE_FIELDS, [])
    b = _Block(state)
    member, centre, fresh = _joined(told, "src", np.int64), _joined(told, "dst", np.int64), _joined(told, "score", np.uint8)
    if len(member):  # of the nodes that hold this one as a neighbour at most k, new edges first
        kept = top_edges(member, centre, fresh + block_of(centre ^ member, 1 << 20) / float(1 << 21), np.zeros(len(member)), k)
        member, centre, fresh = member[kept], centre[kept], fresh[kept]
    src, dst, new = np.concatenate([b.src, member]), np.concatenate([b.dst, centre]), np.concatenate([b.fresh, fresh])
    best = top_edges(src, dst, new.astype(np.float32), 1 - new, 2 * k)
    src, dst, new = src[best], dst[best], new[best]
    worst = np.full(len(b.ids), -2, np.float32)
    held = np.zeros(len(b.ids), np.int64)
    at = np.searchsorted(b.ids, b.src)
    np.add.at(held, at, 1)
    low = np.full(len(b.ids), 2, np.float32)
    np.minimum.at(low, at, b.score)
    worst[held >= k] = low[held >= k]
    place = np.searchsorted(b.ids, src)
    rows = []
    for target, at in _split(block_of(dst, blocks)):
        sent, local = np.unique(place[at], return_inverse=True)
        rows.append((target, b.dim, dst[at].tobytes(), local.astype(np.int32).tobytes(), new[at].tobytes(),
                     worst[sent].tobytes(), b.ids[sent].tobytes(), b.vectors[sent].tobytes()))
    return _table(_NOTE_FIELDS, rows)


def _dealt(at: np.ndarray, round_: int) -> list[np.ndarray]:
    """A centre's members in groups of at most ``HUB``, other groups every round."""
    if len(at) <= HUB:
        return [at]
    at = np.random.default_rng(round_).permutation(at)
    return np.array_split(at, -(-len(at) // HUB))


def _compare(blocks: int, k: int, round_: int, notes: pa.Table) -> pa.Table:
    """All pairs of a centre's members with a new edge; better ones go to both ends."""
    ids, vectors = _widened(notes)
    vectors = vectors.astype(np.float32)
    worst, centre, fresh = _joined(notes, "worst", np.float32), _joined(notes, "centre", np.int64), _joined(notes, "fresh", np.uint8)
    counts = [len(x) // 8 for x in notes["ids"].to_pylist()]
    base = np.cumsum([0, *counts])
    member = np.concatenate([np.frombuffer(m, np.int32) + s for m, s in zip(notes["member"].to_pylist(), base, strict=False)])
    src, dst, score = [], [], []
    for at in (part for _, members in _split(centre) for part in _dealt(members, round_)):
        new = fresh[at].astype(bool)
        if not new.any() or len(at) < 2:
            continue
        m = member[at]
        s = vectors[m] @ vectors[m].T
        good = (new[:, None] | new) & (s > worst[m][:, None])
        np.fill_diagonal(good, False)
        s = np.where(good, s, -np.inf)
        if len(m) > PER_CENTRE:
            near = np.argpartition(-s, PER_CENTRE - 1, axis=1)[:, :PER_CENTRE]
        else:
            near = np.broadcast_to(np.arange(len(m)), s.shape)
        x, y = np.nonzero(np.isfinite(np.take_along_axis(s, near, axis=1)))
        src.append(m[x])
        dst.append(m[near[x, y]])
        score.append(s[x, near[x, y]])
    if not src:
        return _table(_EDGE_FIELDS, [])
    names, place = np.unique(ids, return_inverse=True)
    a, c, s = place[np.concatenate(src)], place[np.concatenate(dst)], np.concatenate(score).astype(np.float32)
    best = top_edges(a, c, s, np.zeros(len(a)), k)
    best = best[a[best] != c[best]]
    return _edge_rows(names[a[best]], names[c[best]], s[best], blocks)


def neighbour_graph(vectors: DataFrame, neighbours: int = NEIGHBOURS, block_rows: int = BLOCK, rounds: int = ROUNDS,
                    few: float = FEW) -> DataFrame:
    """``id, neighbours`` (ids, nearest first) by NN-descent on the directions of the vectors.

    ``vectors`` has ``vec_id`` and ``embedding``, all usable; shorter vectors
    are padded with zeros; of rows that repeat an id one is a node.
    """
    n = vectors.count()
    blocks, k = parts_for(n, block_rows), neighbours
    depth = max(int(np.ceil(np.log2(max(n, 1) / LEAF))), 0)
    key = F.col("block")

    def pack_nodes(key_: tuple, rows: pa.Table) -> pa.Table:
        return _pack_nodes(key_, rows)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("block", pa.array(block_of(batch.column("vec_id").to_numpy(), blocks)))

    def compared(round_: int):
        return lambda notes: _compare(blocks, k, round_, notes)

    state, at = _stored(vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(
        place, "vec_id long, embedding array<double>, block long").groupBy(key).applyInArrow(pack_nodes, _STATE))
    leaves = state.mapInArrow(lambda it: _leaves(depth, TREES, it),
                              "tree int, leaf long, block long, dim int, ids binary, vectors binary, code binary")
    sizes = leaves.groupBy("tree", "leaf").agg(F.sum(F.octet_length("ids") / 8).alias("n"))
    pieces = F.greatest(F.lit(1).cast("bigint"), F.ceil(F.col("n") / PIECE))
    leaves = leaves.join(sizes, ["tree", "leaf"]).withColumn("piece", F.pmod(F.xxhash64("block", "tree"), pieces)).drop("n", "block")
    edges = leaves.groupBy("tree", "leaf", "piece").applyInArrow(lambda t: _leaf_edges(k, blocks, t), _EDGES)
    state, at = _stored(state.groupBy(key).cogroup(edges.groupBy(key)).applyInArrow(lambda s, e: _merge(k, s, e), _STATE), at)
    for round_ in range(rounds):
        told = state.mapInArrow(lambda it: _reverse(blocks, it), _EDGES)
        notes = state.groupBy(key).cogroup(told.groupBy(key)).applyInArrow(lambda s, t: _notes(k, blocks, s, t), _NOTES)
        edges = notes.groupBy(key).applyInArrow(compared(round_), _EDGES)
        state, at = _stored(state.groupBy(key).cogroup(edges.groupBy(key)).applyInArrow(lambda s, e: _merge(k, s, e), _STATE), at)
        fresh, held = state.mapInArrow(_changes, "fresh long, held long").agg(F.sum("fresh"), F.sum("held")).first()
        if (fresh or 0) <= few * (held or 0):
            break
    return state.mapInArrow(_lists, "id long, neighbours array<long>")


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flags = [np.frombuffer(f, np.uint8) for f in batch.column("fresh").to_pylist()]
        yield pa.record_batch([pa.array([int(f.sum()) for f in flags], pa.int64()), pa.array([len(f) for f in flags], pa.int64())],
                              names=["fresh", "held"])


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            b = _Block(pa.Table.from_batches([batch.slice(row, 1)]))
            heads = np.searchsorted(b.src, b.ids)  # edges come by source, best first
            ends = np.searchsorted(b.src, b.ids, "right")
            yield pa.record_batch([pa.array(b.ids), pa.array([b.dst[x:y] for x, y in zip(heads, ends, strict=True)],
                                                             pa.list_(pa.int64()))], names=["id", "neighbours"])


_REGION = "region long, ids binary, vectors binary, ends binary, neighbours binary"
_ASKING = "block long, waiting int, ids binary, vectors binary, asker binary, node binary, score binary, done binary, go binary"
_TO_EXPAND = "region long, block long, asker binary, node binary"
_FOUND = "block long, asker binary, node binary"
_TO_SCORE = "region long, slice int, block long, askers binary, vectors binary, worst binary, asker binary, node binary"
_SCORED = "block long, asker binary, node binary, score binary"
_TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _rows(schema: str, rows: list[tuple]) -> pa.Table:
    return _table([(n, _TYPES[t]) for n, t in (c.split() for c in schema.split(", "))], rows)


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Lists of doubles as rows, zeros for what is missing."""
    lists = pa.concat_arrays(column.chunks)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
    values = pc.fill_null(lists.flatten(), 0.0).to_numpy()
    x = np.zeros((len(sizes), dim))
    x[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return x


def _packed(x: np.ndarray) -> bytes:
    """Components in four bytes where none loses by it."""
    with np.errstate(over="ignore"):
        small = x.astype(np.float32)
    return (small if np.array_equal(small, x) else x).tobytes()


def _unpacked(packed: bytes, rows: int, dim: int) -> np.ndarray:
    return np.frombuffer(packed, np.float32 if len(packed) == 4 * rows * dim else np.float64).reshape(rows, dim)


def _inner(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, summed from the first component on."""
    score = np.zeros(len(q))
    with np.errstate(over="ignore", invalid="ignore"):
        products = q.astype(np.float64) * x
        for c in range(products.shape[1]):
            score += products[:, c]
    return score


def _places(groups: np.ndarray) -> np.ndarray:
    """Of sorted groups, the index of each one's first member, by member."""
    heads = np.flatnonzero(np.concatenate([[True], np.diff(groups) != 0])) if len(groups) else np.zeros(0, np.int64)
    return np.repeat(heads, np.diff(np.append(heads, len(groups))))


class _Asking:
    """A block's queries and the best nodes of each so far, best first."""

    def __init__(self, row: pa.Table, dim: int) -> None:
        self.block = row["block"][0].as_py()
        self.ids = _joined(row, "ids", np.int64)
        self.vectors = _unpacked(row["vectors"][0].as_py(), len(self.ids), dim)
        self.asker, self.node = _joined(row, "asker", np.int32), _joined(row, "node", np.int64)
        self.score = _joined(row, "score", np.float64)
        self.done, self.go = _joined(row, "done", bool), _joined(row, "go", bool)


def _turns(block: int, ids: np.ndarray, vectors: np.ndarray, asker: np.ndarray, node: np.ndarray, score: np.ndarray,
           done: np.ndarray, kept: int, beam: int, expanded: int) -> pa.Table:
    """The ``kept`` best nodes of each query; of the ``beam`` best those not expanded yet take their turn."""
    order = np.lexsort((node, -score, ~np.isnan(score), asker))
    order = order[np.arange(len(order)) - _places(asker[order]) < kept]
    asker, node, score, done = asker[order], node[order], score[order], done[order]
    first = _places(asker)
    waiting = ~done & (np.arange(len(asker)) - first < beam)
    before = np.cumsum(waiting) - waiting
    go = waiting & (before - before[first] < expanded)
    return _rows(_ASKING, [(block, int(go.sum()), ids.tobytes(), _packed(vectors), asker.astype(np.int32).tobytes(), node.tobytes(),
                            score.tobytes(), (done | go).tobytes(), go.tobytes())])


def _to_expand(own: bool, regions: int, dim: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes whose turn it is, or the queries' ``own``, told to their regions."""
    for batch in batches:
        for row in range(batch.num_rows):
            a = _Asking(pa.Table.from_batches([batch.slice(row, 1)]), dim)
            asker, node = (np.arange(len(a.ids), dtype=np.int32), a.ids) if own else (a.asker[a.go], a.node[a.go])
            rows = [(r, a.block, asker[at].tobytes(), node[at].tobytes()) for r, at in _split(block_of(node, regions))]
            if rows:
                yield _rows(_TO_EXPAND, rows).combine_chunks().to_batches()[0]


def _found_at(ids: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the nodes are among sorted ids, and which of them are there at all."""
    at = np.minimum(np.searchsorted(ids, node), max(len(ids) - 1, 0))
    return at, ids[at] == node if len(ids) else np.zeros(len(node), bool)


def _expand(lists: pa.Table, asked: pa.Table) -> pa.Table:
    """The neighbours of the nodes asked for, each once a query."""
    if not lists.num_rows:
        return _rows(_FOUND, [])
    ids, ends, neighbours = (_joined(lists, n, np.int64) for n in ("ids", "ends", "neighbours"))
    starts = np.concatenate([[0], ends[:-1]])
    rows = []
    for block, asker, node in zip(*(asked[n].to_pylist() for n in ("block", "asker", "node")), strict=True):
        at, known = _found_at(ids, np.frombuffer(node, np.int64))
        at, asker = at[known], np.frombuffer(asker, np.int32)[known]
        sizes = ends[at] - starts[at]
        asker = np.repeat(asker, sizes)
        node = neighbours[np.arange(len(asker)) + np.repeat(starts[at] - np.cumsum(sizes) + sizes, sizes)]
        order = np.lexsort((node, asker))
        asker, node = asker[order], node[order]
        new = np.ones(len(node), bool)
        new[1:] = (asker[1:] != asker[:-1]) | (node[1:] != node[:-1])
        rows.append((block, asker[new].tobytes(), node[new].tobytes()))
    return _rows(_FOUND, rows)


def _to_score(regions: int, slices: int, dim: int, kept: int, state: pa.Table, found: pa.Table) -> pa.Table:
    """Candidates that a query doesn't hold, told to their regions with its vector and the least score that it still takes."""
    if not state.num_rows:
        return _rows(_TO_SCORE, [])
    a = _Asking(state, dim)
    asker = np.concatenate([np.arange(len(a.ids), dtype=np.int32), a.asker, _joined(found, "asker", np.int32)])
    node = np.concatenate([a.ids, a.node, _joined(found, "node", np.int64)])
    order = np.lexsort((node, asker))  # stable: what is held comes before what is found
    new = order >= len(a.ids) + len(a.node)
    new[1:] &= (asker[order][1:] != asker[order][:-1]) | (node[order][1:] != node[order][:-1])
    asker, node = asker[order[new]], node[order[new]]
    worst = np.full(len(a.ids), -np.inf)
    full = np.arange(len(a.asker)) - _places(a.asker) == kept - 1
    worst[a.asker[full]] = a.score[full]
    rows = []
    for region, at in _split(block_of(node, regions)):
        sent, local = np.unique(asker[at], return_inverse=True)
        rows.append((region, a.block % slices, a.block, sent.astype(np.int32).tobytes(), a.vectors[sent].tobytes(), worst[sent].tobytes(),
                     local.astype(np.int32).tobytes(), node[at].tobytes()))
    return _rows(_TO_SCORE, rows)


def _score(dim: int, points: pa.Table, asked: pa.Table) -> pa.Table:
    """Scores of the candidates that are not worse than the worst a query holds."""
    if not points.num_rows:
        return _rows(_SCORED, [])
    ids = _joined(points, "ids", np.int64)
    x = _unpacked(points["vectors"][0].as_py(), len(ids), dim)
    rows = []
    for message in asked.to_batches(1):
        block, askers, q, worst, local, node = (message.column(n)[0].as_py() for n in ("block", "askers", "vectors", "worst", "asker", "node"))
        askers, worst = np.frombuffer(askers, np.int32), np.frombuffer(worst, np.float64)
        local, node = np.frombuffer(local, np.int32), np.frombuffer(node, np.int64)
        q = _unpacked(q, len(askers), dim)
        at, known = _found_at(ids, node)
        at, local, node = at[known], local[known], node[known]
        score = np.concatenate([np.zeros(0), *(_inner(q[local[i : i + PAIRS]], x[at[i : i + PAIRS]]) for i in range(0, len(at), PAIRS))])
        good = ~(score < worst[local])
        rows.append((block, askers[local[good]].tobytes(), node[good].tobytes(), score[good].tobytes()))
    return _rows(_SCORED, rows)


def _answers(k: int, dim: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            a = _Asking(pa.Table.from_batches([batch.slice(row, 1)]), dim)
            rank = np.arange(len(a.asker)) - _places(a.asker) + 1
            at = rank <= k
            yield pa.record_batch([pa.array(a.ids[a.asker[at]]), pa.array(rank[at].astype(np.int32)), pa.array(a.node[at]),
                                   pa.array(a.score[at])], names=["query_id", "rank", "vec_id", "score"])


def search(graph: DataFrame, vectors: DataFrame, queries: DataFrame, k: int = 20, beam: int = BEAM,
           expanded: int = EXPANDED) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products found for each query.

    ``queries`` is a subset of ``vectors`` (``vec_id``, ``embedding``); a
    query starts from its own node and the ``LONGEST`` longest. Its own id is no candidate. Scores are
    double precision on the original vectors; ties go to the smaller id.
    """
    points = vectors.select(F.col("vec_id").alias("node"), F.col("embedding").cast("array<double>").alias("x"))
    points = points.groupBy("node").agg(F.min("x").alias("x"))
    asked = queries.select(F.col("vec_id").alias("node")).distinct()
    n, dim = vectors.agg(F.count("*"), F.max(F.size("embedding"))).first()
    dim = max(dim or 0, 1)
    regions = parts_for(n, max(1, min(max(BLOCK, -(-n // REGIONS)), VALUES // dim)))
    blocks = parts_for(asked.count(), max(1, min(QUERIES, VALUES // dim)))
    slices = parts_for(blocks, max(1, VALUES // (dim * QUERIES)))
    kept = max(beam, k)
    region, block = F.col("region"), F.col("block")

    def place(column: str, name: str, parts: int, schema: str):
        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.append_column(name, pa.array(block_of(batch.column(column).to_numpy(), parts)))
        return lambda df: df.mapInArrow(placed, f"{schema}, {name} long")

    def pack_region(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("node")
        lists = pa.concat_arrays(rows["neighbours"].chunks)
        ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64))
        return _rows(_REGION, [(key[0].as_py(), rows["node"].to_numpy().tobytes(), _packed(_matrix(rows["x"], dim)), ends.tobytes(),
                                lists.flatten().to_numpy().tobytes())])

    def longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                x = _unpacked(row["vectors"], len(ids), dim)
                length = np.concatenate([_inner(x[i : i + PAIRS], x[i : i + PAIRS]) for i in range(0, len(x), PAIRS)])
                at = np.lexsort((ids, -length))[:LONGEST]
                yield pa.record_batch([pa.array(ids[at]), pa.array(length[at]), pa.array([x[i].astype(np.float64) for i in at])],
                                      names=["node", "length", "x"])

    def pack_queries(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("node")
        ids, q = rows["node"].to_numpy(), _matrix(rows["x"], dim)
        score = np.array([_inner(np.broadcast_to(v, far_x.shape), far_x) for v in q]).reshape(len(q), len(far))
        asker, at = np.nonzero(far != ids[:, None])
        return _turns(key[0].as_py(), ids, q, asker, far[at], score[asker, at], np.zeros(len(at), bool), kept, 0, 0)

    def merge(state: pa.Table, scored: pa.Table) -> pa.Table:
        if not state.num_rows:
            return _rows(_ASKING, [])
        a, more = _Asking(state, dim), _joined(scored, "node", np.int64)
        return _turns(a.block, a.ids, a.vectors, np.concatenate([a.asker, _joined(scored, "asker", np.int32)]), np.concatenate([a.node, more]),
                      np.concatenate([a.score, _joined(scored, "score", np.float64)]),
                      np.concatenate([a.done, np.zeros(len(more), bool)]), kept, beam, expanded)

    def to_expand(own: bool):
        return lambda batches: _to_expand(own, regions, dim, batches)

    nodes = points.join(graph.withColumnRenamed("id", "node"), "node").select("node", "x", "neighbours")
    nodes, nodes_at = _stored(place("node", "region", regions, "node long, x array<double>, neighbours array<long>")(nodes).groupBy(
        region).applyInArrow(pack_region, _REGION))
    top = nodes.select("ids", "vectors").mapInArrow(longest, "node long, length double, x array<double>").orderBy(
        F.desc("length"), "node").limit(LONGEST).collect()
    far = np.array([r.node for r in top], np.int64)
    far_x = np.array([r.x for r in top]).reshape(len(top), dim)
    asked = place("node", "block", blocks, "node long, x array<double>")(asked.join(points, "node"))
    state, at = _stored(asked.groupBy(block).applyInArrow(pack_queries, _ASKING))
    lists = nodes.select("region", "ids", "ends", "neighbours")
    packed = nodes.select("region", "ids", "vectors", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
    own = True
    while True:  # every hop expands nodes that were not, so this ends
        told = state.mapInArrow(to_expand(own), _TO_EXPAND)
        found = lists.groupBy(region).cogroup(told.groupBy(region)).applyInArrow(_expand, _FOUND)
        told = state.groupBy(block).cogroup(found.groupBy(block)).applyInArrow(
            lambda s, f: _to_score(regions, slices, dim, kept, s, f), _TO_SCORE)
        scored = packed.groupBy("region", "slice").cogroup(told.groupBy("region", "slice")).applyInArrow(
            lambda p, t: _score(dim, p, t), _SCORED)
        state, at = _stored(state.groupBy(block).cogroup(scored.groupBy(block)).applyInArrow(merge, _ASKING), at)
        own = False
        if state.filter("waiting > 0").isEmpty():
            break
    remove_path(vectors.sparkSession, nodes_at)
    return state.mapInArrow(lambda batches: _answers(k, dim, batches), "query_id long, rank int, vec_id long, score double")


def nearest(vectors: DataFrame, queries: Column, k: int = 20, **options) -> DataFrame:
    """Graph and search over the usable rows of ``vectors``; ``queries`` says which of them ask.

    NULL ids and unusable vectors take no part; rows that repeat an id count
    once; an empty table gives no rows; other columns are ignored.
    """
    taking_part = vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    if taking_part.isEmpty():
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # the condition is stored with the rows: a column of ``vectors`` means nothing to the stored copy
    rows, at = _stored(taking_part.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
        queries.alias("asks")))
    out = search(neighbour_graph(rows, **options), rows, rows.filter("asks"), k)
    remove_path(vectors.sparkSession, at)  # the answers are stored
    return out
