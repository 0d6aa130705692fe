"""Hard-negative mining with STR-packed R-trees.

Integer vectors are packed sort-tile-recursively: all rows are numbered by
label and first axis and cut into slabs, the rows of each slab by label and
second axis and cut into shards of a fixed number of rows, and within a shard
two further axes give the leaves of an R-tree. A node holds the least and the
greatest value of every coordinate and of the label, so a query's inner product
with anything below it lies in an interval, a sum over the coordinates.

Searches go from the root by a best-first queue on the interval's upper end.
Boxes of the wrong labels, boxes outside all score windows still open, and
boxes strictly below the k-th best found are pruned. Every shard is searched
for every anchor; the shards' answers are merged by anchor.
"""

from __future__ import annotations

import heapq
import math
from bisect import insort
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import checkpointed, parts_for
from martloom.llm.topk import finite
from martloom.operators.keys import assign_surrogate_keys

SHARD = 8192
LEAF = 64
FANOUT = 16
ANCHORS_AT_ONCE = 1024
AXES = (0, 1, 2, 3)   # slabs, shards, and twice within a shard
PER_CENT = (80, 100)  # a negative's score, per cent of the positive's, at least and at most

FOUND = "anchor long, slot int, row long, vec_id long, score long"


def integer_rows(vectors: DataFrame, label: Column, scale: int = 256) -> DataFrame:
    """``vec_id, label, terms`` with each component x as ``floor(scale * x)``; see :func:`mine` for the rows left out."""
    kept = vectors.filter(finite(F.col("embedding"))).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(scale)))).alias("terms"))
    return kept.filter("vec_id IS NOT NULL AND label IS NOT NULL").distinct()


def packed(rows: DataFrame, shard: int = SHARD) -> DataFrame:
    """``rows`` with ``row``, dense over the table in packing order, and the ``shard`` it is in."""
    rows = checkpointed(rows)
    n = rows.count()
    shards = parts_for(n, shard, 1)
    shard, slabs = -(-n // shards) or 1, math.ceil(math.sqrt(shards))  # shards of equal size, ``shard`` rows at most

    def axis(a: int) -> Column:
        return F.coalesce(F.get("terms", F.lit(a)), F.lit(0).cast("bigint"))

    numbered = assign_surrogate_keys(rows.withColumn("along", axis(AXES[0])), ["label", "along", "vec_id"], "row", -1).keyed
    slab = F.floor(F.col("row") / (slabs * shard)).cast("bigint")
    numbered = numbered.select("vec_id", "label", "terms", slab.alias("slab"), axis(AXES[1]).alias("along"))
    numbered = assign_surrogate_keys(numbered, ["slab", "label", "along", "vec_id"], "row", -1).keyed
    return numbered.select("row", "vec_id", "label", "terms", F.floor(F.col("row") / shard).cast("bigint").alias("shard"))


def matrix_of(column: pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Integer lists as one matrix; shorter rows have 0 for what they lack."""
    lengths = pc.list_value_length(column).to_numpy()
    wide = max(int(lengths.max(initial=0)), width)
    flat = pc.list_flatten(column).to_numpy()
    if (lengths == wide).all():
        return flat.reshape(len(lengths), wide)
    out = np.zeros((len(lengths), wide), np.int64)
    out[np.arange(wide) < lengths[:, None]] = flat
    return out


class RTree:
    """Rows of one shard in leaves, and levels of boxes above them."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray,
                 leaf: int = LEAF, fanout: int = FANOUT) -> None:
        axes = [matrix[:, a] if a < matrix.shape[1] else np.zeros(len(rows), np.int64) for a in AXES[2:]]
        slab_rows = leaf * math.ceil(math.sqrt(-(-len(rows) // leaf)))
        first = np.lexsort((ids, axes[0], labels))
        slab = np.empty(len(rows), np.int64)
        slab[first] = np.arange(len(rows)) // slab_rows
        order = np.lexsort((ids, axes[1], labels, slab))
        self.rows, self.ids, self.labels, self.matrix = rows[order], ids[order], labels[order], matrix[order]
        self.leaf, self.fanout = leaf, fanout
        self.levels = [self._boxes(self.matrix, self.matrix, self.labels, self.labels, leaf)]
        while len(self.levels[-1][0]) > 1:
            self.levels.append(self._boxes(*self.levels[-1], fanout))

    @staticmethod
    def _boxes(low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray, size: int):
        starts = np.arange(0, len(low), size)
        return (np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts),
                np.minimum.reduceat(least, starts), np.maximum.reduceat(most, starts))

    def search(self, query: np.ndarray, may_hold: Callable, open_to: Callable, take: Callable) -> None:
        """Leaves best first: ``take(slice, scores)`` gets the rows of each leaf reached.

        ``may_hold(least, most)`` says which boxes have labels of interest;
        ``open_to(lower, upper)`` which intervals can still add to the result.
        """
        plus, minus = np.maximum(query, 0), np.minimum(query, 0)
        top = len(self.levels) - 1
        waiting: list[tuple[int, int, int, int]] = []

        def push(level: int, start: int, end: int) -> None:
            low, high, least, most = (v[start:end] for v in self.levels[level])
            uppers, lowers = high @ plus + low @ minus, low @ plus + high @ minus
            chosen = np.flatnonzero(may_hold(least, most) & open_to(lowers, uppers))
            for i, u, w in zip(chosen.tolist(), uppers[chosen].tolist(), lowers[chosen].tolist(), strict=True):
                heapq.heappush(waiting, (-u, level, start + i, w))

        push(top, 0, len(self.levels[top][0]))
        while waiting:
            upper, level, node, lower = heapq.heappop(waiting)
            if not open_to(lower, -upper):
                continue
            if level:
                push(level - 1, node * self.fanout, (node + 1) * self.fanout)
            else:
                rows = slice(node * self.leaf, (node + 1) * self.leaf)
                take(rows, self.matrix[rows] @ query)


class Best:
    """The k best of one score window: higher scores first, then smaller ids."""

    def __init__(self, k: int, low: int | None = None, high: int | None = None) -> None:
        self.k, self.low, self.high = k, low, high
        self.found: list[tuple[int, int, int]] = []

    def least(self) -> int | None:
        """The score a candidate needs to matter (None: any)."""
        kth = -self.found[-1][0] if len(self.found) == self.k else None
        return max((v for v in (self.low, kth) if v is not None), default=None)

    def offer(self, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        for s, i, r in sorted(zip((-scores).tolist(), ids.tolist(), rows.tolist(), strict=True))[: self.k]:
            if len(self.found) == self.k and (s, i, r) > self.found[-1]:
                break
            insort(self.found, (s, i, r))
            del self.found[self.k :]


def search_windows(tree: RTree, query: np.ndarray, own: int, label: int, same: bool, windows: list[Best]) -> None:
    """Fill ``windows`` with rows of the label (``same``) or of other labels, never of the id ``own``."""
    lows = highs = None

    def refresh() -> None:
        nonlocal lows, highs
        least = [w.least() for w in windows]
        lows = np.array([np.iinfo(np.int64).min if v is None else v for v in least])
        highs = np.array([np.iinfo(np.int64).max if w.high is None else w.high for w in windows])

    def may_hold(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        return (least <= label) & (label <= most) if same else (least != label) | (most != label)

    def open_to(lower, upper):
        return ((np.minimum.outer(upper, highs) >= lows) & np.less_equal.outer(lower, highs)).any(axis=-1)

    def take(rows: slice, scores: np.ndarray) -> None:
        wanted = (scores >= lows.min()) & (scores <= highs.max()) & (tree.ids[rows] != own)
        wanted &= (tree.labels[rows] == label) == same
        at = np.flatnonzero(wanted)
        if not len(at):
            return
        scores, ids, numbers = scores[at], tree.ids[rows][at], tree.rows[rows][at]
        for w, low, high in zip(windows, lows, highs, strict=True):
            inside = (scores >= low) & (scores <= high)
            if inside.any():
                w.offer(scores[inside], ids[inside], numbers[inside])
        refresh()

    refresh()
    tree.search(query, may_hold, open_to, take)


def _windows_of(row_windows: list[dict] | None, k: int) -> list[Best]:
    return [Best(k)] if row_windows is None else [Best(k, w["low"], w["high"]) for w in row_windows]


def _search(rows: DataFrame, anchors: DataFrame, shards: int, k: int, same: bool) -> DataFrame:
    """Each anchor's ``k`` best rows of every shard and window: ``anchor, slot, row, vec_id, score``.

    Cells of (shard, block of anchors): a task holds one shard's tree and a
    bounded number of anchors, whatever the number of rows.
    """
    groups = parts_for(anchors.count(), ANCHORS_AT_ONCE)
    left = rows.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = anchors.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))))

    def cell(corpus: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if corpus.num_rows and asked.num_rows:
            queries = matrix_of(asked["terms"])
            matrix = matrix_of(corpus["terms"], queries.shape[1])
            queries = matrix_of(asked["terms"], matrix.shape[1])
            tree = RTree(corpus["row"].to_numpy(), corpus["vec_id"].to_numpy(), corpus["label"].to_numpy(), matrix)
            listed = asked["windows"].to_pylist() if "windows" in asked.column_names else [None] * len(queries)
            for query, number, own, label, w in zip(
                    queries, *(asked[c].to_pylist() for c in ("row", "vec_id", "label")), listed, strict=True):
                windows = _windows_of(w, k)
                search_windows(tree, query, own, label, same, windows)
                out += [(number, slot, r, i, -s) for slot, b in enumerate(windows) for s, i, r in b.found]
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        columns = list(zip(*out, strict=True)) or [()] * len(types)
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                        names=[c.split()[0] for c in FOUND.split(", ")])

    found = left.groupBy("shard", "group").cogroup(right.groupBy("shard", "group")).applyInArrow(cell, FOUND)
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, per_cent: tuple[int, int] = PER_CENT,
         shard: int = SHARD) -> DataFrame:
    """For each anchor and positive the highest-scoring rows of other labels in the score window.

    ``rows`` holds ``vec_id``, ``label`` (longs) and ``terms`` (array of long);
    ``anchor`` is a condition on ``vec_id`` or ``label``. An anchor's positives
    are its ``positives`` best other rows of its label, all if fewer; negatives
    satisfy ``low * p <= 100 * n <= high * p`` for ``low, high = per_cent``.
    Returns ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``; ties go to the smaller ``vec_id``.

    Rows with a NULL id, label, array or component take no part; equal rows
    count once; rows that share the anchor's id are never its partners;
    shorter arrays have 0 for what they lack; a window that holds nothing (a
    negative positive score) gives no rows, nor does an empty table. Sums are 64-bit.
    """
    clean = rows.select("vec_id", "label", "terms", anchor.alias("is_anchor")).filter(
        "vec_id IS NOT NULL AND label IS NOT NULL AND terms IS NOT NULL AND forall(terms, x -> x IS NOT NULL)")
    flags = clean.filter("is_anchor").select("vec_id", "label").distinct()
    corpus = checkpointed(packed(clean.drop("is_anchor").distinct(), shard))
    shards = (corpus.agg(F.max("shard")).first()[0] or 0) + 1
    anchors = checkpointed(corpus.drop("shard").join(flags, ["vec_id", "label"], "left_semi"))
    near = checkpointed(_search(corpus, anchors, shards, positives, True))
    low, high = per_cent
    # 100 n >= low p and 100 n <= high p over integers
    windows = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", F.col("score").alias("p")))).alias("all")).select(
        F.col("anchor").alias("row"),
        F.expr(f"""transform(all, w -> named_struct('low', (w.p * {low} + pmod(-w.p * {low}, 100)) div 100,
                                                    'high', (w.p * {high} - pmod(w.p * {high}, 100)) div 100))""").alias("windows"))
    far = _search(corpus, anchors.join(windows, "row"), shards, negatives, False)
    names = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    pairs = near.select("anchor", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"),
                        F.col("score").alias("positive_score")).join(names, "anchor")
    return far.join(pairs, ["anchor", "slot"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
