"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors are read as sparse rows over integer terms (component index, weight).
The search space is cut into cells (a block of the corpus, a block of the
queries). In a cell, each term's posting list is scattered, weighted by the
queries' weights of that term, into dense score arrays; a partition selection
keeps the best of each query, and the cells' answers are merged per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import parts_for

CORPUS_BLOCK = 8192
QUERY_BLOCK = 4096
QUERIES_AT_ONCE = 64
DENSE = 0.5
SCHEMA = "query_id long, vec_id long, score long"


def finite(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))


def _weights(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of integer lists as one matrix; shorter rows have no weight for the later terms."""
    rows = column.to_pylist()
    out = np.zeros((len(rows), max((len(r) for r in rows), default=0)), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _scores(queries: np.ndarray, postings: list[tuple[np.ndarray | None, np.ndarray]], n: int) -> np.ndarray:
    acc = np.zeros((len(queries), n), np.int64)
    for term, (docs, weights) in enumerate(postings):
        if term >= queries.shape[1] or not len(weights):
            continue
        rows = np.flatnonzero(queries[:, term])
        if not len(rows):
            continue
        if docs is None:
            acc += queries[:, term, None] * weights
        else:
            acc[np.ix_(rows, docs)] += queries[rows, term, None] * weights
    return acc


def _cell(corpus: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    empty = {"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())}
    if not corpus.num_rows or not queries.num_rows:
        return pa.table(empty)
    corpus = corpus.sort_by("vec_id")
    ids = corpus["vec_id"].to_numpy()
    matrix = _weights(corpus["terms"])
    postings = []
    for term in range(matrix.shape[1]):
        docs = np.flatnonzero(matrix[:, term])
        full = len(docs) > DENSE * len(ids)
        postings.append((None, matrix[:, term].copy()) if full else (docs, matrix[docs, term]))
    query_ids, rows = queries["vec_id"].to_numpy(), _weights(queries["terms"])
    out = []
    for at in range(0, len(query_ids), QUERIES_AT_ONCE):
        own = query_ids[at : at + QUERIES_AT_ONCE]
        acc = _scores(rows[at : at + QUERIES_AT_ONCE], postings, len(ids))
        acc[own[:, None] == ids] = np.iinfo(np.int64).min  # rows with the query's own id, however many, are never selected
        bound = np.partition(acc, len(ids) - min(len(ids), k), axis=1)[:, len(ids) - min(len(ids), k)]
        for i, q in enumerate(own):
            best = np.flatnonzero(acc[i] >= bound[i])
            best = best[ids[best] != q]
            best = best[np.argsort(-acc[i, best], kind="stable")][:k]
            out.append((np.full(len(best), q), ids[best], acc[i, best]))
    return pa.table(dict(zip(empty, map(np.concatenate, zip(*out)), strict=True)))


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, corpus_block: int = CORPUS_BLOCK,
                query_block: int = QUERY_BLOCK) -> DataFrame:
    """The ``k`` highest integer inner products of each query row over all rows.

    Both frames hold ``vec_id`` (long) and ``terms`` (array of long). A query
    skips rows with its own id. Returns ``query_id, rank, vec_id, score``, ties
    to the smaller id; all candidates where fewer than ``k`` exist.

    NULL ids or arrays, and arrays with a NULL, take no part; repeated equal
    rows count once; arrays of different lengths meet on their shared terms;
    empty tables give no rows. Sums are 64-bit.
    """
    def clean(df: DataFrame) -> DataFrame:
        return df.select("vec_id", "terms").filter(
            "vec_id IS NOT NULL AND terms IS NOT NULL AND forall(terms, x -> x IS NOT NULL)").distinct()

    corpus, asked = clean(vectors), clean(queries)
    blocks = parts_for(corpus.count(), corpus_block)
    groups = parts_for(asked.count(), query_block)
    left = corpus.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).withColumn(
        "group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = asked.withColumn("group", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))

    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        return _cell(a, b, k)

    found = left.groupBy("block", "group").cogroup(right.groupBy("block", "group")).applyInArrow(cell, SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def integer_terms(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``(vec_id, terms)`` with each component x as ``floor(scale * x)``; non-finite vectors left out."""
    return vectors.filter(finite(F.col("embedding"))).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(scale)))).alias("terms"))
