import numpy as np

from martloom.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string"


def brute(rows, asked, k):
    out = {}
    for i, q in asked.items():
        scores = [(-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in rows.items() if j != i]
        out[i] = [(j, -s) for s, j in sorted(scores)[:k]]
    return out


def test_against_brute_force_with_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(3)
    rows = {i: [float(x) for x in rng.integers(-2, 3, 6) / 8] for i in range(300)}  # many ties
    rows[400], rows[401] = [0.0] * 6, [0.25, 0.5]
    bad = [(500, None), (501, [1.0, float("nan")]), (502, [float("inf")]), (503, [None, 1.0]), (None, [1.0])]
    data = [(i, v, 1, "x", "y") for i, v in [*rows.items(), *bad, (7, rows[7])]]
    terms = topk.integer_terms(spark.createDataFrame(data, SCHEMA))
    out = topk.exact_top_k(terms, terms.filter("vec_id % 50 = 0"), k=5, corpus_block=64, query_block=3).collect()
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows.items()}
    want = brute(whole, {i: v for i, v in whole.items() if i % 50 == 0}, 5)
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == want


def test_few_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0], 1, "", ""), (1, [2.0], 1, "", "")], SCHEMA)
    terms = topk.integer_terms(df)
    assert [tuple(r) for r in topk.exact_top_k(terms, terms.filter("vec_id = 0")).collect()] == [(0, 1, 1, 131072)]
    none = topk.integer_terms(spark.createDataFrame([], SCHEMA))
    assert topk.exact_top_k(none, none).count() == 0


def test_repeated_ids_with_unequal_vectors(spark):
    """Rows with the query's own id are skipped and take no place of others."""
    data = [*((0, [9.0 + i], 1, "", "") for i in range(4)), *((j, [1.0 / j], 1, "", "") for j in range(1, 9))]
    terms = topk.integer_terms(spark.createDataFrame(data, SCHEMA))
    out = topk.exact_top_k(terms, terms.filter("vec_id = 0 AND terms[0] = 2304"), k=5).orderBy("rank").collect()
    assert [r.vec_id for r in out] == [1, 2, 3, 4, 5]
