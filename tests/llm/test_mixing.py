from collections import Counter, defaultdict

import pytest

from martloom.llm import mixing


def targets(sizes, share=1.5, weights=(5, 2, 1), most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    budget, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        level = (budget - sum(most * sizes[s] for s in capped)) / max(sum(w[s] for s in free), 1e-9)
        new = {s for s in free if level * w[s] > most * sizes[s]}
        if not new:
            return {s: most * sizes[s] if s in capped else level * w[s] for s in names}
        capped |= new


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 900, "c": 50, "d": 3, None: 70}, {"é": 5, "z": 5, "Z": 5}, {"only": 7}, {"a": 0, "b": 0}])
def test_targets_by_water_level(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    for s, t in targets(sizes).items() if any(sizes.values()) else dict.fromkeys(sizes, 0.0).items():
        assert got[s] == pytest.approx(t, rel=1e-9)


def test_mix(spark, make_docs):
    rows = [(i, "w " * (1 + i * 7 % 50), f"s{i % 4}" if i % 9 else None) for i in range(400)]
    rows += [(900, None, "s0"), (901, "", "s1"), (None, "a b", "s1"), (None, "a b", "s1"), (902, "w " * 3000, "s3")]
    docs = mixing.sized(make_docs(rows)).selectExpr("*", "CAST(NULL AS DOUBLE) AS weight")
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    again = mixing.mix(docs).collect()
    key = lambda r: (r.doc_id or -1, r.source or "", r.size, r.copies)
    assert sorted(map(key, out)) == sorted(map(key, again))
    taken, biggest = Counter(), defaultdict(int)
    for r in out:
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r.size
        biggest[r.source] = max(biggest[r.source], r.size)
    for s, t in {r.source: r.target for r in out}.items():
        assert abs(taken[s] - t) <= biggest[s] / 2 + 1
    by_source = defaultdict(list)
    for r in out:
        by_source[r.source].append(r)
    for rows_ in by_source.values():  # complete epochs precede the selection
        assert max(r.copies for r in rows_) - min(r.copies for r in rows_) <= 1


def test_quality_comes_first(spark):
    docs = spark.createDataFrame([(i, "a", 1, 10.0 if i % 2 else 0.1) for i in range(2000)],
                                 "doc_id long, source string, size long, weight double")
    out = mixing.mix(docs, share=0.5).filter("copies = 1").selectExpr("avg(doc_id % 2) AS odd").first()
    assert out.odd > 0.9


def test_empty(spark, make_docs):
    docs = mixing.sized(make_docs([])).selectExpr("*", "1.0D AS weight")
    assert mixing.mix(docs).count() == 0


def test_labels(spark):
    docs = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "a", 1), (None, "a", 1)], "doc_id long, source string, size long")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, None), (None, 1)], "doc_id long, quality int")
    assert {r.doc_id: r.weight for r in mixing.quality_weight(docs, labels).collect()} == {1: 1.5, 2: 0.5, 3: 1.0, None: 1.0}
