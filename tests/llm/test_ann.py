import numpy as np

from martloom.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, node string, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], SCHEMA)


def truth(x, ids, q, k):
    s = x @ q[1]
    order = sorted((-v, i) for v, i in zip(s, ids, strict=True) if i != q[0])[:k]
    return [i for _, i in order]


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1500, 16)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    bad = [(1500, None), (1520, [0.0] * 16), (1540, [float("nan")] + [0.0] * 15), (1560, [float("inf")] * 16), (1580, [None] * 16)]
    df = frame(spark, [*rows, *bad, rows[3], (None, rows[4][1])])
    out = ann.nearest(df, df.vec_id % 20 == 0, k=10, neighbours=24, block_rows=400).collect()
    double = np.array([v for _, v in rows])
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        assert abs(r.score - float(double[r.query_id] @ double[r.vec_id])) < 1e-12
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == {i for i in range(1500) if i % 20 == 0}
    assert all(len(v) == len(set(v)) == 10 and q not in v for q, v in got.items())
    hits = [len(set(v) & set(truth(double, range(1500), (q, double[q]), 10))) / 10 for q, v in got.items()]
    assert np.mean(hits) >= 0.95


def test_few_ties_and_empty(spark):
    df = frame(spark, [(0, [1.0, 0.0]), (5, [0.5, 0.5]), (3, [0.5, 0.5]), (7, [0.0, 2.0])])
    out = ann.nearest(df, df.vec_id == 0, k=20).orderBy("rank").collect()
    assert [(r.rank, r.vec_id, r.score) for r in out] == [(1, 3, 0.5), (2, 5, 0.5), (3, 7, 0.0)]
    assert ann.nearest(frame(spark, []), df.vec_id == 0).count() == 0
    one = frame(spark, [(0, [1.0])])
    assert ann.nearest(one, one.vec_id == 0).count() == 0


def test_search_goes_on_until_the_best_are_expanded(spark):
    """On a chain of neighbours the nearest vectors are more than eight hops away."""
    n = 30
    angles = [0.05 * i for i in range(n)]
    points = frame(spark, [(i, [float((1 + i) * np.cos(a)), float((1 + i) * np.sin(a))]) for i, a in enumerate(angles)])
    chain = spark.createDataFrame([(i, [j for j in (i - 1, i + 1) if 0 <= j < n]) for i in range(n)], "id long, neighbours array<long>")
    out = ann.search(chain, points, points.filter("vec_id = 0"), k=1, beam=4, expanded=1).collect()
    x = {i: (1 + i) * np.cos(a) for i, a in enumerate(angles)}
    assert [r.vec_id for r in out] == [max((v, i) for i, v in x.items() if i)[1]]


def test_recall_on_vectors_of_unequal_length(spark):
    """The largest inner products are long vectors that may point elsewhere than the query."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 24))
    x *= rng.lognormal(0, 0.7, (3000, 1)) / np.linalg.norm(x, axis=1, keepdims=True)
    df = frame(spark, [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)])
    x = x.astype(np.float32).astype(float)
    got = {}
    for r in ann.nearest(df, df.vec_id % 30 == 0, k=10, neighbours=32, block_rows=800).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = [len(got[q] & set(truth(x, range(3000), (q, x[q]), 10))) / 10 for q in range(0, 3000, 30)]
    assert np.mean(hits) >= 0.95 and min(hits) >= 0.5


def test_a_hub_and_one_direction(spark):
    """A vector that all others hold as a neighbour, and 700 of one direction and different lengths."""
    rng = np.random.default_rng(4)
    rays = [(i, [float(1 + i / 100), float(1 + i / 100), 0.0, 0.0]) for i in range(700)]
    cloud = [(1000 + i, [float(v) for v in 0.3 * rng.standard_normal(4)]) for i in range(700)]
    df = frame(spark, rays + cloud)
    got = {}
    for r in ann.nearest(df, df.vec_id % 100 == 0, k=5, neighbours=16, block_rows=500).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    x = {i: np.array(v) for i, v in rays + cloud}
    hits = []
    for q, found in got.items():
        want = truth(np.array(list(x.values())), list(x), (q, x[q]), 5)
        hits.append(len({i for _, i in found} & set(want)) / 5)
    assert len(got) == 14 and np.mean(hits) >= 0.9


def test_members_of_a_hub_are_dealt_in_groups():
    at = np.arange(1300)
    groups = [ann._dealt(at, r) for r in (0, 1)]
    assert all(len(g) <= ann.HUB for gs in groups for g in gs) and all(sorted(np.concatenate(gs)) == at.tolist() for gs in groups)
    assert any((a[: len(b)] != b[: len(a)]).any() for a, b in zip(*groups, strict=True))


def inner(a, b):
    s = 0.0
    for v, w in zip(a, b, strict=True):  # sum() would round less
        s += v * w
    return s


def beam_search(graph, x, start, k, beam, expanded, far):
    """The search in plain Python."""
    score = {i: inner(x[start], x[i]) for i in far if i != start}
    done, go = set(), [start]
    while go:
        for node in go:
            for i in graph.get(node, []):
                if i != start and i in graph:
                    score[i] = inner(x[start], x[i])
        order = sorted(score, key=lambda i: (-score[i], i))
        go = [i for i in order[:beam] if i not in done][:expanded]
        done |= set(go)
    return [(r + 1, i, score[i]) for r, i in enumerate(order[:k])]


def test_search_over_many_regions_and_blocks(spark, monkeypatch):
    """Regions, query blocks and slices decide where the work is done only; negative ids, ties, nodes the graph doesn't have."""
    for name, value in (("BLOCK", 50), ("REGIONS", 6), ("VALUES", 120), ("QUERIES", 7), ("LONGEST", 5)):
        monkeypatch.setattr(ann, name, value, raising=False)
    rng = np.random.default_rng(5)
    x = {i - 150: [float(v) for v in rng.integers(-4, 5, 3) / 3] for i in range(300)}
    x[7] = x[8] = x[9] = [5.0, 1 / 3, 0.1]
    graph = {i: [int(j) for j in rng.choice(list(x), 5)] for i in x if i != 20}
    far = sorted((i for i in x if i != 20), key=lambda i: (-inner(x[i], x[i]), i))[:5]
    points = spark.createDataFrame(list(x.items()), "vec_id long, embedding array<double>")
    edges = spark.createDataFrame([(i, [*n, n[0], 10**6]) for i, n in graph.items()], "id long, neighbours array<long>")
    got = {}
    for r in ann.search(edges, points, points.filter("vec_id % 4 = 0"), k=12, beam=9, expanded=4).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert got == {q: beam_search(graph, x, q, 12, 9, 4, far) for q in x if q % 4 == 0}


def test_a_round_leaves_neither_its_shuffle_files_nor_the_table_before(spark):
    from martloom.session import _tables_folder, hadoop_path

    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        found = [files.apply(i) for i in range(files.size())]
        return {f.getName(): f.length() for f in found if f.getName().startswith("shuffle_")}

    def tables():
        fs, path = hadoop_path(spark, _tables_folder(spark))
        return {s.getPath().getName() for s in fs.listStatus(path)}

    rng = np.random.default_rng(6)
    df = frame(spark, [(i, [float(v) for v in rng.standard_normal(8)]) for i in range(600)])
    files, kept = shuffled(), tables()
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    out = ann.nearest(df, df.vec_id % 20 == 0, k=5, neighbours=8, block_rows=200)
    assert sum(n for f, n in shuffled().items() if f not in files) < 100_000
    assert len(tables() - kept) <= 2  # the graph and the answers
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == setting
    assert out.count() == 150


def test_a_message_holds_a_query_once():
    """Candidates of one region share their query's vector; what a query holds and its own node are not asked for."""
    ids = np.array([3, 5], np.int64)
    vectors = np.array([[1.0, 2.0], [0.1, 4.0]])
    state = ann._turns(0, ids, vectors, np.array([0]), np.array([8]), np.array([2.0]), np.array([True]), 1, 1, 1)
    found = ann._rows(ann._FOUND, [(0, np.zeros(9, np.int32).tobytes(), np.array([*range(8), 8], np.int64).tobytes()),
                                   (0, np.array([0, 1], np.int32).tobytes(), np.array([7, 6], np.int64).tobytes())])
    told = ann._to_score(1, 1, 2, 1, state, found).to_pylist()
    assert len(told) == 1 and np.frombuffer(told[0]["vectors"]).tolist() == vectors.ravel().tolist()
    assert np.frombuffer(told[0]["asker"], np.int32).tolist() == [0] * 7 + [1]
    assert np.frombuffer(told[0]["node"], np.int64).tolist() == [0, 1, 2, 4, 5, 6, 7, 6]
    assert np.frombuffer(told[0]["worst"]).tolist() == [2.0, -np.inf]


def test_best_edges_of_any_ids():
    rng = np.random.default_rng(7)
    src, dst, fresh = rng.integers(0, 9, 500), rng.integers(0, 20, 500), rng.integers(0, 2, 500).astype(np.uint8)
    score = rng.choice([0.5, -0.5, 0.0, -0.0, 0.25], 500).astype(np.float32)
    best = ann.top_edges(src, dst, score, fresh, 4)
    assert (ann.top_edges(src - (1 << 40), dst - 7, score, fresh, 4) == best).all()
    first = {}
    for i in np.lexsort((np.arange(500), fresh, dst, src)):
        first.setdefault((src[i], dst[i]), i)
    want = [i for s in range(9) for i in sorted((i for (a, _), i in first.items() if a == s), key=lambda i: (-score[i], dst[i]))[:4]]
    assert best.tolist() == want
