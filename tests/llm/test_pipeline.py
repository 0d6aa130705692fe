"""The pipeline on a small table: each stage against what it should keep of its own input."""

from collections import Counter

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
pytest.importorskip("public_tokenizers")

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    from martloom.session import ship_package

    ship_package(spark)
    base = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(9000, None, "en", None, None), (9001, "", "en", "src0", 0), (None, "a document without an id", "en", "src1", 24),
             (9002, "you idiot moron scum trash loser stupid clown " * 5, "en", "src1", 225)]
    docs = base.unionByName(spark.createDataFrame(extra, base.schema))
    tables, folder = [docs], tmp_path_factory.mktemp("pipeline")
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], SF).write.parquet(f"{folder}/{at}")
        tables.append(spark.read.parquet(f"{folder}/{at}"))
    return [t.collect() for t in tables], [t.columns for t in tables]


def test_columns(stages):
    _, columns = stages
    assert all(c == columns[0] for c in columns[:-1])


def test_toxicity_drops_rejected_documents_only(stages):
    rows, _ = stages
    assert 9002 in {r.doc_id for r in rows[0]} - {r.doc_id for r in rows[1]}
    assert {9000, 9001, None} <= {r.doc_id for r in rows[1]}


def test_line_dedup_keeps_first_copies(stages):
    rows, _ = stages
    before = {r.doc_id: r.text for r in rows[1]}
    for r in rows[2]:
        left = Counter((r.text or "").split("\n"))
        assert not left - Counter((before[r.doc_id] or "").split("\n"))
    first = {}
    for i in sorted((i for i in before if i is not None)):
        first.setdefault(before[i], i)
    assert all(i in {r.doc_id for r in rows[2]} for t, i in first.items() if not t)


def test_near_dedup_keeps_one_of_each_group(spark, stages):
    from llm.test_setsketch import brute

    rows, _ = stages
    with_id = [(r.doc_id, r.text) for r in rows[2] if r.doc_id is not None]
    want = {i for i, _, _, kept in brute(with_id) if kept}
    assert {r.doc_id for r in rows[3] if r.doc_id is not None} == want


def test_mixing_repeats_documents(stages):
    rows, _ = stages
    copies = Counter(r.doc_id for r in rows[4])
    assert set(copies) <= {r.doc_id for r in rows[3]} and max(copies.values()) <= 2
    words = lambda rs: sum(len((r.text or "").split()) for r in rs)
    assert words(rows[4]) == pytest.approx(1.5 * words(rows[3]), rel=0.15)


def test_packing_holds_every_copy(stages):
    rows, _ = stages
    assert Counter(r.doc_id for r in rows[5] if r.piece == 0) == Counter(r.doc_id for r in rows[4])


def test_near_dedup_links_from_four_fifths(spark, make_docs):
    """Pairs of 100 words with one word changed inside share 91 of 101 shingles, with two 86 of 106, with three 81 of 111."""
    def words(k, changed):
        return " ".join(f"x{k}n{i}" if i in changed else f"d{k}w{i}" for i in range(100))

    docs, want = [], set()
    for k in range(30):
        changed = [{30}, {30, 60}, {30, 50, 70}][k % 3]
        docs += [(2 * k, words(k, ())), (2 * k + 1, words(k, changed))]
        a, b = ({tuple(t.split()[i : i + 5]) for i in range(96)} for _, t in docs[-2:])
        want |= {2 * k} | ({2 * k + 1} if 100 * len(a & b) < 80 * len(a | b) else set())
    assert len(want) == 40  # 86 of 106 is 0.81: linked from 0.8, not from 0.85
    assert {r.doc_id for r in corpus_pipeline.dedup_near(spark, make_docs(docs), SF).collect()} == want


CLASHING = "doc_id long, text string, source string, n_chars long, {}"


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_keep_columns_of_any_name(spark, stage):
    """Columns named as the stages' own, and in the way of their joins, come out as they went in."""
    from martloom.session import ship_package

    ship_package(spark)
    names = ["_mark", "_row", "_gone", "_copy", "mark", "copies", "size", "part", "score", "predicted", "n_lines", "n_left", "row", "node",
             "root", "kept", "weight", "own_id"]
    rows = [(i, f"one line of ten words is number {i} of them all\nand a second line of document {i}", "a" if i % 2 else None, 50,
             *[f"{n} {i}" for n in names]) for i in range(8)] + [(None, None, None, None, *["x"] * len(names))]
    docs = spark.createDataFrame(rows, CLASHING.format(", ".join(f"{n} string" for n in names)))
    out = stage[1](spark, docs, SF)
    assert out.columns == docs.columns
    before = {r.doc_id: tuple(r[n] for n in names) for r in docs.collect()}
    assert all(tuple(r[n] for n in names) == before[r.doc_id] for r in out.collect())


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_of_an_empty_table(spark, stage):
    from martloom.session import ship_package

    ship_package(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert stage[1](spark, docs, SF).count() == 0


def test_an_empty_document_is_taken_twice_at_most(spark):
    from martloom.session import ship_package

    ship_package(spark)
    rows = [(i, "w " * 2000, "big") for i in range(30)] + [(100, "a b", "small"), (101, "", "small"), (102, None, "small")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    copies = Counter(r.doc_id for r in corpus_pipeline.mix_sources(spark, docs, SF).collect())
    assert copies[100] == 2 and max(copies.values()) == 2
