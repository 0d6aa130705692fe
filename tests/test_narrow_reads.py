"""Rows of kept tables and derived views are moved no wider and no oftener than needed."""

import tempfile

from conftest import d, frame, rows_of, ts

import derived_views as V
from martloom.operators.guards import dedupe_newest
from martloom.operators.reference_index import ReferenceIndex
from martloom.session import stored_table
from martloom.sources.layers import newest_changes
from martloom.sources.snapshot import SnapshotStore

ROW = {"k": "bigint", "v": "string"}


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_change_sets_meet_by_keys_and_keep_the_last_row(spark):
    store = SnapshotStore(spark, tempfile.mkdtemp(prefix="ml-store-"), key=["k"], compact_at=9.0)
    versions = [[(1, "a"), (2, "a"), (3, "a"), (4, None)], [(1, "b"), (2, "b")], [(2, "c"), (3, None)]]
    for at, rows in enumerate(versions):
        changes = frame(spark, {**ROW, "row_insrt_tms": "ts", "row_updt_tms": "ts"}, [(*r, ts("2024-01-01"), ts("2024-01-02")) for r in rows])
        store.publish(changes, expect_version=at, run_ts=ts("2024-01-05"), changes=changes if at else None)
    table = store.read()
    assert sorted(rows_of(table, ["k", "v"]), key=str) == [(1, "b"), (2, "c"), (3, None), (4, None)]
    assert "Aggregate" not in _plan(table)


def test_the_last_change_set_is_taken_for_null_keys_too(spark):
    sets = [frame(spark, ROW, [(None, "a"), (1, "a"), (2, "a")]), frame(spark, ROW, [(None, "b"), (1, "b")])]
    found = newest_changes(sets, ["k"], unique=True)
    assert sorted(map(tuple, found.collect()), key=str) == [(1, "b"), (2, "a"), (None, "b")]


def test_promotions_are_compared_and_stored_before_they_are_widened(spark, tmp_path):
    orders = [(1, 7, "O", 5.0, ts("1995-01-02 00:00:00"), "1-URGENT"), (9, 7, "O", 4.0, ts("1995-01-02 10:00:00"), "1-URGENT"),
              (9, 7, "O", 6.0, ts("1995-01-02 00:00:00"), "1-URGENT"), (None, 7, "F", 1.0, None, None), (3, None, "F", None, None, "2-HIGH")]
    columns = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
               "o_orderdate": "ts", "o_orderpriority": "string"}
    frame(spark, columns, orders).write.parquet(f"{tmp_path}/orders.parquet")
    found, whole = V.direct_src(spark, str(tmp_path), keep_orderkey=True), dedupe_newest(V.direct_raw(spark, str(tmp_path)), V.DIRECT_KEY, ["o_orderkey"])
    assert found.columns == whole.columns and found.dtypes == whole.dtypes
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))
    path, schema = next(v for k, v in V._STORED.items() if k[1] == str(tmp_path) and k[2] == "direct_src")
    assert len(schema) == 6
    assert d("1995-01-02") in {r["promo_dt"] for r in spark.read.parquet(path).collect()}


def test_index_entries_are_joined_once(spark):
    """Both tables written from the entries read what was stored."""
    index = ReferenceIndex(None, "sites", ["k"], "ref", "ky")
    source = frame(spark, {"k": "bigint", "ref": "bigint", "ky": "bigint"}, [(1, 5, 50), (2, 6, 60)])
    result = frame(spark, {"k": "bigint", "ky": "bigint"}, [(1, 50), (2, 61)])
    live = frame(spark, {"ref": "bigint", "ky": "bigint"}, [(5, 50), (6, 60)])
    side = index.built(source, result, live, lambda df: stored_table(df)[0])
    assert rows_of(side["sites_pending"].rows, ["k", "resolved", "held"]) == [(2, 60, 61)]
    assert rows_of(side["sites_entries"].rows, ["k", "resolved", "held"]) == [(1, 50, 50), (2, 60, 61)]
    assert not any("Join" in _plan(side[f"sites_{n}"].rows) for n in ("entries", "pending"))
