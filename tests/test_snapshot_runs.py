"""Publish, restart and two-run behaviour (B5 edge inputs)."""

import tempfile

import pytest
from conftest import full_frame, rows_of, ts
from test_golden_jobs import CMPY_SRC, CMPY_TGT

from martloom.plans import company
from martloom.plans.runner import run_load
from martloom.sources.snapshot import SnapshotStore


def _schema(spark):
    return full_frame(spark, CMPY_TGT, []).schema


def _src(spark, rows):
    return full_frame(spark, CMPY_SRC, [
        dict(spls_cmpy_id=i, parnt_cmpy_id=p, ultmt_parnt_cmpy_id=u, cmpy_nm=i, row_updt_tms=t, row_stat_cd=s)
        for i, p, u, t, s in rows
    ])


def _job(source):
    return lambda target, window, hw: company.run(source, target, window, hw)


def test_two_runs_heal_late_parent(spark):
    store = SnapshotStore(spark, tempfile.mkdtemp(prefix="ml-store-"))
    run1 = _src(spark, [("K", "P", None, ts("2024-01-05 00:00:00"), "NEW")])
    r1 = run_load(store, "cmpy", "SPLS_CMPY_KY", _job(run1), schema=_schema(spark), initial_high_water=0,
                  now=ts("2024-01-06 00:00:00"))
    assert r1.state.version == 1 and r1.state.high_water["SPLS_CMPY_KY"] == 1
    assert rows_of(store.read(), ["spls_cmpy_id", "parnt_cmpy_ky"]) == [("K", -1)]

    # the parent arrives later; K itself is unchanged and outside the window
    run2 = _src(spark, [("K", "P", None, ts("2024-01-05 00:00:00"), "NEW"),
                        ("P", None, None, ts("2024-01-07 00:00:00"), "NEW")])
    r2 = run_load(store, "cmpy", "SPLS_CMPY_KY", _job(run2), schema=_schema(spark), now=ts("2024-01-08 00:00:00"))
    assert r2.window.lo == ts("2024-01-06 00:00:00")
    assert r2.state.high_water["SPLS_CMPY_KY"] == 2
    got = rows_of(store.read(), ["spls_cmpy_ky", "spls_cmpy_id", "parnt_cmpy_ky", "row_stat_cd", "row_updt_tms"])
    assert got == [(1, "K", 2, "NEW", ts("2024-01-08 00:00:00")), (2, "P", 0, "NEW", ts("2024-01-08 00:00:00"))]


def test_failure_before_publish_keeps_old_state_and_rerun_equals_clean(spark):
    root = tempfile.mkdtemp(prefix="ml-store-")
    store = SnapshotStore(spark, root)
    src = _src(spark, [("A", None, None, ts("2024-01-05 00:00:00"), "NEW")])
    run_load(store, "cmpy", "SPLS_CMPY_KY", _job(src), schema=_schema(spark), initial_high_water=10,
             now=ts("2024-01-06 00:00:00"))
    before = store.state()

    src2 = _src(spark, [("A", None, None, ts("2024-01-05 00:00:00"), "NEW"),
                        ("B", "A", None, ts("2024-01-07 00:00:00"), "NEW")])

    def failing(target, window, hw):
        res = company.run(src2, target, window, hw)
        res.table.count()  # work done, then the run dies before publish
        raise RuntimeError("executor lost for good")

    with pytest.raises(RuntimeError):
        run_load(store, "cmpy", "SPLS_CMPY_KY", failing, schema=_schema(spark), now=ts("2024-01-08 00:00:00"))
    after = store.state()
    assert after == before  # counter, window and version untouched

    r = run_load(store, "cmpy", "SPLS_CMPY_KY", _job(src2), schema=_schema(spark), now=ts("2024-01-09 00:00:00"))
    assert r.window.lo == ts("2024-01-06 00:00:00")  # same window resumed
    assert rows_of(store.read(), ["spls_cmpy_ky", "spls_cmpy_id", "parnt_cmpy_ky"]) == [(11, "A", 0), (12, "B", 11)]


def test_missing_counter_fails_before_write(spark):
    store = SnapshotStore(spark, tempfile.mkdtemp(prefix="ml-store-"))
    src = _src(spark, [("A", None, None, ts("2024-01-05 00:00:00"), "NEW")])
    with pytest.raises(LookupError):
        run_load(store, "cmpy", "SPLS_CMPY_KY", _job(src), schema=_schema(spark))
    assert store.state() is None


def test_version_check_refuses_stale_writer(spark):
    store = SnapshotStore(spark, tempfile.mkdtemp(prefix="ml-store-"))
    df = full_frame(spark, CMPY_TGT, [])
    store.publish(df, expect_version=0, high_water={"K": 1})
    with pytest.raises(RuntimeError):
        store.publish(df, expect_version=0, high_water={"K": 2})
    assert store.state().version == 1 and store.state().high_water == {"K": 1}


def test_same_window_twice_keeps_keys(spark):
    """Re-running a committed window: keys unchanged, NEW becomes UPDT."""
    src, tgt = full_frame(spark, CMPY_SRC, [dict(spls_cmpy_id="A", row_updt_tms=ts("2024-01-10 01:00:00"),
                                                 row_stat_cd="NEW")]), full_frame(spark, CMPY_TGT, [])
    from martloom.sources.control import LoadWindow

    w = LoadWindow("x", ts("2024-01-10 00:00:00"), ts("2024-01-11 00:00:00"))
    first = company.run(src, tgt, w, 5).table.checkpoint()
    w2 = LoadWindow("x", ts("2024-01-10 00:00:00"), ts("2024-01-12 00:00:00"))
    second = company.run(src, first, w2, 6)
    assert second.assigned == 0 and second.high_water == 6
    assert rows_of(second.table, ["spls_cmpy_ky", "row_stat_cd"]) == [(6, "UPDT")]


def test_row_conservation_guard_blocks_commit(spark):
    """G5: a result that loses or duplicates target rows is written but never committed."""
    from martloom.operators.guards import GuardError

    store = SnapshotStore(spark, tempfile.mkdtemp(prefix="ml-store-"))
    src = _src(spark, [("A", None, None, ts("2024-01-05 00:00:00"), "NEW")])
    run_load(store, "cmpy", "SPLS_CMPY_KY", _job(src), schema=_schema(spark), initial_high_water=0,
             now=ts("2024-01-06 00:00:00"))

    def duplicating(target, window, hw):
        res = company.run(src, target, window, hw)
        res.table = res.table.unionByName(res.table)
        return res

    with pytest.raises(GuardError):
        run_load(store, "cmpy", "SPLS_CMPY_KY", duplicating, schema=_schema(spark), now=ts("2024-01-07 00:00:00"))
    assert store.state().version == 1 and store.read().count() == 1


def test_bucketed_store_merges_without_shuffling_the_target(spark):
    """A store bucketed by the natural key: the next run's merge join reads the
    target bucket by bucket and shuffles only the source side."""
    from martloom.operators.merge import apply_changes

    store = SnapshotStore(spark, tempfile.mkdtemp(prefix="ml-store-"), bucket_by=(4, ["spls_cmpy_id"]))
    src = _src(spark, [(c, None, None, ts("2024-01-05 00:00:00"), "NEW") for c in "ABCDEFGH"])
    run_load(store, "cmpy", "SPLS_CMPY_KY", _job(src), schema=_schema(spark), initial_high_water=0,
             now=ts("2024-01-06 00:00:00"))
    src2 = _src(spark, [("A", "B", None, ts("2024-01-07 00:00:00"), "DEL"),
                        ("Z", "A", None, ts("2024-01-07 00:00:00"), "NEW")])
    r2 = run_load(store, "cmpy", "SPLS_CMPY_KY", _job(src2), schema=_schema(spark), now=ts("2024-01-08 00:00:00"))
    assert r2.state.bucketing == {"buckets": 4, "columns": ["spls_cmpy_id"]}
    got = rows_of(store.read(_schema(spark)), ["spls_cmpy_ky", "spls_cmpy_id", "parnt_cmpy_ky", "row_stat_cd"])
    assert got[0] == (1, "A", 2, "DEL") and got[-1] == (9, "Z", -1, "NEW") and len(got) == 9

    target = store.read(_schema(spark))
    changes = src2.select("spls_cmpy_id", "cmpy_nm", "row_stat_cd")
    out = apply_changes(target, changes, ["spls_cmpy_id"], run_ts="2024-02-01 00:00:00", update_cols=["cmpy_nm"])
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in p, p
    assert p.count("Exchange hashpartitioning") == 1, p  # the source side only


def test_bucketed_inserts_write_one_file_per_bucket(spark):
    import glob

    store = SnapshotStore(spark, tempfile.mkdtemp(prefix="ml-store-"), bucket_by=(3, ["spls_cmpy_id"]))
    src = _src(spark, [(f"C{i:03d}", None, None, ts("2024-01-05 00:00:00"), "NEW") for i in range(60)])
    job = lambda target, window, hw: company.run(
        src.repartition(7), target, window, hw, insert_buckets=(3, ["spls_cmpy_id"]))
    run_load(store, "cmpy", "SPLS_CMPY_KY", job, schema=_schema(spark), initial_high_water=0,
             now=ts("2024-01-06 00:00:00"))
    files = glob.glob(store.data_path(store.state().run) + "/*.parquet")
    assert 1 <= len(files) <= 3, files
    assert store.read(_schema(spark)).count() == 60


def test_null_status_parent_is_live_only_from_the_next_run(spark):
    store = SnapshotStore(spark, tempfile.mkdtemp(prefix="ml-store-"))
    src = _src(spark, [("P", None, None, ts("2024-01-05 00:00:00"), None),
                       ("K", "P", None, ts("2024-01-05 00:00:00"), "NEW")])
    run_load(store, "cmpy", "SPLS_CMPY_KY", _job(src), schema=_schema(spark), initial_high_water=0,
             now=ts("2024-01-06 00:00:00"))
    assert rows_of(store.read(), ["spls_cmpy_id", "parnt_cmpy_ky", "row_stat_cd"]) == [("K", -1, "NEW"),
                                                                                     ("P", 0, "NEW")]
    # nothing new in the source: an empty delta, only the loopback acts
    r2 = run_load(store, "cmpy", "SPLS_CMPY_KY", _job(src), schema=_schema(spark), now=ts("2024-01-07 00:00:00"))
    assert r2.result.profile.rows == 0 and r2.result.assigned == 0
    assert r2.state.high_water["SPLS_CMPY_KY"] == 2
    assert rows_of(store.read(), ["spls_cmpy_id", "parnt_cmpy_ky", "row_updt_tms"]) == [
        ("K", 2, ts("2024-01-07 00:00:00")), ("P", 0, ts("2024-01-06 00:00:00"))]


def test_partitioned_store_rewrites_only_touched_partitions(spark):
    import os

    from pyspark.sql import functions as F

    root = tempfile.mkdtemp(prefix="ml-store-")
    store = SnapshotStore(spark, root, partition_by=F.col("spls_cmpy_ky") % 4)
    ids = "ABCDEFGH"
    src1 = _src(spark, [(c, "Z" if c == "C" else None, None, ts("2024-01-05 00:00:00"), "NEW") for c in ids])
    r1 = run_load(store, "cmpy", "SPLS_CMPY_KY", _job(src1), schema=_schema(spark), initial_high_water=0,
                  now=ts("2024-01-06 00:00:00"))
    one = r1.state.run
    assert r1.state.partitions == dict.fromkeys("0123", one)
    # run 2: A (key 1) changes; Z arrives, so the loopback heals C (key 3)
    src2 = _src(spark, [(c, "Z" if c == "C" else None, None, ts("2024-01-05 00:00:00"), "NEW") for c in ids[1:]]
                + [("A", None, None, ts("2024-01-07 00:00:00"), "DEL"), ("Z", None, None, ts("2024-01-07 00:00:00"), "NEW")])
    r2 = run_load(store, "cmpy", "SPLS_CMPY_KY", _job(src2), schema=_schema(spark), now=ts("2024-01-08 00:00:00"))
    # key 1 (A) -> p1, key 3 (C, healed) -> p3, key 9 (Z, new) -> p1
    two = r2.state.run
    assert r2.state.partitions == {"0": one, "1": two, "2": one, "3": two}
    assert sorted(n for n in os.listdir(store.data_path(two)) if n.startswith("_ml_p")) == ["_ml_p=1", "_ml_p=3"]
    got = rows_of(store.read(_schema(spark)), ["spls_cmpy_ky", "spls_cmpy_id", "parnt_cmpy_ky", "row_stat_cd"])
    assert got == [(1, "A", 0, "DEL"), (2, "B", 0, "NEW"), (3, "C", 9, "NEW"), (4, "D", 0, "NEW"),
                   (5, "E", 0, "NEW"), (6, "F", 0, "NEW"), (7, "G", 0, "NEW"), (8, "H", 0, "NEW"),
                   (9, "Z", 0, "NEW")]
    assert r2.state.stats["rows"] == 9


def test_duplicate_untouched_source_rows_fail_the_run(spark):
    """G1 checks only the delta; a natural key repeated among the untouched source
    rows would fan the loopback out, and G5 stops the commit."""
    from martloom.operators.guards import GuardError

    store = SnapshotStore(spark, tempfile.mkdtemp(prefix="ml-store-"))
    src = _src(spark, [("A", None, None, ts("2024-01-05 00:00:00"), "NEW"),
                       ("B", "A", None, ts("2024-01-05 00:00:00"), "NEW")])
    run_load(store, "cmpy", "SPLS_CMPY_KY", _job(src), schema=_schema(spark), initial_high_water=0,
             now=ts("2024-01-06 00:00:00"))
    dup = _src(spark, [("A", None, None, ts("2024-01-05 00:00:00"), "NEW"),
                       ("B", "A", None, ts("2024-01-05 00:00:00"), "NEW"),
                       ("B", "Z", None, ts("2024-01-04 00:00:00"), "NEW")])
    with pytest.raises(GuardError):
        run_load(store, "cmpy", "SPLS_CMPY_KY", _job(dup), schema=_schema(spark), now=ts("2024-01-07 00:00:00"))
    assert store.state().version == 1


def test_partitioned_store_run_without_changes_writes_nothing(spark):
    import glob

    from pyspark.sql import functions as F

    root = tempfile.mkdtemp(prefix="ml-store-")
    store = SnapshotStore(spark, root, partition_by=F.col("spls_cmpy_ky") % 2)
    src = _src(spark, [(c, None, None, ts("2024-01-05 00:00:00"), "NEW") for c in "ABC"])
    r1 = run_load(store, "cmpy", "SPLS_CMPY_KY", _job(src), schema=_schema(spark), initial_high_water=0,
                  now=ts("2024-01-06 00:00:00"))
    r2 = run_load(store, "cmpy", "SPLS_CMPY_KY", _job(src), schema=_schema(spark), now=ts("2024-01-07 00:00:00"))
    assert r2.state.version == 2 and r2.state.partitions == r1.state.partitions
    assert not glob.glob(store.data_path(r2.state.run))
    assert store.read(_schema(spark)).count() == 3
    assert r2.state.committed_run_ts == ts("2024-01-07 00:00:00")  # the window still moves on


def test_publish_snapshot_entry_point_and_exports(spark):
    import martloom
    from martloom import publish_snapshot

    assert all(hasattr(martloom, n) for n in martloom.__all__)
    store = SnapshotStore(spark, tempfile.mkdtemp(prefix="ml-store-"))
    st = publish_snapshot(store, full_frame(spark, CMPY_TGT, []), expect_version=0, high_water={"K": 5},
                          run_ts=ts("2024-01-06 00:00:00"), process="p")
    assert st.version == 1 and store.state() == st and store.read().count() == 0


@pytest.mark.parametrize("kind", ["plain", "bucketed", "partitioned"])
def test_two_interleaved_writers_leave_the_winner_readable(spark, kind):
    """B starts from version 1, A commits version 2 while B still writes: B is refused, A's rows stay."""
    from pyspark.sql import functions as F

    from martloom.sources.snapshot import VersionConflict

    options = {"plain": {}, "bucketed": {"bucket_by": (2, ["spls_cmpy_id"])},
               "partitioned": {"partition_by": F.col("spls_cmpy_ky") % 2}}[kind]
    root = tempfile.mkdtemp(prefix="ml-store-")
    a, b = SnapshotStore(spark, root, **options), SnapshotStore(spark, root, **options)

    def rows(name, day):
        return full_frame(spark, CMPY_TGT, [dict(spls_cmpy_ky=i, spls_cmpy_id=f"{name}{i}", row_updt_tms=day) for i in (1, 2)])

    day = [ts(f"2024-01-0{i} 00:00:00") for i in (1, 2, 3)]
    a.publish(rows("first", day[0]), expect_version=0, run_ts=day[0])
    done = []

    def overtaken(_written):
        if not done:
            done.append(a.publish(rows("a", day[1]), expect_version=1, run_ts=day[1], high_water={"K": 2}))

    with pytest.raises(VersionConflict):
        b.publish(rows("b", day[2]), expect_version=1, run_ts=day[2], high_water={"K": 9}, verify=overtaken)
    assert a.state() == done[0] and a.state().high_water == {"K": 2}
    ids = sorted(r[0] for r in a.read(full_frame(spark, CMPY_TGT, []).schema).select("spls_cmpy_id").collect())
    assert ids == (["a1", "a2"] if kind != "partitioned" else ["a1", "a2"])
    gone = a.vacuum(keep=1)
    assert gone and a.versions() == [2]
    assert sorted(r[0] for r in a.read(full_frame(spark, CMPY_TGT, []).schema).select("spls_cmpy_id").collect()) == ids


def test_unreadable_state_is_an_error(spark):
    import os

    root = tempfile.mkdtemp(prefix="ml-store-")
    store = SnapshotStore(spark, root)
    store.publish(full_frame(spark, CMPY_TGT, []), expect_version=0)
    with open(f"{root}/_state/v=1", "w") as f:
        f.write("{broken")
    for crc in (n for n in os.listdir(f"{root}/_state") if n.endswith(".crc")):
        os.remove(f"{root}/_state/{crc}")
    with pytest.raises(ValueError):
        store.state()


def test_counter_behind_the_table_fails_before_commit(spark):
    from martloom.operators.guards import GuardError

    store = SnapshotStore(spark, tempfile.mkdtemp(prefix="ml-store-"))
    tgt = full_frame(spark, CMPY_TGT, [dict(spls_cmpy_ky=5, spls_cmpy_id="A", row_insrt_tms=ts("2024-01-01 00:00:00"),
                                            row_updt_tms=ts("2024-01-01 00:00:00"), row_stat_cd="NEW")])
    store.publish(tgt, expect_version=0, high_water={"SPLS_CMPY_KY": 4}, run_ts=ts("2024-01-02 00:00:00"))
    src = _src(spark, [("B", None, None, ts("2024-01-05 00:00:00"), "NEW")])
    with pytest.raises(GuardError):
        run_load(store, "cmpy", "SPLS_CMPY_KY", _job(src), schema=_schema(spark), now=ts("2024-01-06 00:00:00"))
    assert store.state().version == 1


def test_open_window_is_stored_and_resumed(spark):
    store = SnapshotStore(spark, tempfile.mkdtemp(prefix="ml-store-"))
    src = _src(spark, [("A", None, None, ts("2024-01-05 00:00:00"), "NEW")])
    seen = []

    def dying(target, window, hw):
        seen.append(window)
        raise RuntimeError("lost")

    for day in ("06", "07"):
        with pytest.raises(RuntimeError):
            run_load(store, "cmpy", "SPLS_CMPY_KY", dying, schema=_schema(spark), initial_high_water=0,
                     now=ts(f"2024-01-{day} 00:00:00"))
    assert [w.resumed for w in seen] == [False, True] and store.open_window("cmpy")["run_ts"] == "2024-01-07T00:00:00"
    r = run_load(store, "cmpy", "SPLS_CMPY_KY", _job(src), schema=_schema(spark), initial_high_water=0,
                 now=ts("2024-01-08 00:00:00"))
    assert r.window.resumed and r.window.run_ts == ts("2024-01-08 00:00:00") and store.open_window("cmpy") is None
    late = run_load(store, "cmpy", "SPLS_CMPY_KY", _job(src), schema=_schema(spark), now=ts("2024-01-09 00:00:00"),
                    start=ts("2024-01-04 00:00:00"))
    assert late.window.lo == ts("2024-01-04 00:00:00") and late.result.profile.rows == 1


def test_source_that_grows_during_the_run_changes_nothing(spark):
    """The source is read once and stored: rows that arrive afterwards wait for the next run."""
    inbox = tempfile.mkdtemp(prefix="ml-inbox-")
    _src(spark, [("A", None, None, ts("2024-01-05 00:00:00"), "NEW")]).write.parquet(f"{inbox}/part=1")
    schema = _src(spark, []).schema
    from martloom.sources.control import LoadWindow

    source = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(inbox)
    res = company.run(source, full_frame(spark, CMPY_TGT, []), LoadWindow("x", ts("2024-01-01 00:00:00"), ts("2024-01-06 00:00:00")), 0)
    _src(spark, [("B", None, None, ts("2024-01-05 00:00:00"), "NEW")]).write.parquet(f"{inbox}/part=2")
    spark.catalog.refreshByPath(inbox)
    assert rows_of(res.table, ["spls_cmpy_ky", "spls_cmpy_id"]) == [(1, "A")]
