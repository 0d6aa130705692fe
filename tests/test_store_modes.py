"""Quarantine and replay, window leases, change sets, observed guards."""

import glob
import os
import random
import tempfile
from datetime import datetime, timedelta

import pytest
from conftest import full_frame, rows_of, ts
from pyspark.sql import functions as F
from test_golden_jobs import CMPY_SRC, CMPY_TGT, EML_SRC, EML_TGT, calendar

from martloom.operators.guards import GuardError
from martloom.plans import company, email
from martloom.plans.runner import open_window, run_load
from martloom.sources.lease import LeaseLost, WindowBusy
from martloom.sources.snapshot import SideChange, SnapshotStore

DAY = [ts(f"2024-01-{i:02d} 00:00:00") for i in range(1, 29)]


def _root():
    return tempfile.mkdtemp(prefix="ml-store-")


def _schema(spark):
    return full_frame(spark, CMPY_TGT, []).schema


def _src(spark, rows):
    return full_frame(spark, CMPY_SRC, [
        dict(spls_cmpy_id=i, parnt_cmpy_id=p, cmpy_nm=n, row_updt_tms=t, row_stat_cd="NEW") for i, p, n, t in rows])


def _load(store, spark, src, day, **kw):
    def job(target, window, hw, repaired=None):
        return company.run(src, target, window, hw, replayed=repaired)

    return run_load(store, "cmpy", "K", job, schema=_schema(spark), initial_high_water=0, now=DAY[day], **kw)


# ------------------------------------------------------------------ quarantine
def test_rejected_rows_survive_the_run_and_are_replayed(spark):
    store = SnapshotStore(spark, _root())
    first = _load(store, spark, _src(spark, [("A", None, "a", DAY[1]), (None, "A", "lost", DAY[1]), (None, None, "gone", DAY[1])]), 3)
    assert first.state.stats["quarantined"] == 2
    assert sorted(r.cmpy_nm for r in first.quarantined.collect()) == ["gone", "lost"]
    nothing = _src(spark, [("A", None, "a", DAY[1])])
    second = _load(store, spark, nothing, 5)          # a run that does not replay leaves them
    assert second.quarantined is None and store.quarantined().count() == 2

    def repair(rejected):
        return rejected.withColumn("spls_cmpy_id", F.when(F.col("cmpy_nm") == "lost", "B"))

    third = _load(store, spark, nothing, 7, replay=repair)
    assert third.result.replayed == 2 and third.result.assigned == 1
    assert rows_of(store.read(), ["spls_cmpy_ky", "spls_cmpy_id", "parnt_cmpy_ky"]) == [(1, "A", 0), (2, "B", 1)]
    assert [r.cmpy_nm for r in store.quarantined().collect()] == ["gone"]  # rejected once more
    assert set(third.state.quarantine) == {third.state.run}
    fourth = _load(store, spark, nothing, 9, replay=lambda r: r.filter("false"))
    assert not fourth.state.quarantine and store.quarantined() is None
    store.vacuum(keep=1)
    assert not glob.glob(f"{store.root}/quarantine/run=*")


def test_vacuum_keeps_what_waits_for_a_replay(spark):
    store = SnapshotStore(spark, _root())
    _load(store, spark, _src(spark, [(None, None, "x", DAY[1])]), 3)
    for day in (5, 7, 9):
        _load(store, spark, _src(spark, [("A", None, "a", DAY[1])]), day)
    store.vacuum(keep=1)
    assert [r.cmpy_nm for r in store.quarantined().collect()] == ["x"]


def test_the_source_s_own_row_wins_over_a_replayed_one(spark):
    store = SnapshotStore(spark, _root())
    _load(store, spark, _src(spark, [("A", None, "a", DAY[1]), (None, None, "B", DAY[1]), (None, None, "A", DAY[1])]), 3)
    later = _src(spark, [("A", None, "a", DAY[1]), ("B", None, "the source's B", DAY[4])])
    report = _load(store, spark, later, 5, replay=lambda r: r.withColumn("spls_cmpy_id", F.col("cmpy_nm")))
    assert report.state.stats["rows"] == 2
    # B: the source's row; A: the repaired row stands for the untouched source row
    assert rows_of(store.read(), ["spls_cmpy_id", "cmpy_nm"]) == [("A", "A"), ("B", "the source's B")]


def test_a_failed_replay_leaves_the_quarantine(spark):
    store = SnapshotStore(spark, _root())
    _load(store, spark, _src(spark, [(None, None, "x", DAY[1]), (None, None, "y", DAY[1])]), 3)
    before = store.state()
    with pytest.raises(GuardError):  # both repaired to one key
        _load(store, spark, _src(spark, []), 5, replay=lambda r: r.withColumn("spls_cmpy_id", F.lit("Z")))
    assert store.state() == before and store.quarantined().count() == 2


# ---------------------------------------------------------------------- leases
class Clock:
    def __init__(self):
        self.now = datetime(2024, 3, 1)

    def __call__(self):
        return self.now


def test_a_second_run_waits_for_the_lease_and_the_first_is_fenced(spark):
    clock = Clock()
    a, b = (SnapshotStore(spark, root, clock=clock) for root in [_root()] * 2)
    window_a, lease_a = open_window(a, "cmpy", None, now=DAY[3])
    with pytest.raises(WindowBusy):
        open_window(b, "cmpy", None, now=DAY[4])
    clock.now += timedelta(hours=2)
    window_b, lease_b = open_window(b, "cmpy", None, now=DAY[4])
    assert (lease_b.sequence, lease_b.taken_over, window_b.resumed, window_b.lo) == (2, True, True, window_a.lo)
    assert a.leases.holds(lease_b) and not a.leases.holds(lease_a)
    with pytest.raises(LeaseLost):
        a.leases.renew(lease_a)
    with pytest.raises(LeaseLost):
        a.publish(full_frame(spark, CMPY_TGT, []), expect_version=0, lease=lease_a)
    a.leases.end(lease_a, committed=True)          # the former owner's close removes nothing
    assert b.leases.holds(lease_b) and b.open_window("cmpy")["owner"] == lease_b.owner
    b.publish(full_frame(spark, CMPY_TGT, []), expect_version=0, lease=lease_b)
    b.leases.end(lease_b, committed=True)
    assert b.open_window("cmpy") is None
    assert open_window(a, "cmpy", None, now=DAY[5])[1].sequence == 3  # numbers are never used twice


def test_of_two_runs_that_start_together_one_gets_the_window(spark, monkeypatch):
    root = _root()
    a, b = SnapshotStore(spark, root), SnapshotStore(spark, root)
    taken = []
    save = a.save

    def late(path, record, *, exclusive):
        if not taken and exclusive:
            taken.append(open_window(b, "cmpy", None, now=DAY[3]))
        save(path, record, exclusive=exclusive)

    monkeypatch.setattr(a, "save", late)
    with pytest.raises(WindowBusy):
        open_window(a, "cmpy", None, now=DAY[3])
    assert b.leases.holds(taken[0][1])


def test_a_renewed_lease_is_not_taken_over(spark):
    clock = Clock()
    store = SnapshotStore(spark, _root(), clock=clock)
    _, lease = open_window(store, "cmpy", None, now=DAY[3], lease=timedelta(minutes=10))
    clock.now += timedelta(minutes=9)
    store.leases.renew(lease, timedelta(minutes=10))
    clock.now += timedelta(minutes=9)
    with pytest.raises(WindowBusy):
        open_window(store, "cmpy", None, now=DAY[4])


def test_a_long_run_renews_its_lease(spark):
    import time

    store = SnapshotStore(spark, _root())
    seen = []

    def slow(target, window, hw):
        seen.append(store.open_window("cmpy")["expires"])
        deadline = time.time() + 20
        while store.open_window("cmpy")["expires"] == seen[0] and time.time() < deadline:
            time.sleep(0.2)
        seen.append(store.open_window("cmpy")["expires"])
        return company.run(_src(spark, [("A", None, "a", DAY[1])]), target, window, hw)

    run_load(store, "cmpy", "K", slow, schema=_schema(spark), initial_high_water=0, now=DAY[3], lease=timedelta(seconds=60 * 0.1))
    assert seen[1] > seen[0] and store.open_window("cmpy") is None


def test_processes_have_windows_of_their_own(spark):
    store = SnapshotStore(spark, _root())
    open_window(store, "one", None, now=DAY[3])
    assert open_window(store, "two", None, now=DAY[3])[1].sequence == 1


# ----------------------------------------------------------------- change sets
def _random_runs(seed, runs=5):
    rng = random.Random(seed)
    rows, out = {}, []
    for day in range(runs):
        changed = rng.sample([f"C{i}" for i in range(12)], rng.randint(0, 5))
        for c in changed:
            rows[c] = (c, rng.choice([None, "C1", "C7", "C11"]), f"{c} of {day}", DAY[2 * day + 1])
        out.append(list(rows.values()))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_all_kinds_of_store_hold_the_same_table(spark, seed):
    kinds = {"plain": {}, "changes": dict(key=["spls_cmpy_id"], compact_at=0.6),
             "partitions": dict(partition_by=F.col("spls_cmpy_ky") % 3, key=["spls_cmpy_id"])}
    stores = {k: SnapshotStore(spark, _root(), **o) for k, o in kinds.items()}
    columns = ["spls_cmpy_ky", "spls_cmpy_id", "parnt_cmpy_ky", "cmpy_nm", "row_stat_cd", "row_updt_tms", "row_insrt_tms"]
    for day, rows in enumerate(_random_runs(seed)):
        reports = {k: _load(s, spark, _src(spark, rows), 2 * day + 2) for k, s in stores.items()}
        tables = {k: rows_of(s.read(_schema(spark)), columns) for k, s in stores.items()}
        assert tables["plain"] == tables["changes"] == tables["partitions"]
        assert len({r.state.stats["rows"] for r in reports.values()}) == 1
        assert len({r.state.stats.get("top") for r in reports.values()}) == 1


def _size(store, run):
    return sum(os.path.getsize(f) for f in glob.glob(f"{store.data_path(run)}/**/*.parquet", recursive=True))


def test_a_small_run_writes_in_proportion_to_its_delta(spark):
    store = SnapshotStore(spark, _root(), key=["eml_ky", "src_cd"], compact_at=0.5)
    cal, schema = calendar(spark), full_frame(spark, EML_TGT, []).schema

    def source(n, day, step=1):
        return spark.range(0, n, step).select(
            F.col("id").alias("eml_ky"), F.lit("X").alias("src_cd"), F.sha2(F.col("id").cast("string"), 512).alias("sls_rep_nm"),
            F.lit("NEW").alias("row_stat_cd"), F.lit(str(DAY[day])).cast("timestamp_ntz").alias("row_updt_tms")
        ).unionByName(full_frame(spark, EML_SRC, []), allowMissingColumns=True).select(*full_frame(spark, EML_SRC, []).columns)

    def load(src, day):
        return run_load(store, "eml", "K", lambda t, w, hw: email.run(src.coalesce(2), t, cal, w, hw), schema=schema,
                        initial_high_water=0, now=DAY[day]).state

    base = load(source(20_000, 1), 2)
    small = load(source(20_000, 3, 100), 4)                   # one per cent
    assert small.layers["base"] == base.run and small.layers["changes"] == [{"run": small.run, "rows": 200}]
    assert _size(store, small.run) < 0.03 * _size(store, base.run)
    large = load(source(20_000, 5, 2), 6)                     # past the ratio: a new base
    assert large.layers["changes"] == [] and large.layers["rows"] == 20_000
    updated = store.read(schema).groupBy("row_updt_tms").count().collect()
    assert {r.row_updt_tms: r["count"] for r in updated} == {DAY[2]: 10_000, DAY[6]: 10_000}  # every 100th was changed twice
    store.vacuum(keep=1)
    assert store.read(schema).count() == 20_000 and not os.path.exists(store.data_path(base.run))


def test_a_key_changed_twice_in_one_run_is_refused(spark):
    store = SnapshotStore(spark, _root(), key=["spls_cmpy_id"], compact_at=5.0)
    rows = [("A", None, "a", DAY[1]), ("B", "A", "b", DAY[1])]
    _load(store, spark, _src(spark, rows), 2)
    with pytest.raises(GuardError):  # B twice among the untouched rows, both healed by the loopback
        _load(store, spark, _src(spark, [rows[0], ("B", "Z", "b", DAY[0]), ("B", "Q", "b", DAY[0])]), 4)
    assert store.state().version == 1


# ----------------------------------------------------------------- side tables
def test_side_tables_are_versioned_with_the_state(spark):
    store = SnapshotStore(spark, _root())
    main = full_frame(spark, CMPY_TGT, [])

    def side(rows, **kw):
        df = spark.createDataFrame(rows, "k string, v long, _ml_gone boolean")
        return {"counts": SideChange(df, ["k"], **kw)}

    store.publish(main, expect_version=0, side=side([("a", 1, False), (None, 2, False), ("b", 3, False), ("c", 9, False)] * 1))
    store.publish(main, expect_version=1, side=side([(None, 5, False), ("b", None, True)]))
    store.publish(main, expect_version=2)
    key = lambda r: (r[0] is not None, r[0] or "")
    assert sorted(map(tuple, store.side("counts").collect()), key=key) == [(None, 5), ("a", 1), ("c", 9)]
    assert sorted(map(tuple, store.side("counts", 1).collect()), key=key) == [(None, 2), ("a", 1), ("b", 3), ("c", 9)]
    store.vacuum(keep=1)
    assert sorted(map(tuple, store.side("counts").collect()), key=key) == [(None, 5), ("a", 1), ("c", 9)]
    store.publish(main, expect_version=3, side=side([("z", 1, False)], whole=True))
    assert [tuple(r) for r in store.side("counts").collect()] == [("z", 1)] and store.side("other") is None


# ------------------------------------------------------------- observed guards
def test_guards_scan_neither_the_target_nor_the_written_table(spark, monkeypatch):
    """Every action of a run on files of the store is a merge or the write itself: no aggregate is."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    store = SnapshotStore(spark, _root())
    rows = [(f"C{i}", None, "x", DAY[1]) for i in range(20)]
    _load(store, spark, _src(spark, rows), 2)
    scans = []

    def watched(name):
        plain = getattr(Classic, name)

        def run(self, *args, **kw):
            scans.append((name, self._jdf.queryExecution().optimizedPlan().toString(), self.inputFiles()))
            return plain(self, *args, **kw)
        return run

    for name in ("count", "first", "collect", "isEmpty", "take"):
        monkeypatch.setattr(Classic, name, watched(name))
    _load(store, spark, _src(spark, [*rows, ("N", None, "new", DAY[3])]), 4)
    assert not [s for s in scans if any(f"{store.root}/data" in f for f in s[2])], scans
    monkeypatch.undo()
    assert store.state().stats["rows"] == 21 and store.state().stats["top"] == 21


@pytest.mark.parametrize("fault", ["repeated", "old", "missing", "outside"])
def test_wrong_new_keys_are_found_while_writing(spark, fault):
    store = SnapshotStore(spark, _root())
    _load(store, spark, _src(spark, [(f"C{i}", None, "x", DAY[1]) for i in range(4)]), 2)
    src = _src(spark, [(f"N{i}", None, "x", DAY[3]) for i in range(4)])
    key = F.col("spls_cmpy_ky")
    wrong = {"repeated": F.when(key == 7, 6).otherwise(key), "old": F.when(key == 7, 2).otherwise(key),
             "missing": F.when(key != 7, key), "outside": F.when(key == 7, 70).otherwise(key)}[fault]

    def job(target, window, hw):
        res = company.run(src, target, window, hw)
        res.table = res.table.withColumn("spls_cmpy_ky", wrong.cast("bigint"))
        return res

    with pytest.raises(GuardError):
        run_load(store, "cmpy", "K", job, schema=_schema(spark), now=DAY[4])
    assert store.state().version == 1


def test_an_empty_run_is_observed(spark):
    for options in ({}, dict(key=["spls_cmpy_id"], compact_at=1.0), dict(partition_by=F.col("spls_cmpy_ky") % 2, key=["spls_cmpy_id"])):
        store = SnapshotStore(spark, _root(), **options)
        for day in (2, 4):
            report = _load(store, spark, _src(spark, []), day)
            assert report.state.stats["rows"] == 0 and store.read(_schema(spark)).count() == 0


# ------------------------------------------------- buckets inside partitions, skipping, commits
def test_buckets_inside_partitions_join_in_place_and_prune(spark):
    from martloom.operators.merge import apply_changes

    store = SnapshotStore(spark, _root(), partition_by=F.col("spls_cmpy_ky") % 3, bucket_by=(4, ["spls_cmpy_id"]), key=["spls_cmpy_id"])
    rows = [(f"C{i}", None, "x", DAY[1]) for i in range(40)]
    one = _load(store, spark, _src(spark, rows), 2)
    two = _load(store, spark, _src(spark, [*rows[1:], ("C0", None, "changed", DAY[3])]), 4)
    assert len({*two.state.partitions.values()}) == 2 and one.state.run in two.state.partitions.values()
    refusing = spark.newSession()
    for conf in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        refusing.conf.set(conf, "-1")
    reader = SnapshotStore(refusing, store.root, key=["spls_cmpy_id"])
    target = reader.read(_schema(spark)).filter(F.col("_ml_p").isin(0, 1))
    source = refusing.createDataFrame([("C0", "UPDT", "y")], "spls_cmpy_id string, row_stat_cd string, cmpy_nm string")
    out = apply_changes(target, source, ["spls_cmpy_id"], run_ts="2024-02-01 00:00:00", update_cols=["cmpy_nm"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1, plan  # the source only
    assert "PartitionFilters: [_ml_p" in plan or "_ml_p#" in plan.split("PartitionFilters: [")[1].split("]")[0], plan
    assert target.count() == sum(n for p, n in two.state.partition_rows.items() if p in "01")
    files = glob.glob(f"{store.data_path(one.state.run)}/_ml_p=1/*.parquet")
    assert len(files) <= 4  # one a bucket
    names = rows_of(store.read(_schema(spark)), ["spls_cmpy_id", "cmpy_nm"])
    assert len(names) == 40 and names[0] == ("C0", "changed")
    store.vacuum(keep=1)
    assert store.read(_schema(spark)).count() == 40


def _rows_scanned(df):
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    leaves = plan.collectLeaves()
    nodes = [leaves.apply(i) for i in range(leaves.size())]
    for n in nodes:
        inner = n.plan().collectLeaves() if n.nodeName().startswith(("ShuffleQueryStage", "BroadcastQueryStage")) else None
        for leaf in [n] if inner is None else [inner.apply(i) for i in range(inner.size())]:
            if "Scan parquet" in leaf.nodeName():
                total += leaf.metrics().apply("numOutputRows").value()
    return total


def test_key_probe_skips_row_groups(spark):
    from martloom.operators.delta import key_ranges, new_keys, within_ranges

    store = SnapshotStore(spark, _root(), sort_by=["eml_ky"])
    rows = spark.range(20_000).select((F.col("id") * 3).alias("eml_ky"), F.lit("X").alias("src_cd")).repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # one file a range, small as they are
    try:
        store.publish(rows, expect_version=0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    delta = spark.createDataFrame([(k, "X") for k in [*range(300, 330), *range(59_000, 59_030)]], "eml_ky long, src_cd string")
    target = store.read(rows.schema)
    ranges = key_ranges(delta, "eml_ky", 8)
    assert len(ranges) <= 8 and all(a <= b for a, b in ranges)
    probed = within_ranges(target, "eml_ky", ranges)
    plan = probed._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan, plan
    assert _rows_scanned(probed) < 20_000 * 0.8 and _rows_scanned(target.select("eml_ky")) == 20_000
    want = sorted(tuple(r) for r in new_keys(delta, target, ["eml_ky", "src_cd"]).collect())
    assert sorted(tuple(r) for r in new_keys(delta, target, ["eml_ky", "src_cd"], skip_on="eml_ky").collect()) == want
    assert len(want) == 40
    # text keys have one range, an empty delta none
    words = spark.createDataFrame([("b",), ("d",), (None,)], "w string")
    assert key_ranges(words, "w") == [("b", "d")] and key_ranges(words.limit(0), "w") == []
    assert within_ranges(words, "w", []).count() == 0


def test_bloom_filters_answer_for_single_keys(spark):
    from martloom.operators.delta import within_ranges

    store = SnapshotStore(spark, _root(), sort_by=["k"])
    rows = spark.range(0, 40_000, 2).select(F.col("id").alias("k")).repartition(2)
    store.publish(rows, expect_version=0)
    inside = within_ranges(store.read(rows.schema), "k", [(10_001, 10_001)])  # within the bounds, in no file
    assert _rows_scanned(inside) == 0


def test_commit_needs_an_exclusive_operation(spark, monkeypatch):
    from martloom.sources import snapshot as module

    a = SnapshotStore(spark, _root())
    frame_ = full_frame(spark, CMPY_TGT, [])
    assert a.commit_mode() == "rename"
    monkeypatch.setattr(module, "RENAMES", ())
    with pytest.raises(module.CommitUnsafe):
        a.publish(frame_, expect_version=0)
    assert not os.path.exists(f"{a.root}/data")  # refused before data is written


def test_two_writers_with_conditional_creates(spark, monkeypatch):
    from martloom.sources import snapshot as module

    monkeypatch.setattr(SnapshotStore, "commit_mode", lambda self: "create")
    root = _root()
    a, b = SnapshotStore(spark, root), SnapshotStore(spark, root)
    main = full_frame(spark, CMPY_TGT, [])
    a.publish(main, expect_version=0)
    done = []

    def overtaken(_written):
        if not done:
            done.append(a.publish(main, expect_version=1, high_water={"K": 2}))

    with pytest.raises(module.VersionConflict):
        b.publish(main, expect_version=1, high_water={"K": 9}, verify=overtaken)
    assert a.state() == done[0] and a.state().high_water == {"K": 2}
    # two runs that start together
    window = lambda _: {"lo": "", "run_ts": "", "after": None}
    a.leases.acquire("p", window)
    with pytest.raises(WindowBusy):
        b.leases.acquire("p", window)


# ------------------------------------------------------------ temporary tables
def test_temporary_tables_end_with_the_run_and_the_sweeper_leaves_live_ones(spark):
    import time

    from martloom.session import checkpoint_dir, hadoop_path, run_tables, stored_table, sweep_tables

    base = checkpoint_dir(spark).rstrip("/").removeprefix("file:")
    own = f"{base}/tables/{spark.sparkContext.applicationId}"

    def tables():
        return {n for n in os.listdir(own) if not n.startswith((".", "_"))} if os.path.exists(own) else set()

    store = SnapshotStore(spark, _root())
    before = tables()
    _load(store, spark, _src(spark, [("A", None, "a", DAY[1]), (None, None, "x", DAY[1])]), 2)
    _load(store, spark, _src(spark, [("A", None, "a", DAY[3])]), 4, replay=lambda r: r)
    assert tables() == before                       # none left by runs
    with pytest.raises(RuntimeError), run_tables(spark):
        stored_table(spark.range(3))
        kept, path = stored_table(spark.range(4), keep=True)
        raise RuntimeError("lost")
    assert len(tables()) == len(before) + 1 and kept.count() == 4
    # another application's folder: swept only once its lease is old
    fs, lease = hadoop_path(spark, f"{base}/tables/app-gone/_lease")
    fs.create(lease, True).close()
    assert sweep_tables(spark) == []
    assert sweep_tables(spark, now=time.time() + 2 * 24 * 3600) == ["app-gone"]
    assert kept.count() == 4 and os.path.exists(own) and not os.path.exists(f"{base}/tables/app-gone")


# -------------------------------------------------------------- stacked roles
def test_stacked_date_roles_equal_one_join_a_role(spark):
    from conftest import frame

    from martloom.operators.lookup import resolve_date_keys

    refusing = spark.newSession()
    for conf in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        refusing.conf.set(conf, "-1")
    day = [None, *[d.date() for d in DAY[:6]]]
    rows = [(i, "x", day[i % 7], day[i % 3], day[i * 5 % 7]) for i in range(60)]
    roles = {"a": "a_ky", "b": "b_ky", "c": "c_ky"}
    columns = {"id": "bigint", "t": "string", "a": "date", "b": "date", "c": "date"}
    out = []
    for session in (spark, refusing):
        df = frame(session, columns, rows)
        cal = frame(session, {"cld_dt": "date", "tm_ky": "bigint"}, [(d, i) for i, d in enumerate(day[1:5])])
        res = resolve_date_keys(df, cal, roles, key=["id"])
        out.append(rows_of(res, ["id", "t", "a_ky", "b_ky", "c_ky"]))
        if session is refusing:
            plan = res._jdf.queryExecution().executedPlan().toString()
            assert plan.count("SortMergeJoin") == 2 and "Broadcast" not in plan, plan
    assert out[0] == out[1]
