"""The kept reference index and support counts against the full recheck and recount."""

import random
import tempfile

import pytest
from conftest import frame, full_frame, rows_of, ts
from pyspark.sql import functions as F
from test_golden_jobs import DRCT_SRC, DRCT_TGT, calendar

from martloom.operators.rollup import distinct_rollup
from martloom.operators.support import SupportCounts
from martloom.plans import direct_mail, taxonomy
from martloom.plans.runner import run_load
from martloom.sources.snapshot import SnapshotStore

DAY = [ts(f"2024-01-{i:02d} 00:00:00") for i in range(1, 29)]
SITE = {"spls_site_id": "bigint", "spls_site_ky": "bigint", "row_stat_cd": "string"}


def _root():
    return tempfile.mkdtemp(prefix="ml-store-")


def _direct_load(spark, store, source, sites, cal, day, indexed):
    index = direct_mail.site_index(store, buckets=3) if indexed else None
    return run_load(store, "drct", "K", lambda t, w, hw: direct_mail.run(source, t, sites, cal, w, hw, index=index),
                    schema=full_frame(spark, DRCT_TGT, []).schema, initial_high_water=0, now=DAY[day])


@pytest.mark.parametrize("seed", range(4))
def test_indexed_loopback_equals_the_full_recheck(spark, seed):
    """Five runs a seed: rows come and change their site, sites appear, are deleted, change their key and
    come back; some rows change in one run and are healed by a later one (the merge leaves the site key)."""
    rng = random.Random(seed)
    site_type = DRCT_SRC["spls_site_id"]
    ids = (lambda n: n) if site_type == "bigint" else (lambda n: f"S{n}")
    full = SnapshotStore(spark, _root())
    kept = SnapshotStore(spark, _root(), key=direct_mail.KEY, compact_at=rng.choice([0.3, 5.0]))
    cal = calendar(spark)
    sites = {n: (100 + n, "NEW") for n in range(4)}
    rows = {}
    person = (lambda n: n) if DRCT_SRC["spls_prsn_id"] == "bigint" else (lambda n: f"P{n}")
    columns = ["drct_ml_promo_ky", "spls_prsn_id", "src_cd", "spls_site_ky", "row_stat_cd", "row_updt_tms", "row_insrt_tms"]
    for day in range(1, 6):
        for _ in range(rng.randint(0, 5)):
            n = rng.randrange(14)
            rows[n] = dict(spls_prsn_id=person(n), src_cd="X", promo_dt=DAY[0].date(), spls_site_id=rng.choice([None, *map(ids, range(7))]),
                           row_updt_tms=DAY[2 * day - 1], row_stat_cd=rng.choice(["NEW", "DEL"]))
        for _ in range(rng.randint(0, 3)):
            n = rng.randrange(7)
            sites[n] = (rng.choice([100 + n, 200 + n]), rng.choice(["NEW", "NEW", "DEL", None]))
        src = full_frame(spark, DRCT_SRC, list(rows.values()))
        dim = frame(spark, {**SITE, "spls_site_id": site_type}, [(ids(n), k, s) for n, (k, s) in sites.items()])
        for store, indexed in ((full, False), (kept, True)):
            _direct_load(spark, store, src, dim, cal, 2 * day, indexed)
        schema = full_frame(spark, DRCT_TGT, []).schema
        assert rows_of(kept.read(schema), columns) == rows_of(full.read(schema), columns), day
        pending = kept.side("sites_pending")
        assert pending.filter("resolved = held OR held IS NULL").count() == 0
    kept.vacuum(keep=1)
    assert rows_of(kept.read(schema), columns) == rows_of(full.read(schema), columns)


@pytest.mark.parametrize("seed", range(2))
def test_indexed_hierarchy_equals_the_full_recheck(spark, seed):
    """Five runs a seed of companies that appear, point at others, are deleted, come back and have no status for a while."""
    from test_golden_jobs import CMPY_SRC, CMPY_TGT

    from martloom.plans import company

    rng = random.Random(100 + seed)
    full = SnapshotStore(spark, _root())
    kept = SnapshotStore(spark, _root(), key=company.KEY, compact_at=rng.choice([0.3, 5.0]))
    rows, schema = {}, full_frame(spark, CMPY_TGT, []).schema
    names = [f"C{i}" for i in range(9)]
    for day in range(1, 6):
        for _ in range(rng.randint(0, 4)):
            c = rng.choice(names)
            rows[c] = dict(spls_cmpy_id=c, parnt_cmpy_id=rng.choice([None, *names, "X"]), ultmt_parnt_cmpy_id=rng.choice([None, *names]),
                           cmpy_nm=f"{c} {day}", row_updt_tms=DAY[2 * day - 1], row_stat_cd=rng.choice(["NEW", "NEW", "DEL", None]))
        src = full_frame(spark, CMPY_SRC, list(rows.values()))
        for store, index in ((full, None), (kept, company.pointer_index(kept, buckets=3))):
            run_load(store, "cmpy", "K", lambda t, w, hw, i=index: company.run(src, t, w, hw, index=i), schema=schema,
                     initial_high_water=0, now=DAY[2 * day])
        columns = ["spls_cmpy_ky", "spls_cmpy_id", "parnt_cmpy_ky", "ultmt_parnt_cmpy_ky", "row_stat_cd", "row_updt_tms", "row_insrt_tms"]
        assert rows_of(kept.read(schema), columns) == rows_of(full.read(schema), columns), day


def test_an_indexed_run_reads_only_the_buckets_of_changed_sites(spark):
    store = SnapshotStore(spark, _root(), key=direct_mail.KEY, compact_at=5.0)
    site_type = DRCT_SRC["spls_site_id"]
    ids = (lambda n: n) if site_type == "bigint" else (lambda n: f"S{n}")
    src = full_frame(spark, DRCT_SRC, [dict(
        spls_prsn_id=n if DRCT_SRC["spls_prsn_id"] == "bigint" else f"P{n}", src_cd="X", promo_dt=DAY[0].date(), spls_site_id=ids(n),
        row_updt_tms=DAY[1], row_stat_cd="NEW") for n in range(30)])
    dim = {n: 100 + n for n in range(30)}
    frame_of = lambda: frame(spark, {**SITE, "spls_site_id": site_type}, [(ids(n), k, "NEW") for n, k in dim.items()])
    _direct_load(spark, store, src, frame_of(), calendar(spark), 2, True)
    index = direct_mail.site_index(store, buckets=3)
    dim[4] = 999
    live = frame_of().select("spls_site_id", "spls_site_ky")
    moved = index.changed_ids(live).cache()
    assert [r["_now"] for r in moved.collect()] == [999]
    found = index.candidates(moved)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_ml_b" in plan or "_ml_b#" in plan.split("PartitionFilters: [")[1].split("]")[0], plan
    assert [(r.resolved, r.held) for r in found.collect()] == [(999, 104)]
    moved.unpersist()


@pytest.mark.parametrize("seed", range(3))
def test_support_counts_equal_a_recount(spark, seed):
    rng = random.Random(seed)
    store = SnapshotStore(spark, _root())
    rows, links = {}, set()
    main = frame(spark, {"row_updt_tms": "ts", "row_insrt_tms": "ts"}, [])
    for run in range(5):
        changed, gone = {}, []
        for _ in range(rng.randint(1, 9)):
            k = rng.choice([None, *range(12)])
            if k in rows and rng.random() < 0.25:
                gone.append((k, *rows.pop(k), True))
                changed.pop(k, None)
            else:
                rows[k] = changed[k] = (rng.choice([None, "a", "b", "c"]), rng.choice([None, *range(5)]))
                gone = [g for g in gone if g[0] != k]
        for _ in range(rng.randint(0, 4)):
            links ^= {(rng.randrange(5), rng.randrange(3))}
        counts = SupportCounts(store, "c", ["k"], "code", "member", "master")
        batch = frame(spark, {"k": "bigint", "code": "string", "member": "bigint", "_ml_gone": "bool"},
                      [(k, *v, False) for k, v in changed.items()] + gone)
        pairs = frame(spark, {"member": "bigint", "master": "bigint"}, [*links, *list(links)[:1], (None, 1), (1, None)])
        moved = counts.advance(batch, pairs)
        got = {r.code: (r.rows, r.members, r.masters) for r in moved.counts.collect()}
        want = {}
        for code in {c for c, _ in rows.values()}:
            members = {m for c, m in rows.values() if c == code and m is not None}
            want[code] = (sum(c == code for c, _ in rows.values()), len(members), len({x for m, x in links if m in members}))
        assert got == want, run
        store.publish(main, expect_version=run, side=moved.side)
        counts.release(moved)
        assert {r.code: (r.rows, r.members, r.masters) for r in store.side("c_counts").collect()} == want


def test_kept_counts_equal_the_rollups_with_null_codes(spark):
    promos = frame(spark, {"spls_prsn_id": "bigint", "src_cd": "string", "promo_dt": "date", "spls_site_id": "bigint"},
                   [(1, "X", DAY[0].date(), 5), (2, "X", DAY[0].date(), 6), (2, None, DAY[0].date(), 5), (3, None, DAY[1].date(), None),
                    (4, "Y", DAY[0].date(), None)])
    sites = frame(spark, {"spls_site_id": "bigint", "spls_site_ky": "bigint"}, [(5, 50), (6, 60), (6, 61)])
    customers = frame(spark, {"cust_lvl": "string", "spls_site_ky": "bigint", "mstr_cust_ky": "bigint"},
                      [("SHIPTO", 50, 1), ("SHIPTO", 60, 1), ("SHIPTO", 61, 2), ("SOLDTO", 50, 9), ("SHIPTO", 50, None)])
    kept = taxonomy.KeptCounts(SnapshotStore(spark, _root()))
    want = taxonomy.direct_counts(promos, sites, customers)
    got = kept.direct(promos, sites, customers)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert distinct_rollup(promos, ["src_cd"], {"n": "spls_site_id"}).count() == got.count()
    kept.release()


def _moves(spark):
    """Rows of one code each way and links that stay, come and go."""
    rows = {"k": "bigint", "code": "string", "member": "bigint"}
    links = {"member": "bigint", "master": "bigint"}
    return [(frame(spark, rows, [(1, "a", 1), (2, "a", 2), (3, None, 3)]), frame(spark, links, [(1, 10), (2, 20), (3, 30)])),
            (frame(spark, rows, [(2, "a", 3)]), frame(spark, links, [(1, 10), (3, 30), (3, 20)]))]


def test_support_counts_store_what_is_read_twice_only(spark):
    """A first count stores its rows once and its links once; moved links are found with one grouping."""
    store, expected = SnapshotStore(spark, _root()), [
        [("a", 2, 2, 2), (None, 1, 1, 1)], [("a", 2, 2, 3), (None, 1, 1, 2)]]
    for version, (rows, links) in enumerate(_moves(spark)):
        counts = SupportCounts(store, "c", ["k"], "code", "member", "master")
        moved = counts.advance(rows, links)
        found = [tuple(r) for r in moved.counts.select("code", "rows", "members", "masters").collect()]
        assert sorted(found, key=str) == sorted(expected[version], key=str)
        assert len(moved.stored) == (5 if version == 0 else 7)
        if version:
            assert sorted(map(tuple, moved.side["c_links"].rows.collect())) == [(2, 20, True), (3, 20, False)]
        store.publish(frame(spark, {"x": "bigint"}, [(1,)]), expect_version=version, run_ts=DAY[version], side=moved.side)
        counts.release(moved)
