"""Each operator on a handful of rows, including NULLs and empty inputs."""

import pytest
from conftest import d, frame, rows_of, ts
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom import (
    GuardError,
    advance_high_water,
    assign_surrogate_keys,
    distinct_rollup,
    incremental_delta,
    key_spine,
    loopback_repair,
    merge_upsert,
    new_keys,
    resolve_date_keys,
    resolve_key,
    split_null_keys,
)
from martloom.operators.guards import check_surrogate_keys, dedupe_newest, delta_profile, duplicate_keys, orphan_report
from martloom.plans.common import prepare_delta
from martloom.sources.control import read_high_water, update_registry

RUN = ts("2024-01-11 06:00:00")
OLD = ts("2024-01-01 00:00:00")


def test_incremental_delta_keeps_rows_at_or_after_lo(spark):
    df = frame(spark, {"k": "string", "row_updt_tms": "ts"},
               [("a", ts("2024-01-09 23:59:59")), ("b", ts("2024-01-10 00:00:00")), ("c", None), ("d", RUN)])
    assert rows_of(incremental_delta(df, ts("2024-01-10 00:00:00")), ["k"]) == [("b",), ("d",)]


def test_new_keys_keeps_null_and_unseen(spark):
    delta = frame(spark, {"a": "string", "b": "bigint"}, [("x", 1), ("y", 2), (None, 3)])
    target = frame(spark, {"a": "string", "b": "bigint"}, [("x", 1), ("y", 9)])
    expect = [(None, 3), ("y", 2)]
    assert sorted(new_keys(delta, target, ["a", "b"]).collect(), key=str) == sorted(
        [tuple(r) for r in expect], key=str)
    # the plan that broadcasts the delta's keys gives the same rows
    assert sorted(map(tuple, new_keys(delta.hint("broadcast"), target, ["a", "b"]).collect()), key=str) == sorted(
        expect, key=str)


def test_key_spine_prefers_delta_status(spark):
    delta = frame(spark, {"id": "string", "row_stat_cd": "string"}, [("a", "DEL"), ("n", "NEW")])
    target = frame(spark, {"id": "string", "sk": "bigint", "row_stat_cd": "string"}, [("a", 1, "NEW"), ("b", 2, "UPDT")])
    assert rows_of(key_spine(delta, target, ["id"], "sk"), ["id", "sk", "row_stat_cd"]) == [
        ("a", 1, "DEL"), ("b", 2, "UPDT"), ("n", -1, "NEW")]


@settings(max_examples=6, deadline=None)
@given(keys=st.lists(st.tuples(st.integers(0, 40), st.sampled_from(["a", "b", "c"])), min_size=0, max_size=60,
                     unique=True),
       parts=st.integers(1, 7), hw=st.integers(0, 1000))
def test_ranged_keys_equal_global_row_number(spark, keys, parts, hw):
    df = frame(spark, {"n": "bigint", "s": "string"}, keys)
    ranged = assign_surrogate_keys(df, ["n", "s"], "sk", hw, num_partitions=parts)
    expected = [(n, s, hw + i + 1) for i, (n, s) in enumerate(sorted(keys))]
    assert rows_of(ranged.keyed, ["n", "s", "sk"]) == expected
    assert ranged.assigned == len(keys)
    assert ranged.high_water == hw + len(keys)


def test_empty_key_set_keeps_high_water(spark):
    df = frame(spark, {"n": "bigint"}, [])
    ka = assign_surrogate_keys(df, ["n"], "sk", 42)
    assert ka.assigned == 0 and ka.high_water == 42 and ka.keyed.count() == 0


def test_advance_high_water_never_backwards():
    assert advance_high_water(100, None) == 100
    assert advance_high_water(100, 50) == 100
    assert advance_high_water(100, 103) == 103
    with pytest.raises(ValueError):
        advance_high_water(None, 3)


def test_resolve_key_defaults(spark):
    df = frame(spark, {"id": "string", "ref": "string"}, [("1", None), ("2", "a"), ("3", "d"), ("4", "n"), ("5", "z")])
    dim = frame(spark, {"did": "string", "dk": "bigint", "row_stat_cd": "string"},
                [("a", 10, "NEW"), ("d", 11, "DEL"), ("n", 12, None)])
    for hint in ("broadcast", "merge"):
        out = resolve_key(df, dim.hint(hint), "ref", "did", "dk", "ref_ky")
        assert rows_of(out, ["id", "ref_ky"]) == [("1", 0), ("2", 10), ("3", -1), ("4", -1), ("5", -1)]
    everything = resolve_key(df, dim, "ref", "did", "dk", "ref_ky", live=False)
    assert rows_of(everything, ["id", "ref_ky"]) == [("1", 0), ("2", 10), ("3", 11), ("4", 12), ("5", -1)]


def test_resolve_date_keys_null_when_missing(spark):
    df = frame(spark, {"id": "bigint", "a": "date", "b": "date"},
               [(1, d("2024-01-01"), None), (2, d("2030-01-01"), d("2024-01-02"))])
    cal = frame(spark, {"cld_dt": "date", "tm_ky": "bigint"}, [(d("2024-01-01"), 1), (d("2024-01-02"), 2)])
    out = resolve_date_keys(df, cal, {"a": "a_ky", "b": "b_ky"})
    assert rows_of(out, ["id", "a_ky", "b_ky"]) == [(1, 1, None), (2, None, 2)]


def test_distinct_rollup_ignores_nulls(spark):
    df = frame(spark, {"g": "string", "x": "string", "y": "bigint"},
               [("a", "p", 1), ("a", "p", None), ("a", "q", 1), ("b", None, None)])
    out = distinct_rollup(df, ["g"], {"nx": "x", "ny": "y"})
    assert rows_of(out, ["g", "nx", "ny"]) == [("a", 2, 1), ("b", 0, 0)]


MT = {"k": "string", "v": "string", "w": "string", "row_insrt_tms": "ts", "row_updt_tms": "ts",
      "row_stat_cd": "string"}


@pytest.mark.parametrize("hint", ["broadcast", "merge"])
def test_merge_upsert_update_list_and_status(spark, hint):
    tgt = frame(spark, MT, [("a", "v0", "w0", OLD, OLD, "NEW"), ("b", "v0", "w0", OLD, OLD, "NEW")])
    src = frame(spark, {"k": "string", "v": "string", "w": "string", "row_stat_cd": "string"},
                [("a", None, "w1", "DEL"), ("c", "v1", "w1", None)]).hint(hint)
    out = merge_upsert(tgt, src, ["k"], update_cols=["v"], insert_cols=["v", "w"], run_ts=RUN)
    assert rows_of(out, list(MT)) == [
        ("a", None, "w0", OLD, RUN, "DEL"),   # NULL written, w not in update list
        ("b", "v0", "w0", OLD, OLD, "NEW"),
        ("c", "v1", "w1", RUN, RUN, "NEW"),   # NULL status inserts as NEW
    ]


def test_merge_upsert_empty_target_and_empty_source(spark):
    empty_t = frame(spark, MT, [])
    src = frame(spark, {"k": "string", "v": "string", "w": "string", "row_stat_cd": "string"},
                [("a", "v", "w", "UPDT")])
    out = merge_upsert(empty_t, src, ["k"], update_cols=["v"], insert_cols=["v", "w"], run_ts=RUN)
    assert rows_of(out, ["k", "row_stat_cd"]) == [("a", "NEW")]
    tgt = frame(spark, MT, [("a", "v0", "w0", OLD, OLD, "NEW")])
    out2 = merge_upsert(tgt, src.limit(0), ["k"], update_cols=["v"], insert_cols=["v", "w"], run_ts=RUN)
    assert rows_of(out2, list(MT)) == [("a", "v0", "w0", OLD, OLD, "NEW")]


def test_loopback_repair_rules(spark):
    cols = {"k": "string", "p": "bigint", "q": "bigint", "row_updt_tms": "ts", "row_stat_cd": "string"}
    tgt = frame(spark, cols, [
        ("a", -1, 1, OLD, "NEW"),    # p heals
        ("b", 0, 0, OLD, "NEW"),     # all zero: skipped with only_nonzero
        ("c", 5, 5, RUN, "NEW"),     # stamped this run: skipped
        ("d", None, 3, OLD, "NEW"),  # NULL never differs
        ("e", 7, 7, OLD, "DEL"),     # not in resolved: untouched
    ])
    res = frame(spark, {"k": "string", "p": "bigint", "q": "bigint"},
                [("a", 9, 1), ("b", 4, 4), ("c", 1, 1), ("d", 8, 3)])
    out = loopback_repair(tgt, res, ["k"], ["p", "q"], run_ts=RUN, only_nonzero=True)
    assert rows_of(out, list(cols)) == [
        ("a", 9, 1, RUN, "NEW"), ("b", 0, 0, OLD, "NEW"), ("c", 5, 5, RUN, "NEW"), ("d", None, 3, OLD, "NEW"),
        ("e", 7, 7, OLD, "DEL")]
    safe = loopback_repair(tgt, res, ["k"], ["p", "q"], run_ts=RUN, null_safe=True)
    assert dict(rows_of(safe, ["k", "p"]))["d"] == 8
    assert dict(rows_of(safe, ["k", "p"]))["b"] == 4


def test_guards_duplicates_nulls_and_dedupe(spark):
    cols = {"k": "string", "v": "bigint", "row_updt_tms": "ts"}
    t1, t2 = ts("2024-01-10 01:00:00"), ts("2024-01-10 02:00:00")
    df = frame(spark, cols, [("a", 1, t1), ("a", 2, t2), ("b", 3, t1), (None, 4, t1)])
    good, bad = split_null_keys(df, ["k"])
    assert good.count() == 3 and rows_of(bad, ["v"]) == [(4,)]
    assert rows_of(duplicate_keys(df, ["k"]), ["k", "row_cnt"]) == [("a", 2)]
    prof = delta_profile(df, ["k"])
    assert (prof.rows, prof.null_keys, prof.duplicate_keys, prof.max_copies) == (4, 1, 1, 2)
    with pytest.raises(GuardError):
        prepare_delta(df, ts("2024-01-10 00:00:00"), ["k"], what="t")
    with pytest.raises(GuardError):
        prepare_delta(df, ts("2024-01-10 00:00:00"), ["k"], what="t", dedupe_by=["row_updt_tms"],
                      on_null_key="fail")
    p = prepare_delta(df, ts("2024-01-10 00:00:00"), ["k"], what="t", dedupe_by=["row_updt_tms"])
    assert rows_of(p.delta, ["k", "v"]) == [("a", 2), ("b", 3)]
    assert rows_of(dedupe_newest(df.filter("k is not null"), ["k"], ["v"]), ["k", "v"]) == [("a", 2), ("b", 3)]


def test_registry_roundtrip_and_missing_row(spark):
    reg = frame(spark, {"tbl_nm": "string", "clmn_nm": "string", "lst_assgnd_id": "bigint", "row_updt_tms": "ts"},
                [("D_CMPY", "SPLS_CMPY_KY", 100, OLD), ("F_X", "X_KY", 7, OLD)])
    assert read_high_water(reg, "D_CMPY", "SPLS_CMPY_KY") == 100
    with pytest.raises(LookupError):
        read_high_water(reg, "D_CMPY", "NOPE")
    moved = update_registry(reg, "D_CMPY", "SPLS_CMPY_KY", 103, RUN)
    assert rows_of(moved, ["tbl_nm", "lst_assgnd_id", "row_updt_tms"]) == [("D_CMPY", 103, RUN), ("F_X", 7, OLD)]
    # never backwards
    assert read_high_water(update_registry(reg, "D_CMPY", "SPLS_CMPY_KY", 50, RUN), "D_CMPY", "SPLS_CMPY_KY") == 100


def test_orphan_report(spark):
    df = frame(spark, {"p": "bigint", "q": "bigint"}, [(-1, 0), (3, -1), (0, 0), (None, 5)])
    assert rows_of(orphan_report(df, ["p", "q"]), ["fk_col", "row_cnt", "unknown_cnt", "not_applicable_cnt"]) == [
        ("p", 3, 1, 1), ("q", 4, 1, 2)]


def test_null_references_are_spread_over_partitions(spark):
    """A fact whose references are mostly NULL: the join's left side is dealt by a
    second key, so those rows do not meet in one partition."""
    from pyspark.sql import functions as F

    from martloom.operators.lookup import null_spread

    rows = [(str(i), None) for i in range(400)] + [(str(1000 + i), "hot") for i in range(40)] + [("n", "c1")]
    df = frame(spark, {"id": "string", "ref": "string"}, rows)
    dim = frame(spark, {"did": "string", "dk": "bigint", "row_stat_cd": "string"},
                [("hot", 1, "NEW"), ("c0", 2, "NEW"), ("c1", 3, "DEL")])
    out = resolve_key(df, dim.hint("merge"), "ref", "did", "dk", "k")
    assert rows_of(out, ["k"]) == sorted([(0,)] * 400 + [(1,)] * 40 + [(-1,)])
    dealt = df.withColumn("_s", null_spread(df, "ref")).repartition(8, "ref", "_s")
    sizes = [r[0] for r in dealt.filter("ref IS NULL").groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) == 8 and max(sizes) < 100


def test_ranged_keys_with_adaptive_partition_count(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        df = frame(spark, {"n": "bigint"}, [(i,) for i in range(997, 0, -3)])
        ka = assign_surrogate_keys(df, ["n"], "sk", 7)
        got = rows_of(ka.keyed, ["n", "sk"])
        assert got == [(n, 7 + i + 1) for i, (n,) in enumerate(sorted((i,) for i in range(997, 0, -3)))]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_zoned_timestamps_are_utc_whatever_the_session_zone(spark):
    from pyspark.sql import functions as F

    from martloom.functions import ts_literal
    from pyspark.sql.types import TimestampType

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        v = spark.range(1).select(F.unix_timestamp(ts_literal("2024-02-01 00:00:00", TimestampType())).alias("e"))
        assert v.collect()[0]["e"] == 1706745600  # 2024-02-01T00:00:00Z
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_job_quarantines_null_keys_and_fills_empty_target(spark):
    from conftest import full_frame
    from test_golden_jobs import EML_SRC, EML_TGT, calendar

    from martloom.plans import email
    from martloom.sources.control import LoadWindow

    t = ts("2024-01-10 01:00:00")
    src = full_frame(spark, EML_SRC, [
        dict(eml_ky=5, src_cd="X", row_updt_tms=t, row_stat_cd="NEW"),
        dict(eml_ky=None, src_cd="X", row_updt_tms=t, row_stat_cd="NEW"),
        dict(eml_ky=2, src_cd="Y", row_updt_tms=t, row_stat_cd="DEL"),
    ])
    w = LoadWindow("t", ts("2024-01-10 00:00:00"), RUN)
    res = email.run(src, full_frame(spark, EML_TGT, []), calendar(spark), w, 40)
    assert res.profile.null_keys == 1 and res.quarantined.count() == 1
    assert rows_of(res.table, ["eml_promo_ky", "eml_ky", "src_cd", "row_stat_cd"]) == [
        (41, 2, "Y", "DEL"), (42, 5, "X", "NEW")]
    assert res.high_water == 42


def test_profile_without_duplicate_check_has_no_shuffle(spark):
    cols = {"k": "string", "v": "bigint"}
    df = frame(spark, cols, [("a", 1), ("b", 2), (None, 3)])
    prof = delta_profile(df, ["k"], check_duplicates=False)
    assert (prof.rows, prof.null_keys, prof.duplicate_keys) == (3, 1, 0)
    full = delta_profile(df, ["k"])
    assert (full.rows, full.null_keys, full.duplicate_keys) == (3, 1, 0)


def test_keys_survive_recomputation(spark):
    """Re-run stages must not renumber: the numbering is a stored table, which release() removes."""
    import os

    rows = [(i * 7 % 101, f"s{i % 3}") for i in range(101)]
    df = frame(spark, {"n": "bigint", "s": "string"}, rows).repartition(5)
    ranged = assign_surrogate_keys(df, ["n", "s"], "sk", 10, num_partitions=4)
    first = rows_of(ranged.keyed, ["n", "s", "sk"])
    assert first == [(n, s, 11 + i) for i, (n, s) in enumerate(sorted(rows))] == rows_of(ranged.keyed, ["n", "s", "sk"])
    path = ranged.path.removeprefix("file:")
    assert os.path.isdir(path)
    ranged.release()
    assert not os.path.exists(path)


def test_cluster_conf():
    from martloom.session import cluster_conf

    conf = cluster_conf(100 * 1024 ** 4)
    assert conf["spark.sql.shuffle.partitions"] == "819200"
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert cluster_conf(1)["spark.sql.shuffle.partitions"] == "200"


def test_surrogate_key_guard_has_a_lower_bound(spark):
    cols = {"k": "bigint", "row_insrt_tms": "ts"}
    old = ts("2024-01-01 00:00:00")
    good = frame(spark, cols, [(1, old), (10, old), (11, RUN), (12, RUN)])
    check_surrogate_keys(good, "k", 10, 12, run_ts=RUN)
    for bad in ([(1, RUN)], [(11, RUN), (11, RUN)], [(13, RUN)], [(None, RUN)], [(0, old)]):
        with pytest.raises(GuardError):
            check_surrogate_keys(frame(spark, cols, [(10, old), *bad]), "k", 10, 12, run_ts=RUN)
    with pytest.raises(GuardError):
        check_surrogate_keys(frame(spark, {"k": "bigint"}, [(1,), (2,)]), "k", 10, 12)


def test_merge_with_a_repeated_source_key_fails(spark):
    cols = {"k": "string", "v": "string", "row_insrt_tms": "ts", "row_updt_tms": "ts", "row_stat_cd": "string"}
    tgt = frame(spark, cols, [])
    src = frame(spark, {"k": "string", "v": "string", "row_stat_cd": "string"}, [("b", "y", "NEW"), ("b", "z", "NEW")])
    with pytest.raises(GuardError):
        merge_upsert(tgt, src, ["k"], update_cols=["v"], insert_cols=["v"], run_ts="2024-02-01 00:00:00")


def test_load_window_open_resume_close():
    from martloom.sources.control import EPOCH, LoadWindow

    first = LoadWindow.open("p", None, now=ts("2024-01-06 00:00:00"))
    assert first.lo == EPOCH and not first.resumed
    nxt = LoadWindow.open("p", first.close(), now=ts("2024-01-07 00:00:00"))
    assert nxt.lo == ts("2024-01-06 00:00:00")  # low-water mark: the last committed run_ts
    again = LoadWindow.open("p", pending=nxt, now=ts("2024-01-08 00:00:00"))
    assert again.resumed and again.lo == nxt.lo and again.run_ts == ts("2024-01-08 00:00:00")
    with pytest.raises(ValueError):
        LoadWindow.open("p", ts("2024-01-09 00:00:00"), now=ts("2024-01-08 00:00:00"))
