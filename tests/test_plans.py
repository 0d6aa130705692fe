"""Physical-plan properties the loads rely on at scale."""

import os
import sys

from conftest import frame, ts

from martloom import assign_surrogate_keys, distinct_rollup, incremental_delta, merge_upsert, resolve_date_keys
import derived_views as V

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_bound_is_pushed_into_parquet_scan(spark):
    events = V.table(spark, SF, "events")
    delta = incremental_delta(events, "2024-01-20 00:00:00", ts_col="ts").select("event_id")
    p = plan(delta)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-20T00:00)]" in p, p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in p, p


def test_ranged_key_assignment_never_uses_a_single_partition(spark):
    lines = V.table(spark, SF, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    ka = assign_surrogate_keys(lines, ["l_orderkey", "l_linenumber"], "k", 0, num_partitions=4)
    ka.keyed.collect()
    p = plan(ka.keyed)
    assert "SinglePartition" not in p, p
    assert "FileScan parquet" in p and "Exchange hashpartitioning" not in p  # reads the stored numbering
    assert "BroadcastHashJoin" in p  # offsets: one row per partition


def test_calendar_broadcast_is_built_once_for_all_roles(spark):
    df = frame(spark, {"id": "bigint", "a": "date", "b": "date", "c": "date"}, [(1, None, None, None)])
    cal = V.calendar(spark, SF).hint("broadcast")
    out = resolve_date_keys(df, cal, {"a": "a_ky", "b": "b_ky", "c": "c_ky"})
    out.collect()
    p = plan(out)
    assert "SortMergeJoin" not in p


def test_no_size_question_moves_rows(spark):
    """Building a load asks nothing of its inputs that sends rows to one task: no limit, no single partition."""
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E

    for name in ("email_merge", "company_full", "direct_full", "taxonomy_full"):
        out = E.queries()[name](spark, SF)
        p = plan(out)
        assert "Limit" not in p and "SinglePartition" not in p, (name, p)


def test_multi_distinct_rollup_is_two_phase(spark):
    df = frame(spark, {"g": "string", "x": "string", "y": "string"}, [("a", "1", "2")])
    p = plan(distinct_rollup(df, ["g"], {"nx": "x", "ny": "y"}))
    assert "Expand" in p and p.count("HashAggregate") >= 3, p


def test_full_outer_fallback_is_one_join(spark):
    cols = {"k": "string", "v": "string", "row_insrt_tms": "ts", "row_updt_tms": "ts", "row_stat_cd": "string"}
    tgt = frame(spark, cols, [("a", "x", ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:00"), "NEW")])
    src = frame(spark, {"k": "string", "v": "string", "row_stat_cd": "string"}, [("b", "y", "NEW")])
    out = merge_upsert(tgt, src, ["k"], update_cols=["v"], insert_cols=["v"], run_ts="2024-02-01 00:00:00")
    p = plan(out)
    assert p.count("FullOuter") == 1 and "Union" not in p, p
