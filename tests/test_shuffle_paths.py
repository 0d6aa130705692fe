"""The large-data plans: the session refuses broadcasts, every join shuffles.

The four loads must give exactly the rows they give with broadcasts."""

import pytest
from conftest import rows_of
import test_golden_jobs as golden
from test_golden_jobs import W, company_inputs

from martloom.plans import company


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_company_without_broadcasts(spark, no_broadcast):
    src, tgt = company_inputs(spark)
    res = company.run(src, tgt, W, 100)
    cols = ["spls_cmpy_ky", "spls_cmpy_id", "parnt_cmpy_ky", "ultmt_parnt_cmpy_ky", "row_stat_cd"]
    assert rows_of(res.table, cols) == [
        (1, "A", 0, 0, "UPDT"), (2, "B", 1, 1, "NEW"), (3, "C", 101, 1, "NEW"), (4, "D", 0, 0, "DEL"),
        (5, "F", -1, -1, "NEW"), (101, "E", 1, 1, "NEW"), (102, "G", -1, 0, "NEW"), (103, "H", 101, 1, "DEL"),
    ]
    p = res.table._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in p


def test_direct_without_broadcasts(spark, no_broadcast):
    golden.test_b2_direct(spark)


def test_email_without_broadcasts(spark, no_broadcast):
    golden.test_b3_email(spark)


def test_taxonomy_without_broadcasts(spark, no_broadcast):
    golden.test_b4_taxonomy(spark)


def test_company_looks_up_both_pointers_in_one_join(spark, no_broadcast):
    src, tgt = company_inputs(spark)
    res = company.run(src, tgt, W, 100)
    rows_of(res.table, ["spls_cmpy_id"])
    spine = res.extras["spine"]
    found = company.resolve_pointers(src.select(*company.KEY, *company.POINTERS), spine)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("SortMergeJoin") == 2, plan
    assert rows_of(res.table, ["spls_cmpy_id", "parnt_cmpy_ky", "ultmt_parnt_cmpy_ky"]) == [
        ("A", 0, 0), ("B", 1, 1), ("C", 101, 1), ("D", 0, 0), ("E", 1, 1), ("F", -1, -1), ("G", -1, 0),
        ("H", 101, 1)]


def test_taxonomy_counts_once(spark, no_broadcast):
    """The rollups feed a stored merge source, so the published plan holds no count of its own."""
    import os
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E

    plan = E.queries()["taxonomy_full"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Aggregate" not in plan, plan
