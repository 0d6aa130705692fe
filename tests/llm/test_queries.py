"""Registered queries against their DuckDB SQL."""

import os

import pytest

from martloom.llm.queries import ORACLE_SQL, QUERIES

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name, tmp_path):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    path = os.path.join(tmp_path, "out")
    QUERIES[name](spark, SF).write.parquet(path)
    con.execute(f"CREATE TABLE o AS {ORACLE_SQL[name]}")
    con.execute(f"CREATE TABLE s AS SELECT * FROM read_parquet('{path}/*.parquet')")
    columns = ", ".join(sorted(r[0] for r in con.execute("DESCRIBE o").fetchall()))
    assert columns == ", ".join(sorted(r[0] for r in con.execute("DESCRIBE s").fetchall()))
    for a, b in (("o", "s"), ("s", "o")):
        assert con.execute(f"SELECT count(*) FROM (SELECT {columns} FROM {a} EXCEPT ALL SELECT {columns} FROM {b})").fetchall() == [(0,)]


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
