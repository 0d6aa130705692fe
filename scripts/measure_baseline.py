"""

usage: python scripts/measure_baseline.py [sf_dir]
Prints one JSON object. Each variant: median of 3 after one warm-up, with a
full result check (keys / rows must be identical across variants).
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from martloom.operators.keys import assign_surrogate_keys  # noqa: E402
from martloom.operators.merge import merge_upsert  # noqa: E402
from martloom.session import local_session  # noqa: E402
import derived_views as V  # noqa: E402


def timed(fn, repeats=3):
    runs, out = [], None
    for i in range(repeats + 1):
        t0 = time.perf_counter()
        out = fn()
        if i:
            runs.append(time.perf_counter() - t0)
    return round(statistics.median(runs), 3), out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 8)
    res = {"sf_dir": sf, "cpus": 8, "shuffle_partitions": 8, "spark": spark.version}

    lines = V.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
    ).distinct()
    key = ["l_orderkey", "l_linenumber"]

    def keys():
        ka = assign_surrogate_keys(lines, key, "k", 0, num_partitions=8)
        h = ka.keyed.agg(F.sum(F.col("k") * F.col("l_orderkey")).alias("h"), F.count("*").alias("n")).collect()[0]
        ka.release()
        return h

    t_r, h_r = timed(keys)
    res["assign_keys"] = {"rows": h_r["n"], "ranged_sec": t_r}

    o = V.table(spark, sf, "orders")
    tgt = o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                   F.col("o_orderdate").cast("timestamp_ntz").alias("row_insrt_tms"),
                   F.col("o_orderdate").cast("timestamp_ntz").alias("row_updt_tms"), F.lit("NEW").alias("row_stat_cd"))
    mx = o.agg(F.max("o_orderkey")).collect()[0][0]
    for pct in (1, 30):
        k = F.col("o_orderkey")
        src = o.filter((k % 100) < pct).select(
            F.when(k % 200 < 100, k).otherwise(k + F.lit(mx)).alias("o_orderkey"), "o_custkey",
            F.lit("F").alias("o_orderstatus"), (F.col("o_totalprice") * 1.1).alias("o_totalprice"),
            F.lit("UPDT").alias("row_stat_cd"))

        def up(threshold):
            def run():
                spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
                out = merge_upsert(tgt, src, ["o_orderkey"], update_cols=["o_orderstatus", "o_totalprice"],
                                   insert_cols=["o_custkey", "o_orderstatus", "o_totalprice"],
                                   run_ts="2024-02-01 00:00:00")
                return out.agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("s"),
                               F.sum(F.when(F.col("row_stat_cd") == "UPDT", 1)).alias("u")).collect()[0]
            return run

        t_b, r_b = timed(up("64m"))
        t_f, r_f = timed(up("-1"))
        assert r_b == r_f, (r_b, r_f)
        res[f"upsert_{pct}pct"] = {"rows_out": r_b["n"], "updated": r_b["u"],
                                   "threshold_64m_sec": t_b, "no_broadcast_sec": t_f}
    spark.stop()
    print(json.dumps(res))


if __name__ == "__main__":
    main()
