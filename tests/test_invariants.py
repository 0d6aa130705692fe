"""Invariants of a whole load over the derived views."""

import os
import sys
from datetime import datetime

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as E  # noqa: E402

from martloom.operators.merge import loopback_repair  # noqa: E402
from martloom.plans import company, direct_mail  # noqa: E402
from martloom.plans.common import max_key  # noqa: E402
import derived_views as V  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_company_loopback_is_a_fixpoint_and_keys_are_valid(spark):
    src, tgt = V.company_src(spark, SF), V.company_dim(spark, SF)
    res = company.run(src, tgt, E.WINDOW, max_key(tgt, company.SK))
    out = res.table.checkpoint()
    spine = res.extras["spine"]
    live = {r[0] for r in spine.filter(F.col("row_stat_cd") != "DEL").select(company.SK).collect()}
    for fk in company.POINTERS.values():
        bad = out.filter(~F.col(fk).isin([0, -1, *live])).count()
        assert bad == 0, fk
    # a second loopback right after the run finds nothing left to repair
    resolved = company.resolve_pointers(src.select(*company.KEY, *company.POINTERS), spine)
    again = loopback_repair(out, resolved, company.KEY, list(company.POINTERS.values()),
                            run_ts=datetime(2024, 2, 2), only_nonzero=True)
    assert again.filter(F.col("row_updt_tms") == F.lit("2024-02-02 00:00:00").cast("timestamp_ntz")).count() == 0
    # keys: unique, and the new ones dense after the high-water mark
    ks = [r[0] for r in out.select(company.SK).collect()]
    assert len(ks) == len(set(ks))
    hw = max_key(tgt, company.SK)
    assert sorted(k for k in ks if k > hw) == list(range(hw + 1, res.high_water + 1))


def test_direct_site_keys_are_valid(spark):
    src, tgt = V.direct_src(spark, SF), V.direct_tgt(spark, SF)
    sites, cal = V.site_dim(spark, SF), V.calendar(spark, SF)
    out = direct_mail.run(src, tgt, sites, cal, E.WINDOW, max_key(tgt, direct_mail.SK)).table
    live = {r[0] for r in sites.filter(F.col("row_stat_cd") != "DEL").select("spls_site_ky").collect()}
    valid = F.col("spls_site_ky").isin([0, -1, *live])
    run = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    # inserted rows resolve their site at load time
    assert out.filter((F.col("row_insrt_tms") == run) & ~valid).count() == 0
    # every row outside the delta has been re-resolved by the loopback
    delta_keys = src.filter(F.col("row_updt_tms") >= F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    outside = out.join(delta_keys.select(*direct_mail.KEY), direct_mail.KEY, "left_anti")
    assert outside.filter(~valid).count() == 0
    # matched delta rows keep their old site key this run (the update list leaves it out);
    # the next run's loopback repairs them
    matched = out.filter((F.col("row_updt_tms") == run) & (F.col("row_insrt_tms") != run))
    assert matched.filter(~valid).count() > 0
