"""

Every query reads the driver's tables through the derived views in
``derived_views`` (whole tables, no sampling) and runs the
library's operators or whole loads on them with the fixed window
``lo = 2024-01-20``, ``run_ts = 2024-02-01`` and the high-water mark taken
from the target view. ``oracle_sql()`` returns DuckDB SQL for the same
and process names are fixed names of the mart.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from martloom.operators.delta import incremental_delta, key_spine, new_keys  # noqa: E402
from martloom.operators.guards import (  # noqa: E402
    dedupe_newest,
    duplicate_keys,
    orphan_report,
    split_null_keys,
    surrogate_key_report,
)
from martloom.operators.keys import assign_surrogate_keys  # noqa: E402
from martloom.operators.lookup import resolve_date_keys  # noqa: E402
from martloom.operators.merge import loopback_repair, merge_upsert  # noqa: E402
from martloom.plans import company, direct_mail, email, taxonomy  # noqa: E402
from martloom.plans.common import NEW_FLAG, attach_new_keys, case_blind, max_key  # noqa: E402
from martloom.plans.runner import open_window, run_load  # noqa: E402
from martloom.session import checkpoint_dir, hadoop_path  # noqa: E402
import derived_views as V  # noqa: E402
from martloom.sources.control import LoadWindow, update_registry  # noqa: E402
from martloom.sources.lease import LeaseLost, WindowBusy  # noqa: E402
from martloom.sources.snapshot import SnapshotStore  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
WINDOW = LoadWindow("fixture", datetime(2024, 1, 20), datetime(2024, 2, 1))


# ------------------------------------------------------------------- email
def _email_inputs(spark: SparkSession, d: str):
    return V.email_src(spark, d), V.email_tgt(spark, d), V.calendar(spark, d)


def q_email_delta(spark: SparkSession, d: str) -> DataFrame:
    return incremental_delta(V.email_src(spark, d), WINDOW.lo)


def q_email_new_keys(spark: SparkSession, d: str) -> DataFrame:
    src, tgt, _ = _email_inputs(spark, d)
    return new_keys(incremental_delta(src, WINDOW.lo), tgt, email.KEY)


def q_email_new_keys_skipping(spark: SparkSession, d: str) -> DataFrame:
    """The same over a stored version in key order: the target's scan is
    narrowed to the ranges of the delta's keys."""
    src, tgt, _ = _email_inputs(spark, d)
    store = _store(spark, sort_by=email.KEY)
    store.publish(tgt, expect_version=0)
    return new_keys(incremental_delta(src, WINDOW.lo), store.read(tgt.schema), email.KEY, skip_on="eml_ky")


def _email_keys(spark: SparkSession, d: str):
    src, tgt, _ = _email_inputs(spark, d)
    hw = max_key(tgt, email.SK)
    fresh = new_keys(incremental_delta(src, WINDOW.lo), tgt, email.KEY)
    return hw, assign_surrogate_keys(fresh, email.KEY, email.SK, hw)


def q_email_keys(spark: SparkSession, d: str) -> DataFrame:
    return _email_keys(spark, d)[1].keyed


def q_email_high_water(spark: SparkSession, d: str) -> DataFrame:
    hw, ka = _email_keys(spark, d)
    tgt = V.email_tgt(spark, d)
    registry = tgt.agg(F.max(email.SK).cast("bigint").alias("lst_assgnd_id")).select(
        F.lit("F_EML_PROMO").alias("tbl_nm"), F.lit("EML_PROMO_KY").alias("clmn_nm"), "lst_assgnd_id",
        F.lit("2024-01-02 00:00:00").cast("timestamp_ntz").alias("row_updt_tms"),
    )
    return update_registry(registry, "F_EML_PROMO", "EML_PROMO_KY", ka.high_water, WINDOW.run_ts)


def q_email_date_keys(spark: SparkSession, d: str) -> DataFrame:
    src, _, cal = _email_inputs(spark, d)
    out = resolve_date_keys(incremental_delta(src, WINDOW.lo), cal, email.DATE_ROLES)
    return out.select(*email.KEY, *email.DATE_ROLES.values())


def _email_run(spark: SparkSession, d: str):
    src, tgt, cal = _email_inputs(spark, d)
    return email.run(src, tgt, cal, WINDOW, max_key(tgt, email.SK))


def q_email_merge(spark: SparkSession, d: str) -> DataFrame:
    return _email_run(spark, d).table


def q_email_upsert_full_outer(spark: SparkSession, d: str) -> DataFrame:
    """The generic MERGE path (no known-new flag, no broadcast): one full outer join."""
    src, tgt, cal = _email_inputs(spark, d)
    hw = max_key(tgt, email.SK)
    fresh = new_keys(incremental_delta(src, WINDOW.lo), tgt, email.KEY)
    ka = assign_surrogate_keys(fresh, email.KEY, email.SK, hw)
    merge_src = email.enrich(incremental_delta(src, WINDOW.lo).join(ka.keyed, email.KEY, "left"), cal)
    return merge_upsert(tgt, merge_src, email.KEY, update_cols=email.UPDATE_COLS, insert_cols=email.INSERT_COLS,
                        run_ts=WINDOW.run_ts)


def q_email_upsert_broadcast(spark: SparkSession, d: str) -> DataFrame:
    """The generic MERGE path with known new keys: one left join of the target,
    which Spark turns into a broadcast of the source where it is small."""
    src, tgt, cal = _email_inputs(spark, d)
    hw = max_key(tgt, email.SK)
    fresh = new_keys(incremental_delta(src, WINDOW.lo), tgt, email.KEY)
    ka = assign_surrogate_keys(fresh, email.KEY, email.SK, hw)
    merge_src = email.enrich(attach_new_keys(incremental_delta(src, WINDOW.lo), ka, email.KEY, email.SK), cal)
    return merge_upsert(tgt, merge_src, email.KEY, update_cols=email.UPDATE_COLS, insert_cols=email.INSERT_COLS,
                        run_ts=WINDOW.run_ts, new_flag=NEW_FLAG)


def q_email_case_blind(spark: SparkSession, d: str) -> DataFrame:
    """The e-mail load with case-blind source codes: a fifth of the source spells them in lower case with a blank after."""
    src, tgt, cal = _email_inputs(spark, d)
    spelled = src.withColumn("src_cd", F.when(F.col("eml_id") % 5 == 0, F.concat(F.lower("src_cd"), F.lit(" "))).otherwise(F.col("src_cd")))
    return case_blind(email.run, ["src_cd"])(spelled, tgt, cal, WINDOW, max_key(tgt, email.SK)).table


# ----------------------------------------------------------------- company
def _company_inputs(spark: SparkSession, d: str):
    return V.company_src(spark, d), V.company_dim(spark, d)


def q_company_spine(spark: SparkSession, d: str) -> DataFrame:
    src, tgt = _company_inputs(spark, d)
    return key_spine(incremental_delta(src, WINDOW.lo), tgt, company.KEY, company.SK)


def _company_spine_keys(spark: SparkSession, d: str):
    src, tgt = _company_inputs(spark, d)
    delta = incremental_delta(src, WINDOW.lo)
    fresh = new_keys(delta, tgt, company.KEY, carry=["row_stat_cd"])
    ka = assign_surrogate_keys(fresh, company.KEY, company.SK, max_key(tgt, company.SK))
    return delta, company.spine_with_keys(delta, tgt, ka)


def q_company_keys(spark: SparkSession, d: str) -> DataFrame:
    return _company_spine_keys(spark, d)[1]


def q_company_parents(spark: SparkSession, d: str) -> DataFrame:
    delta, spine = _company_spine_keys(spark, d)
    rows = delta.select(*company.KEY, *company.POINTERS).join(spine.select(*company.KEY, company.SK), company.KEY)
    out = company.resolve_pointers(rows, spine)
    return out.select(*company.KEY, company.SK, *company.POINTERS.values())


def q_company_merge(spark: SparkSession, d: str) -> DataFrame:
    src, tgt = _company_inputs(spark, d)
    return company.run(src, tgt, WINDOW, max_key(tgt, company.SK), loopback=False).table


def q_company_full(spark: SparkSession, d: str) -> DataFrame:
    src, tgt = _company_inputs(spark, d)
    return company.run(src, tgt, WINDOW, max_key(tgt, company.SK)).table


def q_company_loopback(spark: SparkSession, d: str) -> DataFrame:
    """The loopback on its own: the prior dimension repaired from every source
    row's pointers, resolved against this run's spine (no merge first)."""
    src, tgt = _company_inputs(spark, d)
    _, spine = _company_spine_keys(spark, d)
    resolved = company.resolve_pointers(src.select(*company.KEY, *company.POINTERS), spine)
    return loopback_repair(tgt, resolved, company.KEY, list(company.POINTERS.values()), run_ts=WINDOW.run_ts,
                           only_nonzero=True)


def q_company_orphans(spark: SparkSession, d: str) -> DataFrame:
    return orphan_report(q_company_full(spark, d), list(company.POINTERS.values()))


# ------------------------------------------------------------------ direct
def _direct_inputs(spark: SparkSession, d: str):
    return V.direct_src(spark, d), V.direct_tgt(spark, d), V.site_dim(spark, d), V.calendar(spark, d)


def q_direct_new_keys(spark: SparkSession, d: str) -> DataFrame:
    src, tgt, _, _ = _direct_inputs(spark, d)
    return new_keys(incremental_delta(src, WINDOW.lo), tgt, direct_mail.KEY)


def q_direct_keys(spark: SparkSession, d: str) -> DataFrame:
    src, tgt, _, _ = _direct_inputs(spark, d)
    fresh = new_keys(incremental_delta(src, WINDOW.lo), tgt, direct_mail.KEY)
    return assign_surrogate_keys(fresh, direct_mail.KEY, direct_mail.SK, max_key(tgt, direct_mail.SK)).keyed


def q_direct_site_key(spark: SparkSession, d: str) -> DataFrame:
    src, _, sites, _ = _direct_inputs(spark, d)
    out = direct_mail.site_key(incremental_delta(src, WINDOW.lo), sites)
    return out.select(*direct_mail.KEY, "spls_site_id", "spls_site_ky")


def q_direct_date_keys(spark: SparkSession, d: str) -> DataFrame:
    src, _, _, cal = _direct_inputs(spark, d)
    out = resolve_date_keys(incremental_delta(src, WINDOW.lo), cal, direct_mail.DATE_ROLES)
    return out.select(*direct_mail.KEY, *direct_mail.DATE_ROLES.values())


def q_direct_merge(spark: SparkSession, d: str) -> DataFrame:
    src, tgt, sites, cal = _direct_inputs(spark, d)
    return direct_mail.run(src, tgt, sites, cal, WINDOW, max_key(tgt, direct_mail.SK), loopback=False).table


def q_direct_full(spark: SparkSession, d: str) -> DataFrame:
    src, tgt, sites, cal = _direct_inputs(spark, d)
    return direct_mail.run(src, tgt, sites, cal, WINDOW, max_key(tgt, direct_mail.SK)).table


def q_direct_loopback(spark: SparkSession, d: str) -> DataFrame:
    """The loopback on its own: every prior fact row's site key re-resolved
    from its source row (live sites only)."""
    src, tgt, sites, _ = _direct_inputs(spark, d)
    resolved = direct_mail.site_key(src.select(*direct_mail.KEY, "spls_site_id"), sites)
    return loopback_repair(tgt, resolved, direct_mail.KEY, ["spls_site_ky"], run_ts=WINDOW.run_ts)


def q_direct_dedupe_newest(spark: SparkSession, d: str) -> DataFrame:
    """Duplicate natural keys resolved newest-wins (the ``dedupe_by`` option):
    one row per key, the highest order key kept, over all orders."""
    return dedupe_newest(V.direct_raw(spark, d), direct_mail.KEY, ["o_orderkey"])


def q_direct_orphans(spark: SparkSession, d: str) -> DataFrame:
    return orphan_report(q_direct_full(spark, d), ["spls_site_ky"])


def q_guard_orphans(spark: SparkSession, d: str) -> DataFrame:
    """Share of unknown (-1) and not-applicable (0) keys per foreign key after
    the company and direct loads, one report."""
    cmpy = orphan_report(q_company_full(spark, d), list(company.POINTERS.values()))
    drct = orphan_report(q_direct_full(spark, d), ["spls_site_ky"])
    return (cmpy.select(F.lit("D_CMPY").alias("tbl_nm"), "*")
            .unionByName(drct.select(F.lit("F_DRCT_ML_PROMO").alias("tbl_nm"), "*")))


# ---------------------------------------------------------------- taxonomy
def q_taxonomy_direct_counts(spark: SparkSession, d: str) -> DataFrame:
    return taxonomy.direct_counts(V.direct_src(spark, d), V.site_dim(spark, d), V.cust_flat(spark, d))


def q_taxonomy_email_counts(spark: SparkSession, d: str) -> DataFrame:
    return taxonomy.email_counts(V.email_src(spark, d), V.eml_dim(spark, d), V.usr_eml(spark, d), V.usr(spark, d))


def q_taxonomy_keys(spark: SparkSession, d: str) -> DataFrame:
    src, tgt = V.txn_src(spark, d), V.txn_tgt(spark, d)
    fresh = new_keys(incremental_delta(src, WINDOW.lo), tgt, taxonomy.KEY)
    return assign_surrogate_keys(fresh, taxonomy.KEY, taxonomy.SK, max_key(tgt, taxonomy.SK)).keyed


def _taxonomy_run(spark: SparkSession, d: str):
    tgt = V.txn_tgt(spark, d)
    return taxonomy.run(
        V.txn_src(spark, d), tgt, V.calendar(spark, d), WINDOW, max_key(tgt, taxonomy.SK),
        direct_promos=V.direct_src(spark, d), sites=V.site_dim(spark, d), customers=V.cust_flat(spark, d),
        email_promos=V.email_src(spark, d), emails=V.eml_dim(spark, d), bridge=V.usr_eml(spark, d),
        users=V.usr(spark, d),
    )


def q_taxonomy_full(spark: SparkSession, d: str) -> DataFrame:
    return _taxonomy_run(spark, d).table


# ------------------------------------------------------------------ guards
def q_guard_duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return duplicate_keys(V.direct_raw(spark, d), direct_mail.KEY)


def q_guard_null_keys(spark: SparkSession, d: str) -> DataFrame:
    return split_null_keys(V.direct_raw_with_null_keys(spark, d), direct_mail.KEY)[1]


# --------------------------------------------------------- larger key sets
LINE_KEY = ["l_orderkey", "l_linenumber"]


def q_lineitem_keys(spark: SparkSession, d: str) -> DataFrame:
    """Dense keys over every distinct (order, line) pair of lineitem: the
    key-assignment path on the largest table, from high-water 0."""
    lines = V.table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
    ).distinct()
    return assign_surrogate_keys(lines, LINE_KEY, "line_ky", 0).keyed


def q_lineitem_duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    lines = V.table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
    )
    return duplicate_keys(lines, LINE_KEY)


# ------------------------------------------- the large-data plans of the loads
def _without_broadcasts(query):
    """The same query in a session that refuses broadcasts: every join shuffles."""
    def run(spark: SparkSession, d: str) -> DataFrame:
        refusing = spark.newSession()
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            refusing.conf.set(key, "-1")
        return query(refusing, d)
    return run


# ------------------------------------------- publish, windows, counters, guards
def _store(spark: SparkSession, **options) -> SnapshotStore:
    return SnapshotStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/stores/{uuid.uuid4().hex}", **options)


def _email_store(spark: SparkSession, d: str):
    """A store whose first version is the prior e-mail fact, and the load as a job."""
    src, tgt, cal = _email_inputs(spark, d)
    store = _store(spark, bucket_by=(4, email.KEY))
    store.publish(tgt, expect_version=0, high_water={"EML_PROMO_KY": max_key(tgt, email.SK)}, run_ts=WINDOW.lo)
    return store, tgt.schema, lambda target, window, hw: email.run(src, target, cal, window, hw)


def q_publish_readback(spark: SparkSession, d: str) -> DataFrame:
    """The whole e-mail load published to a bucketed store and read back; old versions removed."""
    store, schema, job = _email_store(spark, d)
    run_load(store, "F_EML_PROMO", "EML_PROMO_KY", job, schema=schema, now=WINDOW.run_ts)
    store.vacuum(keep=1)
    return store.read(schema)


def q_window_resume(spark: SparkSession, d: str) -> DataFrame:
    """A run that dies leaves its window open; the next one resumes it and loads the same rows."""
    store, schema, job = _email_store(spark, d)

    def dying(target, window, hw):
        raise ConnectionError("lost before the merge")

    try:
        run_load(store, "F_EML_PROMO", "EML_PROMO_KY", dying, schema=schema, now=datetime(2024, 1, 31))
    except ConnectionError:
        pass
    report = run_load(store, "F_EML_PROMO", "EML_PROMO_KY", job, schema=schema, now=WINDOW.run_ts)
    return store.read(schema).withColumn("resumed", F.lit(report.window.resumed))


def q_run_tables_released(spark: SparkSession, d: str) -> DataFrame:
    """Temporary tables that a whole e-mail run leaves behind, beside the rows it published."""
    store, schema, job = _email_store(spark, d)
    fs, folder = hadoop_path(spark, f"{checkpoint_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}")

    def tables() -> set:
        return {s.getPath().getName() for s in fs.listStatus(folder)} if fs.exists(folder) else set()

    before = tables() | {"_lease"}
    run_load(store, "F_EML_PROMO", "EML_PROMO_KY", job, schema=schema, now=WINDOW.run_ts)
    left = len(tables() - before)
    return store.read(schema).agg(F.count(F.lit(1)).alias("row_cnt")).withColumn("left_cnt", F.lit(left).cast("bigint"))


def q_partition_publish(spark: SparkSession, d: str) -> DataFrame:
    """The company load in a store partitioned by key: only changed partitions are rewritten."""
    src, tgt = _company_inputs(spark, d)
    # a partition is written when one of its rows carries the run's time
    fresh = tgt.withColumn("row_updt_tms", F.lit(str(WINDOW.lo)).cast("timestamp_ntz"))
    store = _store(spark, partition_by=F.col(company.SK) % 16)
    store.publish(fresh, expect_version=0, high_water={"K": max_key(tgt, company.SK)}, run_ts=WINDOW.lo)
    run_load(store, "D_CMPY", "K", lambda t, w, hw: company.run(src, t, w, hw), schema=tgt.schema, now=WINDOW.run_ts)
    return store.read(tgt.schema).drop("_ml_p", "row_updt_tms")


def q_partition_publish_keyed(spark: SparkSession, d: str) -> DataFrame:
    """The same in a store that knows the natural key: touched partitions are
    rewritten from the stored changes, the load's joins run once."""
    src, tgt = _company_inputs(spark, d)
    fresh = tgt.withColumn("row_updt_tms", F.lit(str(WINDOW.lo)).cast("timestamp_ntz"))
    store = _store(spark, partition_by=F.col(company.SK) % 16, key=company.KEY)
    store.publish(fresh, expect_version=0, high_water={"K": max_key(tgt, company.SK)}, run_ts=WINDOW.lo)
    run_load(store, "D_CMPY", "K", lambda t, w, hw: company.run(src, t, w, hw), schema=tgt.schema, now=WINDOW.run_ts)
    return store.read(tgt.schema).drop("_ml_p", "row_updt_tms")


def q_partition_bucket_publish(spark: SparkSession, d: str) -> DataFrame:
    """The same again with buckets of the natural key inside every partition."""
    src, tgt = _company_inputs(spark, d)
    fresh = tgt.withColumn("row_updt_tms", F.lit(str(WINDOW.lo)).cast("timestamp_ntz"))
    store = _store(spark, partition_by=F.col(company.SK) % 8, bucket_by=(4, company.KEY), key=company.KEY)
    store.publish(fresh, expect_version=0, high_water={"K": max_key(tgt, company.SK)}, run_ts=WINDOW.lo)
    run_load(store, "D_CMPY", "K", lambda t, w, hw: company.run(src, t, w, hw), schema=tgt.schema, now=WINDOW.run_ts)
    return store.read(tgt.schema).drop("_ml_p", "row_updt_tms")


def q_publish_changeset(spark: SparkSession, d: str) -> DataFrame:
    """The e-mail load in a store of change sets: the run writes the rows it changed, reading joins them with the base."""
    src, tgt, cal = _email_inputs(spark, d)
    store = _store(spark, key=email.KEY, compact_at=10.0)
    store.publish(tgt, expect_version=0, high_water={"EML_PROMO_KY": max_key(tgt, email.SK)}, run_ts=WINDOW.lo)
    run_load(store, "F_EML_PROMO", "EML_PROMO_KY", lambda t, w, hw: email.run(src, t, cal, w, hw), schema=tgt.schema,
             now=WINDOW.run_ts)
    return store.read(tgt.schema)


def q_direct_loopback_indexed(spark: SparkSession, d: str) -> DataFrame:
    """Two direct-mail runs with the kept reference index. Between them sites
    appear and change their keys; the second run's source brings nothing, and
    its loopback reads the entries of the changed sites and those still differing."""
    src, tgt, sites, cal = _direct_inputs(spark, d)
    site = F.col("spls_site_id")
    before = sites.withColumn("row_stat_cd", F.when(site % 7 == 3, "DEL").otherwise(F.col("row_stat_cd"))).withColumn(
        "spls_site_ky", F.when(site % 5 == 1, F.col("spls_site_ky") + 100000).otherwise(F.col("spls_site_ky")))
    store = _store(spark, key=direct_mail.KEY, compact_at=10.0)
    store.publish(tgt, expect_version=0, high_water={"K": max_key(tgt, direct_mail.SK)}, run_ts=WINDOW.lo)
    for day, dim in ((WINDOW.run_ts, before), (NEXT_RUN, sites)):
        run_load(store, "F_DRCT_ML_PROMO", "K", lambda t, w, hw, dim=dim: direct_mail.run(
            src, t, dim, cal, w, hw, index=direct_mail.site_index(store, buckets=8)), schema=tgt.schema, now=day)
    return store.read(tgt.schema)


def q_company_loopback_indexed(spark: SparkSession, d: str) -> DataFrame:
    """Two company runs with the kept pointer index: every 13th company is
    deleted in the first and comes back in the second, whose loopback reads the entries that point at those."""
    src, tgt = _company_inputs(spark, d)
    some = F.col("spls_cmpy_id") % 13 == 3
    early = src.withColumn("row_stat_cd", F.when(some, "DEL").otherwise(F.col("row_stat_cd")))
    late = src.withColumn("row_stat_cd", F.when(some, "NEW").otherwise(F.col("row_stat_cd"))).withColumn(
        "row_updt_tms", F.when(some, F.lit("2024-02-01 12:00:00").cast("timestamp_ntz")).otherwise(F.col("row_updt_tms")))
    store = _store(spark, key=company.KEY, compact_at=10.0)
    store.publish(tgt, expect_version=0, high_water={"K": max_key(tgt, company.SK)}, run_ts=WINDOW.lo)
    for day, source in ((WINDOW.run_ts, early), (NEXT_RUN, late)):
        run_load(store, "D_CMPY", "K", lambda t, w, hw, source=source: company.run(
            source, t, w, hw, index=company.pointer_index(store, buckets=8)), schema=tgt.schema, now=day)
    return store.read(tgt.schema)


def q_taxonomy_counts_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The taxonomy load from kept counts: an earlier run counted other
    promotions, sites and master customers; this one reads the changed promotions only."""
    tgt = V.txn_tgt(spark, d)
    order, event = F.col("o_orderkey"), F.col("eml_id")
    direct, emails = V.direct_src(spark, d, keep_orderkey=True), V.email_src(spark, d)
    sites, customers, eml, bridge, users = (
        V.site_dim(spark, d), V.cust_flat(spark, d), V.eml_dim(spark, d), V.usr_eml(spark, d), V.usr(spark, d))
    master = F.col("mstr_cust_ky")
    store = _store(spark)
    earlier = taxonomy.KeptCounts(store)
    earlier.direct(direct.filter(order % 5 != 0).withColumn("spls_site_id", F.when(order % 4 == 1, order % 13).otherwise(F.col("spls_site_id"))),
                   sites, customers.withColumn("mstr_cust_ky", F.when(master % 3 == 0, master + 1000).otherwise(master)))
    earlier.email(emails.filter(event % 6 != 0), eml, bridge, users.withColumn(
        "mstr_cust_ky", F.when(master % 4 == 0, F.lit(None)).otherwise(master + master % 2)))
    store.publish(tgt, expect_version=0, high_water={"K": max_key(tgt, taxonomy.SK)}, run_ts=WINDOW.lo, side=earlier.side)
    earlier.release()

    def job(target, window, hw):
        return taxonomy.run(
            V.txn_src(spark, d), target, V.calendar(spark, d), window, hw, sites=sites, customers=customers, emails=eml,
            bridge=bridge, users=users, direct_promos=direct.filter((order % 5 == 0) | (order % 4 == 1)),
            email_promos=emails.filter(event % 6 == 0), kept=taxonomy.KeptCounts(store))

    run_load(store, "F_SRC_TXNMY", "K", job, schema=tgt.schema, now=WINDOW.run_ts)
    return store.read(tgt.schema)


NEXT_RUN = datetime(2024, 2, 2)


def q_quarantine_replay(spark: SparkSession, d: str) -> DataFrame:
    """Rows without an e-mail key are rejected by the first run, stay in the
    store, and are loaded by the next one after a repair."""
    src, tgt, cal = _email_inputs(spark, d)
    broken = src.withColumn("eml_ky", F.when(F.col("eml_id") % 97 != 0, F.col("eml_ky")))
    store = _store(spark)
    store.publish(tgt, expect_version=0, high_water={"EML_PROMO_KY": max_key(tgt, email.SK)}, run_ts=WINDOW.lo)

    def job(target, window, hw, repaired=None):
        return email.run(broken, target, cal, window, hw, replayed=repaired)

    run_load(store, "F_EML_PROMO", "EML_PROMO_KY", job, schema=tgt.schema, now=WINDOW.run_ts)
    run_load(store, "F_EML_PROMO", "EML_PROMO_KY", job, schema=tgt.schema, now=NEXT_RUN,
             replay=lambda rejected: rejected.withColumn("eml_ky", F.col("eml_id") + 1))
    return store.read(tgt.schema)


def q_window_takeover(spark: SparkSession, d: str) -> DataFrame:
    """A run dies holding its window; once the lease has expired the next run
    takes it over and loads the same rows; the former owner may not commit."""
    clock = [datetime(2024, 1, 31)]
    src, tgt, cal = _email_inputs(spark, d)
    store = _store(spark, clock=lambda: clock[0])
    store.publish(tgt, expect_version=0, high_water={"EML_PROMO_KY": max_key(tgt, email.SK)}, run_ts=WINDOW.lo)
    _, dead = open_window(store, "F_EML_PROMO", WINDOW.lo, now=clock[0])

    def job(target, window, hw):
        return email.run(src, target, cal, window, hw)

    try:
        run_load(store, "F_EML_PROMO", "EML_PROMO_KY", job, schema=tgt.schema, now=WINDOW.run_ts)
        busy = False
    except WindowBusy:
        busy = True
    clock[0] = datetime(2024, 1, 31, 2)
    report = run_load(store, "F_EML_PROMO", "EML_PROMO_KY", job, schema=tgt.schema, now=WINDOW.run_ts)
    try:
        store.publish(tgt, expect_version=2, run_ts=NEXT_RUN, lease=dead)
        fenced = False
    except LeaseLost:
        fenced = True
    return store.read(tgt.schema).select("*", F.lit(busy).alias("busy"), F.lit(report.window.resumed).alias("resumed"),
                                         F.lit(fenced).alias("fenced"))


def _registry_after(tgt: DataFrame, sk: str, table: str, column: str, high_water: int) -> DataFrame:
    registry = tgt.agg(F.max(sk).cast("bigint").alias("lst_assgnd_id")).select(
        F.lit(table).alias("tbl_nm"), F.lit(column).alias("clmn_nm"), "lst_assgnd_id",
        F.lit("2024-01-02 00:00:00").cast("timestamp_ntz").alias("row_updt_tms"))
    return update_registry(registry, table, column, high_water, WINDOW.run_ts)


def q_company_high_water(spark: SparkSession, d: str) -> DataFrame:
    src, tgt = _company_inputs(spark, d)
    fresh = new_keys(incremental_delta(src, WINDOW.lo), tgt, company.KEY)
    ka = assign_surrogate_keys(fresh, company.KEY, company.SK, max_key(tgt, company.SK))
    return _registry_after(tgt, company.SK, "D_CMPY", "SPLS_CMPY_KY", ka.high_water)


def q_direct_high_water(spark: SparkSession, d: str) -> DataFrame:
    src, tgt, _, _ = _direct_inputs(spark, d)
    fresh = new_keys(incremental_delta(src, WINDOW.lo), tgt, direct_mail.KEY)
    ka = assign_surrogate_keys(fresh, direct_mail.KEY, direct_mail.SK, max_key(tgt, direct_mail.SK))
    return _registry_after(tgt, direct_mail.SK, "F_DRCT_ML_PROMO", "DRCT_ML_PROMO_KY", ka.high_water)


def q_taxonomy_high_water(spark: SparkSession, d: str) -> DataFrame:
    src, tgt = V.txn_src(spark, d), V.txn_tgt(spark, d)
    fresh = new_keys(incremental_delta(src, WINDOW.lo), tgt, taxonomy.KEY)
    ka = assign_surrogate_keys(fresh, taxonomy.KEY, taxonomy.SK, max_key(tgt, taxonomy.SK))
    return _registry_after(tgt, taxonomy.SK, "F_SRC_TXNMY", "SRC_TXNMY_KY", ka.high_water)


def _null_codes(promos: DataFrame, key: str) -> DataFrame:
    """A third of the promotions without a source code."""
    return promos.withColumn("src_cd", F.when(F.col(key) % 3 != 0, F.col("src_cd")))


def q_taxonomy_direct_counts_null_code(spark: SparkSession, d: str) -> DataFrame:
    return taxonomy.direct_counts(_null_codes(V.direct_src(spark, d), "spls_prsn_id"), V.site_dim(spark, d),
                                  V.cust_flat(spark, d))


def q_taxonomy_email_counts_null_code(spark: SparkSession, d: str) -> DataFrame:
    return taxonomy.email_counts(_null_codes(V.email_src(spark, d), "eml_ky"), V.eml_dim(spark, d), V.usr_eml(spark, d),
                                 V.usr(spark, d))


def q_guard_surrogate_keys(spark: SparkSession, d: str) -> DataFrame:
    """G3 over the company load's result: inserted keys unique and above the old mark."""
    src, tgt = _company_inputs(spark, d)
    old = max_key(tgt, company.SK)
    res = company.run(src, tgt, WINDOW, old)
    return surrogate_key_report(res.table, company.SK, old, res.high_water, run_ts=WINDOW.run_ts)


def q_guard_lookup_unique(spark: SparkSession, d: str) -> DataFrame:
    """G4: live rows and distinct live ids of every lookup of the loads."""
    def report(name: str, live: DataFrame, key: str) -> DataFrame:
        return live.filter(F.col(key).isNotNull()).agg(
            F.count(F.lit(1)).alias("row_cnt"), F.count_distinct(key).alias("id_cnt")).select(F.lit(name).alias("lookup_nm"), "*")

    spine = _company_spine_keys(spark, d)[1].filter("row_stat_cd <> 'DEL'")
    return (report("company", spine, "spls_cmpy_id")
            .unionByName(report("site", V.site_dim(spark, d).filter("row_stat_cd <> 'DEL'"), "spls_site_id"))
            .unionByName(report("calendar", V.calendar(spark, d), "cld_dt")))


def q_guard_row_conservation(spark: SparkSession, d: str) -> DataFrame:
    """G5 for the direct load: rows before, inserted and after."""
    src, tgt, sites, cal = _direct_inputs(spark, d)
    res = direct_mail.run(src, tgt, sites, cal, WINDOW, max_key(tgt, direct_mail.SK))
    return res.table.agg(F.count(F.lit(1)).alias("after_cnt")).select(
        F.lit(tgt.count()).cast("bigint").alias("before_cnt"), F.lit(res.assigned).cast("bigint").alias("inserted_cnt"),
        "after_cnt")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "email_delta": q_email_delta,
    "email_new_keys": q_email_new_keys,
    "email_new_keys_skipping": q_email_new_keys_skipping,
    "email_keys": q_email_keys,
    "email_high_water": q_email_high_water,
    "email_date_keys": q_email_date_keys,
    "email_merge": q_email_merge,
    "email_case_blind": q_email_case_blind,
    "email_upsert_full_outer": q_email_upsert_full_outer,
    "email_upsert_broadcast": q_email_upsert_broadcast,
    "company_spine": q_company_spine,
    "company_keys": q_company_keys,
    "company_parents": q_company_parents,
    "company_merge": q_company_merge,
    "company_full": q_company_full,
    "company_loopback": q_company_loopback,
    "company_orphans": q_company_orphans,
    "direct_new_keys": q_direct_new_keys,
    "direct_keys": q_direct_keys,
    "direct_site_key": q_direct_site_key,
    "direct_date_keys": q_direct_date_keys,
    "direct_merge": q_direct_merge,
    "direct_full": q_direct_full,
    "direct_loopback": q_direct_loopback,
    "direct_dedupe_newest": q_direct_dedupe_newest,
    "direct_orphans": q_direct_orphans,
    "taxonomy_direct_counts": q_taxonomy_direct_counts,
    "taxonomy_email_counts": q_taxonomy_email_counts,
    "taxonomy_keys": q_taxonomy_keys,
    "taxonomy_full": q_taxonomy_full,
    "guard_duplicate_keys": q_guard_duplicate_keys,
    "guard_null_keys": q_guard_null_keys,
    "guard_orphans": q_guard_orphans,
    "lineitem_keys": q_lineitem_keys,
    "lineitem_duplicate_keys": q_lineitem_duplicate_keys,
    "email_merge_shuffle": _without_broadcasts(q_email_merge),
    "company_full_shuffle": _without_broadcasts(q_company_full),
    "direct_full_shuffle": _without_broadcasts(q_direct_full),
    "taxonomy_full_shuffle": _without_broadcasts(q_taxonomy_full),
    "publish_readback": q_publish_readback,
    "partition_publish": q_partition_publish,
    "window_resume": q_window_resume,
    "window_takeover": q_window_takeover,
    "quarantine_replay": q_quarantine_replay,
    "run_tables_released": q_run_tables_released,
    "direct_loopback_indexed": q_direct_loopback_indexed,
    "company_loopback_indexed": q_company_loopback_indexed,
    "taxonomy_counts_incremental": q_taxonomy_counts_incremental,
    "publish_changeset": q_publish_changeset,
    "partition_publish_keyed": q_partition_publish_keyed,
    "partition_bucket_publish": q_partition_bucket_publish,
    "company_high_water": q_company_high_water,
    "direct_high_water": q_direct_high_water,
    "taxonomy_high_water": q_taxonomy_high_water,
    "taxonomy_direct_counts_null_code": q_taxonomy_direct_counts_null_code,
    "taxonomy_email_counts_null_code": q_taxonomy_email_counts_null_code,
    "guard_surrogate_keys": q_guard_surrogate_keys,
    "guard_lookup_unique": q_guard_lookup_unique,
    "guard_row_conservation": q_guard_row_conservation,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the whole e-mail promotion load on sf0.001."""
    return q_email_merge(spark, SMOKE_DIR)


try:  # the training-data operators are an optional subpackage
    import corpus_pipeline
    from martloom.llm.queries import ORACLE_SQL as _LLM_SQL
    from martloom.llm.queries import QUERIES as _LLM_QUERIES
except ImportError:
    _LLM_QUERIES, _LLM_SQL = {}, {}
else:
    _LLM_QUERIES = {**_LLM_QUERIES, "pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL:
        _LLM_SQL = {**_LLM_SQL, "pipeline": corpus_pipeline.ORACLE_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_LLM_QUERIES}


def oracle_sql() -> dict[str, str]:
    from oracle_sql import QUERIES

    return {name: QUERIES[name] for name in _QUERIES if name in QUERIES} | _LLM_SQL
