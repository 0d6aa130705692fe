"""Source-code taxonomy with exact distinct promotion counts per code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.guards import check_lookup_unique
from martloom.operators.lookup import resolve_date_keys
from martloom.operators.rollup import distinct_rollup
from martloom.operators.support import SupportCounts
from martloom.plans.common import NEW_FLAG, JobResult, attach_new_keys, both_forms, mint_keys, prepare_delta
from martloom.session import stored_table
from martloom.sources.control import LoadWindow
from martloom.sources.snapshot import SideChange, SnapshotStore

# Fixed names of the taxonomy mart (they must match its columns): natural key,
# surrogate key, calendar roles, attributes, counts, and the merge column lists.
KEY = ["src_cd"]
SK = "src_txnmy_ky"
# Calendar keys are carried next to the three dates (the reference selected
# lookups it never wrote; the dates drive the lookups here).
DATE_ROLES = {"cmpgn_strt_dt": "cmpgn_strt_tm_ky", "cmpgn_end_dt": "cmpgn_end_tm_ky", "drp_dt": "drp_tm_ky"}
ATTRIBUTES = [
    "pgm_cd", "pgm_nm", "cmpgn_cd", "cmpgn_nm", "cmpgn_typ_nm", "vrsn_cd", "vrsn_desc", "vrsn_frmt_nm",
    "segmt_cd", "segmt_nm", "chnnl_cd", "chnnl_nm", "cst_per_piece_ind", "test_cmpgn_ind",
]
COUNTS = ["promo_site_cnt", "promo_usr_cnt", "promo_mstr_cust_cnt", "promo_eml_cnt"]
TARGET_COLUMNS = [
    SK, "src_cd", *ATTRIBUTES,
    "cmpgn_strt_tm_ky", "cmpgn_strt_dt", "cmpgn_end_tm_ky", "cmpgn_end_dt", "drp_tm_ky", "drp_dt",
    "pdt_prmry_ctgry_nm", *COUNTS, "row_updt_tms", "row_insrt_tms", "row_stat_cd",
]
UPDATE_COLS = [c for c in TARGET_COLUMNS if c not in (SK, "src_cd", "row_updt_tms", "row_insrt_tms", "row_stat_cd")]
INSERT_COLS = [c for c in TARGET_COLUMNS if c not in ("row_updt_tms", "row_insrt_tms", "row_stat_cd")]


def _of_codes(promos: DataFrame, codes: DataFrame | None) -> DataFrame:
    return promos if codes is None else promos.join(codes, on="src_cd", how="left_semi")


def _with_masters(per_code: DataFrame, chain: DataFrame) -> DataFrame:
    """``per_code`` (one row per code, a NULL code among them) with the distinct
    masters of ``chain``, 0 for a code without any."""
    masters = distinct_rollup(chain, ["src_cd"], {"promo_mstr_cust_cnt": "mstr_cust_ky"}).withColumnRenamed("src_cd", "_code")
    out = per_code.join(masters, per_code["src_cd"].eqNullSafe(F.col("_code")), "left").drop("_code")
    return out.withColumn("promo_mstr_cust_cnt", F.coalesce("promo_mstr_cust_cnt", F.lit(0).cast("bigint")))


def direct_counts(promos: DataFrame, sites: DataFrame, customers: DataFrame,
                  codes: DataFrame | None = None) -> DataFrame:
    """Per code: distinct sites, persons and ship-to master customers of the
    direct-mail promotions (full history; every site row counts, 'DEL' too).

    The site and person counts need no join. The master-customer count goes
    through site -> ship-to customer, so the promotions are first reduced to
    distinct (code, site) pairs (map-side combine before the shuffle): a site
    carrying a third of all promotions becomes one row per code before it
    reaches a join. A missing site or customer adds no master, so the chain
    joins are inner ones and no NULL key is shuffled; codes without masters,
    the NULL code too, get their 0 when the counts meet.
    """
    p = _of_codes(promos.select("src_cd", "spls_site_id", "spls_prsn_id"), codes)
    site_usr = distinct_rollup(p, ["src_cd"], {"promo_site_cnt": "spls_site_id", "promo_usr_cnt": "spls_prsn_id"})
    pairs = p.select("src_cd", "spls_site_id").filter(F.col("spls_site_id").isNotNull()).distinct()
    return _with_masters(site_usr, pairs.join(site_masters(sites, customers), on="spls_site_id"))


def site_masters(sites: DataFrame, customers: DataFrame) -> DataFrame:
    """Distinct (site, master customer) pairs through the ship-to customers."""
    shipto = customers.filter(F.col("cust_lvl") == F.lit("SHIPTO")).select("spls_site_ky", "mstr_cust_ky")
    return sites.select("spls_site_id", "spls_site_ky").join(shipto, on="spls_site_ky").select(
        "spls_site_id", "mstr_cust_ky").distinct()


def email_counts(promos: DataFrame, emails: DataFrame, bridge: DataFrame, users: DataFrame,
                 codes: DataFrame | None = None) -> DataFrame:
    """Per code: distinct master customers (through e-mail -> user bridge ->
    user) and distinct e-mails.

    Exact rewrite of the left-join chain for skew: promotions are reduced to
    distinct (code, e-mail) pairs, and the many-to-many bridge to distinct
    (e-mail, master customer) pairs *before* they meet. An address sent a
    third of all promotions is then one row per code, and an address shared by
    a million users is one row per master customer. The e-mail count needs no
    join at all. A missing e-mail, bridge row or user adds no master, so the
    chain joins are inner ones.
    """
    pairs = _of_codes(promos.select("src_cd", "eml_id"), codes).distinct()
    masters = email_masters(emails, bridge, users)
    emls = distinct_rollup(pairs, ["src_cd"], {"promo_eml_cnt": "eml_id"})
    return _with_masters(emls, pairs.join(masters, on="eml_id")).select("src_cd", "promo_mstr_cust_cnt", "promo_eml_cnt")


def email_masters(emails: DataFrame, bridge: DataFrame, users: DataFrame) -> DataFrame:
    """Distinct (e-mail, master customer) pairs through the user bridge."""
    return (
        bridge.select("eml_ky", "oms_usr_ky")
        .join(users.select("oms_usr_ky", "mstr_cust_ky").filter(F.col("mstr_cust_ky").isNotNull()), on="oms_usr_ky")
        .select("eml_ky", "mstr_cust_ky").distinct()
        .join(emails.select("eml_id", "eml_ky"), on="eml_ky")
        .select("eml_id", "mstr_cust_ky").distinct()
    )


class KeptCounts:
    """The counts of all codes, kept in the store and moved by what changed.

    :meth:`direct` and :meth:`email` take the promotions changed since the last
    run (all, the first time) and the current dimensions, and return the same
    rows as :func:`direct_counts` and :func:`email_counts` over everything.
    ``side`` then holds what to publish with the run; ``release`` removes the
    temporary tables after that.
    """

    def __init__(self, store: SnapshotStore, direct_key: Sequence[str] = ("spls_prsn_id", "src_cd", "promo_dt"),
                 email_key: Sequence[str] = ("eml_ky", "src_cd")) -> None:
        self._sites = SupportCounts(store, "site_counts", direct_key, "src_cd", "spls_site_id", "mstr_cust_ky")
        self._persons = SupportCounts(store, "person_counts", direct_key, "src_cd", "spls_prsn_id")
        self._emails = SupportCounts(store, "email_counts", email_key, "src_cd", "eml_id", "mstr_cust_ky")
        self.side: dict[str, SideChange] = {}
        self._moved: list = []

    def _advance(self, counts: SupportCounts, changed: DataFrame, links: DataFrame | None = None) -> DataFrame:
        moved = counts.advance(changed, links)
        self._moved.append((counts, moved))
        self.side.update(moved.side)
        return moved.counts

    def direct(self, changed: DataFrame, sites: DataFrame, customers: DataFrame) -> DataFrame:
        by_site = self._advance(self._sites, changed, site_masters(sites, customers))
        by_person = self._advance(self._persons, changed).select(F.col("src_cd").alias("_code"), F.col("members").alias("promo_usr_cnt"))
        return by_site.join(by_person, by_site["src_cd"].eqNullSafe(F.col("_code"))).select(
            "src_cd", F.col("members").alias("promo_site_cnt"), "promo_usr_cnt", F.col("masters").alias("promo_mstr_cust_cnt"))

    def email(self, changed: DataFrame, emails: DataFrame, bridge: DataFrame, users: DataFrame) -> DataFrame:
        return self._advance(self._emails, changed, email_masters(emails, bridge, users)).select(
            "src_cd", F.col("masters").alias("promo_mstr_cust_cnt"), F.col("members").alias("promo_eml_cnt"))

    def release(self) -> None:
        for counts, moved in self._moved:
            counts.release(moved)


def attach_counts(df: DataFrame, direct: DataFrame, email: DataFrame) -> DataFrame:
    """Codes without promotions get NULL counts; the master-customer count is
    direct's (even 0) before e-mail's."""
    d = direct.select("src_cd", *[F.col(c).alias(f"_d_{c}") for c in direct.columns if c != "src_cd"])
    e = email.select("src_cd", *[F.col(c).alias(f"_e_{c}") for c in email.columns if c != "src_cd"])
    out = df.join(d, on="src_cd", how="left").join(e, on="src_cd", how="left")
    keep = [F.col(c) for c in df.columns if c not in COUNTS]
    return out.select(
        *keep,
        F.col("_d_promo_site_cnt").alias("promo_site_cnt"),
        F.col("_d_promo_usr_cnt").alias("promo_usr_cnt"),
        F.coalesce(F.col("_d_promo_mstr_cust_cnt"), F.col("_e_promo_mstr_cust_cnt")).alias("promo_mstr_cust_cnt"),
        F.col("_e_promo_eml_cnt").alias("promo_eml_cnt"),
    )


def run(source: DataFrame, target: DataFrame, calendar: DataFrame, window: LoadWindow, high_water: int, *,
        direct_promos: DataFrame, sites: DataFrame, customers: DataFrame, email_promos: DataFrame,
        emails: DataFrame, bridge: DataFrame, users: DataFrame, dedupe_by: Sequence[str] | None = None,
        on_null_key: str = "quarantine", freeze_delta: bool = True,
        insert_buckets: tuple[int, Sequence[str]] | None = None,
        check_lookups: bool = True, check_duplicates: bool = True, replayed: DataFrame | None = None,
        kept: KeptCounts | None = None) -> JobResult:
    """The taxonomy load. With ``kept`` (a :class:`KeptCounts` of the store)
    the promotions given are those changed since the last run (all of them, the
    first time), and the counts of the delta's codes come from the kept ones."""
    if check_lookups:  # G4 (the rollup joins every site row, live or not, so only the calendar can fan out)
        check_lookup_unique(calendar, "cld_dt", status_col=None)
    prepared = prepare_delta(source, window.lo, KEY, what="F_SRC_TXNMY", dedupe_by=dedupe_by,
                             check_duplicates=check_duplicates, on_null_key=on_null_key, freeze=freeze_delta,
                             replayed=replayed)
    keys = mint_keys(prepared, target, KEY, SK, high_water)
    # counts are refreshed only for codes in the delta: restrict the promotion
    # scans to those codes before aggregating (same result, less to shuffle)
    codes = prepared.delta.select("src_cd")
    if kept is None:
        dc = direct_counts(direct_promos, sites, customers, codes)
        ec = email_counts(email_promos, emails, bridge, users, codes)
    else:
        dc, ec = kept.direct(direct_promos, sites, customers), kept.email(email_promos, emails, bridge, users)
        prepared.stored += [path for _, moved in kept._moved for path in moved.stored]
    merge_src = attach_counts(attach_new_keys(prepared.delta, keys, KEY, SK), dc, ec)
    # one row per code, used for the matched rows and for the inserts: stored, so both rollups run once
    merge_src, path = stored_table(resolve_date_keys(merge_src, calendar, DATE_ROLES, key=KEY))
    prepared.stored.append(path)
    carried = [c for c in target.columns if c not in TARGET_COLUMNS]  # a partitioned store's own column
    merged = both_forms(
        target.select(*TARGET_COLUMNS, *carried), merge_src, KEY, run_ts=window.run_ts, update_cols=UPDATE_COLS,
        insert_cols=INSERT_COLS, new_flag=NEW_FLAG, insert_buckets=insert_buckets,
    )
    return JobResult(merged["table"], keys.high_water, keys.assigned, prepared.quarantined, prepared.profile,
                     {"keys": keys.keyed, "direct_counts": dc, "email_counts": ec, "merge_source": merge_src},
                     SK, prepared.stored, merged["changes"], kept.side if kept else {})
