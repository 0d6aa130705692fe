"""Direct-mail promotion fact: site key with loopback, four calendar roles, upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.guards import check_lookup_unique
from martloom.operators.lookup import live_lookup, resolve_date_keys, resolve_key
from martloom.operators.reference_index import ReferenceIndex
from martloom.plans.common import (
    DELTA_FLAG,
    NEW_FLAG,
    JobResult,
    attach_new_keys,
    both_forms,
    mint_keys,
    prepare_delta,
)
from martloom.session import stored_table
from martloom.sources.control import LoadWindow
from martloom.sources.layers import without_keys
from martloom.sources.snapshot import SnapshotStore

# Fixed names of the direct-mail promotion fact (they must match its columns): natural key,
# surrogate key, calendar roles and count renames; the merge lists follow.
KEY = ["spls_prsn_id", "src_cd", "promo_dt"]
SK = "drct_ml_promo_ky"
# The drop-date key is looked up with the drop date (the reference used the
# last-order date for it, a defect).
DATE_ROLES = {
    "drop_dt": "drop_tm_ky",
    "allctn_strt_dt": "allctn_strt_tm_ky",
    "allctn_end_dt": "allctn_end_tm_ky",
    "last_ord_dt": "last_ord_tm_ky",
}
RENAMES = {"fsc_ytd_ordr_cnt": "fsc_ytd_ord_cnt", "pr_12_prds_ordr_cnt": "pr_12_prds_ord_cnt"}

# Fixed column lists of the reference merge. The matched update leaves out
# the site key, the drop-date key and the drop date; the loopback repairs the
# site key on a later run, the drop date is never updated.
UPDATE_COLS = [
    "allctn_strt_tm_ky", "allctn_strt_dt", "allctn_end_tm_ky", "allctn_end_dt", "last_ord_tm_ky",
    "last_ord_dt", "promo_typ_cd", "pdt_prmry_ctgry_nm", "fsc_ytd_ord_cnt", "pr_12_prds_ord_cnt",
    "pr_3_prds_rvn_amt", "pr_12_prds_rvn_amt", "sls_rep_nm",
]
INSERT_COLS = [
    "drct_ml_promo_ky", "src_cd", "spls_prsn_id", "spls_site_ky", "promo_dt", "drop_tm_ky", "drop_dt",
    "allctn_strt_tm_ky", "allctn_strt_dt", "allctn_end_tm_ky", "allctn_end_dt", "last_ord_tm_ky",
    "last_ord_dt", "promo_typ_cd", "pdt_prmry_ctgry_nm", "fsc_ytd_ord_cnt", "pr_12_prds_ord_cnt",
    "pr_3_prds_rvn_amt", "pr_12_prds_rvn_amt", "sls_rep_nm",
]
REPAIR_COLS = ["spls_site_ky"]


def site_key(df: DataFrame, sites: DataFrame) -> DataFrame:
    """0 for no site, the live site key, else -1 ('DEL' and NULL-status sites are not live)."""
    return resolve_key(df, sites, "spls_site_id", "spls_site_id", "spls_site_ky", "spls_site_ky", live=True)


def enrich(delta: DataFrame, sites: DataFrame, calendar: DataFrame) -> DataFrame:
    return dated(site_key(delta, sites), calendar)


def dated(delta: DataFrame, calendar: DataFrame) -> DataFrame:
    """Calendar keys for the four date roles and the count renames."""
    out = resolve_date_keys(delta, calendar, DATE_ROLES, key=KEY)
    for old, new in RENAMES.items():
        out = out.withColumnRenamed(old, new)
    return out


def site_index(store: SnapshotStore, buckets: int = 256) -> ReferenceIndex:
    """The kept index of the fact's site references, for ``run(..., index=...)``."""
    return ReferenceIndex(store, "sites", KEY, "spls_site_id", "spls_site_ky", buckets)


def run(source: DataFrame, target: DataFrame, sites: DataFrame, calendar: DataFrame, window: LoadWindow,
        high_water: int, *, loopback: bool = True, dedupe_by: Sequence[str] | None = None,
        on_null_key: str = "quarantine", freeze_delta: bool = True,
        insert_buckets: tuple[int, Sequence[str]] | None = None,
        check_lookups: bool = True, check_duplicates: bool = True, replayed: DataFrame | None = None,
        index: ReferenceIndex | None = None) -> JobResult:
    """The direct-mail load. With ``index`` (:func:`site_index` of the store) the
    loopback asks the kept references instead of every source row: the source is
    read for its delta alone, and the target is joined with the rows that
    change. Its first run builds the index from the whole source."""
    if check_lookups:  # G4: a lookup must not fan out rows of the merge
        check_lookup_unique(sites, "spls_site_id")
        check_lookup_unique(calendar, "cld_dt", status_col=None)
    indexed = loopback and index is not None and index.ready
    prepared = prepare_delta(source, window.lo, KEY, what="F_DRCT_ML_PROMO", dedupe_by=dedupe_by,
                             check_duplicates=check_duplicates, on_null_key=on_null_key, freeze=freeze_delta,
                             replayed=replayed, rest_cols=["spls_site_id"] if loopback and not indexed else None)

    def stored(df: DataFrame) -> DataFrame:
        out, path = stored_table(df)
        prepared.stored.append(path)
        return out

    keys = mint_keys(prepared, target, KEY, SK, high_water)
    delta_part = dated(attach_new_keys(prepared.delta, keys, KEY, SK), calendar).withColumn(DELTA_FLAG, F.lit(True))
    if indexed:
        live = live_lookup(sites, "spls_site_id", "spls_site_ky")
        moved = stored(index.changed_ids(live))
        others = stored(without_keys(index.candidates(moved), prepared.delta, KEY))
        delta_part = site_key(delta_part, sites)
        repairs = index.differing(others).select(*KEY, F.col("resolved").alias("spls_site_ky"), F.lit(False).alias(DELTA_FLAG))
        changes = delta_part.unionByName(repairs, allowMissingColumns=True)
    else:
        changes = delta_part
        if loopback:
            rest = prepared.rest.withColumn(DELTA_FLAG, F.lit(False))
            changes = delta_part.unionByName(rest, allowMissingColumns=True)
        changes = site_key(changes, sites)
    if index is not None:  # the merge reads them twice, the index again
        changes = stored(changes)
    merged = both_forms(
        target, changes, KEY, run_ts=window.run_ts, update_cols=UPDATE_COLS, insert_cols=INSERT_COLS,
        repair_cols=REPAIR_COLS if loopback else None, delta_flag=DELTA_FLAG, new_flag=NEW_FLAG,
        insert_buckets=insert_buckets, only_met=indexed,
    )
    side = {}
    if indexed:
        merged["changes"] = stored(merged["changes"])
        side = index.advanced(delta_part, others, merged["changes"], moved, stored)
    elif loopback and index is not None:
        side = index.built(changes, merged["table"], live_lookup(sites, "spls_site_id", "spls_site_ky"), stored)
    return JobResult(merged["table"], keys.high_water, keys.assigned, prepared.quarantined, prepared.profile,
                     {"keys": keys.keyed, "merge_source": changes.filter(F.col(DELTA_FLAG))}, SK, prepared.stored,
                     merged["changes"], side)
