"""E-mail promotion fact: keys for unseen (e-mail, code), four calendar roles, upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from martloom.operators.guards import check_lookup_unique
from martloom.operators.lookup import resolve_date_keys
from martloom.plans.common import JobResult, NEW_FLAG, attach_new_keys, both_forms, mint_keys, prepare_delta
from martloom.sources.control import LoadWindow

# Fixed names of the e-mail promotion fact (they must match its columns): natural key,
# surrogate key, calendar roles and count renames; the merge lists follow.
KEY = ["eml_ky", "src_cd"]
SK = "eml_promo_ky"
DATE_ROLES = {
    "sent_dt": "sent_tm_ky",
    "allctn_strt_dt": "allctn_strt_tm_ky",
    "allctn_end_dt": "allctn_end_tm_ky",
    "last_ord_dt": "last_ord_tm_ky",
}
RENAMES = {"fsc_ytd_ordr_cnt": "fsc_ytd_ord_cnt", "pr_12_prds_ordr_cnt": "pr_12_prds_ord_cnt"}

# Fixed column lists of the reference merge (matched update / insert).
UPDATE_COLS = [
    "sent_tm_ky", "sent_dt", "allctn_strt_tm_ky", "allctn_strt_dt", "allctn_end_tm_ky", "allctn_end_dt",
    "sls_rep_nm", "last_ord_tm_ky", "last_ord_dt", "fsc_ytd_ord_cnt", "pr_12_prds_ord_cnt",
    "pr_3_prds_rvn_amt", "pr_12_prds_rvn_amt",
]
INSERT_COLS = [
    "eml_promo_ky", "src_cd", "eml_ky", "sent_tm_ky", "sent_dt", "allctn_strt_tm_ky", "allctn_strt_dt",
    "allctn_end_tm_ky", "allctn_end_dt", "sls_rep_nm", "last_ord_tm_ky", "last_ord_dt", "fsc_ytd_ord_cnt",
    "pr_12_prds_ord_cnt", "pr_3_prds_rvn_amt", "pr_12_prds_rvn_amt",
]


def enrich(delta: DataFrame, calendar: DataFrame) -> DataFrame:
    """Calendar keys for the four date roles and the count renames."""
    out = resolve_date_keys(delta, calendar, DATE_ROLES, key=KEY)
    for old, new in RENAMES.items():
        out = out.withColumnRenamed(old, new)
    return out


def run(source: DataFrame, target: DataFrame, calendar: DataFrame, window: LoadWindow, high_water: int, *,
        dedupe_by: Sequence[str] | None = None, on_null_key: str = "quarantine",
        freeze_delta: bool = True, insert_buckets: tuple[int, Sequence[str]] | None = None,
        check_lookups: bool = True, check_duplicates: bool = True, replayed: DataFrame | None = None,
        skip_on: str | None = None) -> JobResult:
    """The e-mail load. ``skip_on`` names a key column the target is stored in
    order of (``SnapshotStore(sort_by=...)``): the key probe and, in a store of
    change sets, the merge then skip the row groups the delta cannot meet."""
    if check_lookups:  # G4
        check_lookup_unique(calendar, "cld_dt", status_col=None)
    prepared = prepare_delta(source, window.lo, KEY, what="F_EML_PROMO", dedupe_by=dedupe_by,
                             check_duplicates=check_duplicates, on_null_key=on_null_key, freeze=freeze_delta,
                             replayed=replayed)
    keys = mint_keys(prepared, target, KEY, SK, high_water, skip_on=skip_on)
    merge_src = enrich(attach_new_keys(prepared.delta, keys, KEY, SK), calendar)
    merged = both_forms(
        target, merge_src, KEY, run_ts=window.run_ts, update_cols=UPDATE_COLS, insert_cols=INSERT_COLS,
        new_flag=NEW_FLAG, insert_buckets=insert_buckets, skip_on=skip_on,
    )
    return JobResult(merged["table"], keys.high_water, keys.assigned, prepared.quarantined, prepared.profile,
                     {"keys": keys.keyed, "merge_source": merge_src.drop(NEW_FLAG)}, SK, prepared.stored, merged["changes"])
