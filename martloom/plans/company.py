"""Company dimension: self-referencing hierarchy, keys minted from the spine, loopback."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.expressions import is_live, key_default
from martloom.operators.guards import check_lookup_unique
from martloom.operators.hierarchy_index import HierarchyIndex
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

# Fixed names of the company dimension (they must match the mart's columns):
# natural key, surrogate key, pointers, attributes, and the merge column lists.
KEY = ["spls_cmpy_id"]
SK = "spls_cmpy_ky"
# source reference column -> resolved key column (one hop each, no recursion)
POINTERS = {"parnt_cmpy_id": "parnt_cmpy_ky", "ultmt_parnt_cmpy_id": "ultmt_parnt_cmpy_ky"}
ATTRIBUTES = [
    "cmpy_nm", "website_url_txt", "sic_cd", "naics_cd", "naics_dscr", "emp_tot_cnt", "hrc_lvl_nmb",
    "hrc_src_typ_cd", "hrc_to_revw_ind", "mltpl_parnt_ind",
]
UPDATE_COLS = [*POINTERS.values(), *ATTRIBUTES]
INSERT_COLS = [SK, "spls_cmpy_id", *POINTERS.values(), *ATTRIBUTES]


def spine_with_keys(delta: DataFrame, target: DataFrame, keys) -> DataFrame:
    """The key spine with this run's keys filled in.

    Known ids are the target's, carrying the delta's status where the delta
    has them; unseen ids are the minted keys (a union, no further join). This
    is ``key_spine`` without its full outer join.
    """
    d = delta.select(*KEY, F.col("row_stat_cd").alias("_d_status"), F.lit(True).alias("_d_hit"))
    known = target.select(*KEY, SK, F.col("row_stat_cd").alias("_t_status")).join(d, on=KEY, how="left").select(
        *KEY, SK,
        F.when(F.col("_d_hit").isNotNull(), F.col("_d_status")).otherwise(F.col("_t_status")).alias("row_stat_cd"),
    )
    minted = keys.keyed.select(*KEY, SK, "row_stat_cd")
    return known.unionByName(minted)


def resolve_pointers(df: DataFrame, spine: DataFrame) -> DataFrame:
    """Parent and ultimate parent against live spine rows (keys minted in
    this run included, so a parent arriving with its child resolves at once).

    Both pointers are looked up in one join: they are stacked into (id, role,
    reference) without the NULL ones, joined to the spine, and pivoted back
    on the id, of which ``df`` has one row each. Top-level companies, whose
    pointers are NULL, never reach the join; a parent with very many children
    is a hot key only in this narrow join, where adaptive execution splits it.
    """
    live = spine.filter(is_live(F.col("row_stat_cd"))).select(F.col("spls_cmpy_id").alias("_ref"), F.col(SK).alias("_found"))
    roles = F.array(*[F.struct(F.lit(ref).alias("_role"), F.col(ref).alias("_ref")) for ref in POINTERS])
    refs = df.select(*KEY, F.inline(roles)).filter(F.col("_ref").isNotNull())
    found = refs.join(live, "_ref").groupBy(*KEY).agg(*[
        F.max(F.when(F.col("_role") == ref, F.col("_found"))).alias(f"_found_{ref}") for ref in POINTERS])
    out = df.join(found, KEY, "left")
    for ref, key_col in POINTERS.items():
        out = out.withColumn(key_col, key_default(F.col(ref), F.col(f"_found_{ref}"))).drop(f"_found_{ref}")
    return out


def pointer_index(store: SnapshotStore, buckets: int = 256) -> HierarchyIndex:
    """The kept index of the dimension's pointers, for ``run(..., index=...)``."""
    return HierarchyIndex(store, "pointers", KEY[0], SK, POINTERS, buckets)


def run(source: DataFrame, target: DataFrame, window: LoadWindow, high_water: int, *,
        loopback: bool = True, dedupe_by: Sequence[str] | None = None, on_null_key: str = "quarantine",
        freeze_delta: bool = True, insert_buckets: tuple[int, Sequence[str]] | None = None,
        check_lookups: bool = True, check_duplicates: bool = True, replayed: DataFrame | None = None,
        index: HierarchyIndex | None = None) -> JobResult:
    """The company load. With ``index`` (:func:`pointer_index` of the store) the
    loopback asks the kept pointers to companies whose live key changed instead
    of every source row. Its first run builds the index from the whole source."""
    indexed = loopback and index is not None and index.ready
    prepared = prepare_delta(source, window.lo, KEY, what="D_CMPY", dedupe_by=dedupe_by,
                             check_duplicates=check_duplicates, on_null_key=on_null_key, freeze=freeze_delta,
                             replayed=replayed, rest_cols=list(POINTERS) if loopback and not indexed else None)

    def stored(df: DataFrame) -> DataFrame:
        out, path = stored_table(df)
        prepared.stored.append(path)
        return out

    keys = mint_keys(prepared, target, KEY, SK, high_water, carry=["row_stat_cd"])
    spine = spine_with_keys(prepared.delta, target, keys)
    if not indexed:  # one spine for the whole run, read by the one pointer join
        spine = stored(spine)
    if check_lookups and not (check_duplicates or dedupe_by):
        # G4: a pointer must find one live company. The target's ids are unique (every run adds unseen ones only), so
        # the delta's are the ones to ask, where G1 has not
        check_lookup_unique(prepared.delta, "spls_cmpy_id")

    delta_part = attach_new_keys(prepared.delta, keys, KEY, SK).withColumn(DELTA_FLAG, F.lit(True))
    if indexed:
        seen = stored(index.seen(prepared.delta, spine))
        moved = stored(index.changed_ids(seen, target))
        others = stored(without_keys(index.candidates(moved), prepared.delta, KEY))
        delta_part = resolve_pointers(delta_part, spine)
        repairs = index.repairs(others).withColumn(DELTA_FLAG, F.lit(False))
        changes = delta_part.unionByName(repairs, allowMissingColumns=True)
    else:
        changes = delta_part
        if loopback:
            # every other source row, narrowed to key + pointers, for the repair pass
            rest = prepared.rest.withColumn(DELTA_FLAG, F.lit(False))
            changes = delta_part.unionByName(rest, allowMissingColumns=True)
        changes = resolve_pointers(changes, spine)
    merged = both_forms(
        target, changes, KEY, run_ts=window.run_ts, update_cols=UPDATE_COLS, insert_cols=INSERT_COLS,
        repair_cols=list(POINTERS.values()) if loopback else None, delta_flag=DELTA_FLAG, new_flag=NEW_FLAG,
        repair_only_nonzero=True, insert_buckets=insert_buckets,
    )
    side = {}
    if indexed:
        side = index.advanced(delta_part, others, seen)
    elif loopback and index is not None:
        side = index.built(changes, merged["table"], index.seen(prepared.delta, spine), stored)
    return JobResult(merged["table"], keys.high_water, keys.assigned, prepared.quarantined, prepared.profile,
                     {"spine": spine, "keys": keys.keyed, "merge_source": changes.filter(F.col(DELTA_FLAG))},
                     SK, prepared.stored, merged["changes"], side)
