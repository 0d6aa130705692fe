"""Upsert with status/audit columns, and loopback repair of foreign keys.

Stock Spark tables have no MERGE, so a merge is written as joins: every
target row is joined once with its source row on the natural key, each
target column is chosen per row (source value for matched rows in the
update list, old value otherwise), and unseen source rows are appended.
The result is a complete new version of the target, written by
:mod:`martloom.sources.snapshot`.

``merge_upsert`` and ``loopback_repair`` are the two reference statements
(merge, then a matched-only merge over rows the first one did not touch);
``apply_changes`` does both in one pass over the target when the loopback
source contains the merge source, which saves one full join of the
target per run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.expressions import (
    NOT_APPLICABLE,
    differs,
    status_on_insert,
    status_on_update,
    ts_literal,
)
from martloom.operators.guards import GuardError, duplicate_keys

_HIT = "_ml_s_hit"


def _as_map(cols: Mapping[str, str] | Sequence[str] | None) -> dict[str, str]:
    if cols is None:
        return {}
    if isinstance(cols, Mapping):
        return dict(cols)
    return {c: c for c in cols}


def _s(col: str) -> str:
    return f"_ml_s_{col}"


def apply_changes(target: DataFrame, source: DataFrame, on: Sequence[str], *, run_ts: datetime | str,
                  update_cols: Mapping[str, str] | Sequence[str] = (),
                  insert_cols: Mapping[str, str] | Sequence[str] | None = None,
                  repair_cols: Mapping[str, str] | Sequence[str] | None = None,
                  delta_flag: str | bool = True, new_flag: str | None = None,
                  repair_only_nonzero: bool = False, null_safe: bool = False,
                  status_col: str = "row_stat_cd", source_status_col: str = "row_stat_cd",
                  insert_ts_col: str = "row_insrt_tms", update_ts_col: str = "row_updt_tms",
                  insert_buckets: tuple[int, Sequence[str]] | None = None, changed_only: bool = False) -> DataFrame:
    """Merge ``source`` into ``target`` and repair foreign keys, in one join.

    * ``update_cols`` ``{target col: source col}``: written on matched rows of
      the delta, with ``status_col`` from the source status ('DEL' stays,
      else 'UPDT') and ``update_ts_col = run_ts``.
    * ``insert_cols``: written for delta rows whose key the target lacks,
      with status 'DEL'/'NEW' and both timestamps ``run_ts``; other target
      columns are NULL. ``None`` disables inserts.
    * ``repair_cols``: loopback. On matched rows *outside* the delta that were
      last stamped before ``run_ts`` (and, with ``repair_only_nonzero``, have
      some repair column <> 0), when any repair column differs (``<>``: a
      NULL never differs unless ``null_safe``), all repair columns take the
      source value and ``update_ts_col = run_ts``; status is left alone.
    * ``delta_flag``: name of a boolean source column marking this run's
      delta, or a constant (True: every source row is delta).
    * ``new_flag``: boolean source column marking rows whose key is known to
      be unseen (from key assignment); then inserts need no extra join.
    * ``insert_buckets=(n, key)``: hash-partition the inserted rows into the
      target's bucket layout, so writing a bucketed snapshot produces one
      file per bucket for them instead of one per (task, bucket).
    * ``changed_only``: only the rows this run updates, repairs or inserts
      (an inner join), for a store that publishes change sets.

    Physical plan: one left join of the target with the source (full outer
    when inserts must be found by the join itself). Spark broadcasts the source
    when it is within the session's threshold (a stored delta has a known
    size), and the target is streamed; otherwise a shuffle join.
    """
    on = list(on)
    upd = _as_map(update_cols)
    ins = _as_map(insert_cols) if insert_cols is not None else None
    rep = _as_map(repair_cols)
    tfields = {f.name: f.dataType for f in target.schema.fields}
    ts_type = tfields.get(update_ts_col)
    now = ts_literal(run_ts, ts_type)

    can_merge = delta_flag is not False
    needed_set = set(upd.values()) | set(rep.values())
    if can_merge:
        needed_set.add(source_status_col)
    if ins is not None and new_flag is None:
        needed_set |= set(ins.values())
    needed = sorted(needed_set - set(on))
    flag_cols = [delta_flag] if isinstance(delta_flag, str) else []
    matchable = source
    if new_flag is not None:
        matchable = matchable.filter(~F.coalesce(F.col(new_flag), F.lit(False)))
    s = matchable.select(
        *on,
        *[F.col(c).alias(_s(c)) for c in needed + [f for f in flag_cols if f not in needed]],
        F.lit(True).alias(_HIT),
    )
    if isinstance(delta_flag, str):
        src_in_delta = F.coalesce(F.col(delta_flag), F.lit(False))
        joined_in_delta = F.coalesce(F.col(_s(delta_flag)), F.lit(False))
    else:
        src_in_delta = F.lit(bool(delta_flag))
        joined_in_delta = F.lit(bool(delta_flag))

    use_full_outer = ins is not None and new_flag is None
    if use_full_outer:
        joined = target.withColumn("_ml_t_hit", F.lit(True)).join(s, on=on, how="full_outer")
        matched_part = joined
    else:
        matched_part = target.join(s, on=on, how="inner" if changed_only else "left")

    hit = F.col(_HIT).isNotNull()
    merged = hit & joined_in_delta
    repairable = F.lit(False)
    if rep:
        repairable = hit & ~joined_in_delta
        if update_ts_col in tfields:
            repairable = repairable & (F.col(update_ts_col) < now)
        if repair_only_nonzero:
            nz = F.lit(False)
            for tc in rep:
                nz = nz | (F.col(tc) != F.lit(NOT_APPLICABLE))
            repairable = repairable & nz
        changed = F.lit(False)
        for tc, sc in rep.items():
            changed = changed | differs(F.col(_s(sc)), F.col(tc), null_safe)
        repairable = repairable & changed

    is_insert = F.col("_ml_t_hit").isNull() if use_full_outer else F.lit(False)
    s_types = {f.name: f.dataType for f in source.schema.fields}
    out_cols: list[Column | str] = []
    for name, dtype in tfields.items():
        touched = (name == status_col and can_merge) or name == update_ts_col or name in rep or name in upd
        if name in on or not (touched or use_full_outer):
            out_cols.append(name)  # passed through unchanged: no expression to build
            continue
        sources = [upd.get(name), rep.get(name)] + ([ins.get(name)] if use_full_outer and ins else [])
        needs_cast = any(c is not None and s_types.get(c) != dtype for c in sources)
        if name == status_col and can_merge:
            expr = F.when(merged, status_on_update(F.col(_s(source_status_col)))).otherwise(F.col(name))
        elif name == update_ts_col:
            expr = F.when(merged | repairable, now).otherwise(F.col(name))
        else:
            expr = F.col(name)
            if name in rep:
                expr = F.when(repairable, F.col(_s(rep[name]))).otherwise(expr)
            if name in upd:
                expr = F.when(merged, F.col(_s(upd[name]))).otherwise(expr)
        if use_full_outer:
            expr = F.when(is_insert, _insert_expr(name, on, ins, status_col, insert_ts_col, update_ts_col, now,
                                                  source_status_col, prefixed=True)).otherwise(expr)
            needs_cast = True  # insert branch may be an untyped NULL
        out_cols.append((expr.cast(dtype) if needs_cast else expr).alias(name))

    if use_full_outer:
        # one pass: matched/unmatched target rows and unseen delta rows together
        known = F.col("_ml_t_hit").isNotNull()
        kept = known & (merged | repairable) if changed_only else known
        return joined.filter(kept | (~known & joined_in_delta)).select(*out_cols)

    result = (matched_part.filter(merged | repairable) if changed_only else matched_part).select(*out_cols)
    if ins is None:
        return result

    fresh = source.filter(F.coalesce(F.col(new_flag), F.lit(False)) & src_in_delta)
    inserted = fresh.select(*[
        _insert_expr(name, on, ins, status_col, insert_ts_col, update_ts_col, now, source_status_col)
        .cast(dtype).alias(name)
        for name, dtype in tfields.items()
    ])
    if insert_buckets is not None:
        inserted = inserted.repartition(int(insert_buckets[0]), *insert_buckets[1])
    return result.unionByName(inserted)


def _insert_expr(name, on, ins, status_col, insert_ts_col, update_ts_col, now, source_status_col,
                 prefixed: bool = False) -> Column:
    def src(c: str) -> Column:
        return F.col(_s(c)) if prefixed and c not in on else F.col(c)

    if name in on:
        expr = F.col(name)
    elif name == status_col:
        expr = status_on_insert(src(source_status_col))
    elif name in (insert_ts_col, update_ts_col):
        expr = now
    elif name in ins:
        expr = src(ins[name])
    else:
        expr = F.lit(None)
    return expr


def require_unique_source(source: DataFrame, on: Sequence[str]) -> None:
    """A MERGE whose source holds a key twice must fail, not fan out."""
    dup = duplicate_keys(source.dropna(subset=list(on)), on).limit(1).collect()
    if dup:
        raise GuardError(f"merge source holds a key more than once, e.g. {tuple(dup[0])[:-1]}")


def merge_upsert(target: DataFrame, source: DataFrame, on: Sequence[str], *,
                 update_cols: Mapping[str, str] | Sequence[str],
                 insert_cols: Mapping[str, str] | Sequence[str], run_ts: datetime | str,
                 new_flag: str | None = None, status_col: str = "row_stat_cd",
                 source_status_col: str = "row_stat_cd", insert_ts_col: str = "row_insrt_tms",
                 update_ts_col: str = "row_updt_tms", check_duplicates: bool = True) -> DataFrame:
    """MERGE: update matched rows (listed columns only, status, update time),
    insert unmatched source rows (status NEW/DEL, both times ``run_ts``).

    A key that ``source`` holds twice is an error; ``check_duplicates=False``
    is for a caller that has proven its keys unique (one aggregation less).
    """
    if check_duplicates:
        require_unique_source(source, on)
    return apply_changes(
        target, source, on, run_ts=run_ts, update_cols=update_cols, insert_cols=insert_cols,
        delta_flag=True, new_flag=new_flag, status_col=status_col, source_status_col=source_status_col,
        insert_ts_col=insert_ts_col, update_ts_col=update_ts_col,
    )


def loopback_repair(target: DataFrame, resolved: DataFrame, on: Sequence[str], fk_cols: Sequence[str], *,
                    run_ts: datetime | str, only_nonzero: bool = False, null_safe: bool = False,
                    update_ts_col: str = "row_updt_tms") -> DataFrame:
    """Matched-only merge: target rows last stamped before ``run_ts`` whose
    re-resolved foreign keys differ take the new keys and ``run_ts``; status
    stays. Target rows with no row in ``resolved`` are never touched."""
    return apply_changes(
        target, resolved, on, run_ts=run_ts, update_cols={}, insert_cols=None,
        repair_cols=list(fk_cols), delta_flag=False, repair_only_nonzero=only_nonzero,
        null_safe=null_safe, update_ts_col=update_ts_col,
    )
