"""Pieces shared by the four loads."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.expressions import CASE_BLIND_KEYS, PLAIN_KEYS, collate_keys, ts_literal
from martloom.operators.guards import (
    DeltaProfile,
    GuardError,
    dedupe_newest,
    delta_profile,
    require_unique_delta,
    split_null_keys,
)
from martloom.operators.keys import KeyAssignment, assign_surrogate_keys
from martloom.operators.delta import incremental_delta, key_ranges, new_keys, within_ranges
from martloom.operators.merge import apply_changes
from martloom.session import remove_path, stored_table

NEW_FLAG = "_ml_new"
DELTA_FLAG = "_ml_in_delta"


@dataclass
class JobResult:
    """What a load produces; nothing is written until it is published."""

    table: DataFrame              # the complete new version of the target
    high_water: int               # key counter after the run
    assigned: int                 # new surrogate keys handed out
    quarantined: DataFrame        # delta rows with a NULL natural key
    profile: DeltaProfile
    extras: dict[str, DataFrame] = field(default_factory=dict)
    surrogate_key: str | None = None
    stored: list[str] = field(default_factory=list)  # paths of the run's temporary tables
    changes: DataFrame | None = None                 # the rows of ``table`` this run changed or inserted
    side: dict = field(default_factory=dict)         # name -> SideChange of a table kept beside the target

    def release(self) -> None:
        """Remove the run's temporary tables (call after the table is written)."""
        for path in self.stored:
            remove_path(self.table.sparkSession, path)
        self.stored.clear()


def max_key(target: DataFrame, sk: str) -> int:
    """Largest surrogate key in a table (0 when empty): the high-water mark of
    a target that has no registry row of its own."""
    v = target.agg(F.max(F.col(sk))).collect()[0][0]
    return int(v) if v is not None else 0


def in_window(df: DataFrame, lo, ts_col: str = "row_updt_tms"):
    if lo is None:
        return F.lit(True)
    return F.coalesce(F.col(ts_col) >= ts_literal(lo, df.schema[ts_col].dataType), F.lit(False))


@dataclass
class PreparedDelta:
    delta: DataFrame
    quarantined: DataFrame
    profile: DeltaProfile
    rest: DataFrame | None = None   # the source's other rows: key and the columns asked for
    stored: list[str] = field(default_factory=list)


def prepare_delta(source: DataFrame, lo, key: Sequence[str], *, what: str, dedupe_by: Sequence[str] | None = None,
                  on_null_key: str = "quarantine", freeze: bool = True, rest_cols: Sequence[str] | None = None,
                  check_duplicates: bool = True, replayed: DataFrame | None = None) -> PreparedDelta:
    """The run's one read of its source: window filter, NULL-key quarantine,
    duplicate guard and the delta size.

    With ``rest_cols`` (for a loopback) rows outside the window, NULL change
    times included, come along narrowed to the key and those columns; the
    other columns of such rows are NULL in what is stored. ``freeze`` stores
    what was read beside the session's checkpoints, so a source that changes
    while the run is in flight changes nothing, and joins know its size.

    ``replayed`` rows (quarantined by an earlier run, repaired since; a stored
    table) belong to the delta whatever their change time; columns they lack
    are NULL. Where the source brings a row of the same key in the window, that
    row is taken instead; a row of that key outside the window gives way.
    """
    stored: list[str] = []
    if rest_cols is None:
        raw, rest = incremental_delta(source, lo), None
        if freeze:
            raw, path = stored_table(raw)
            stored.append(path)
    else:
        inside = in_window(source, lo)
        always = {*key, *rest_cols}
        read = source.select(*[F.col(c) if c in always else F.when(inside, F.col(c)).alias(c) for c in source.columns],
                             inside.alias(DELTA_FLAG))
        if freeze:
            read, path = stored_table(read)
            stored.append(path)
        raw = read.filter(F.col(DELTA_FLAG)).drop(DELTA_FLAG)
        rest = split_null_keys(read.filter(~F.col(DELTA_FLAG)).select(*dict.fromkeys([*key, *rest_cols])), key)[0]
    if replayed is not None:
        late = replayed.select(*[F.col(f.name).cast(f.dataType) if f.name in replayed.columns else F.lit(None).cast(f.dataType).alias(f.name)
                                 for f in raw.schema.fields]).join(raw.select(*key), list(key), "left_anti")
        raw = raw.unionByName(late)
        if rest is not None:
            rest = rest.join(late.select(*key), list(key), "left_anti")
    delta, quarantined = split_null_keys(raw, key)
    if dedupe_by:
        delta = dedupe_newest(delta, key, dedupe_by)
        raw = delta.unionByName(quarantined)
    profile = delta_profile(raw, key, check_duplicates=check_duplicates and not dedupe_by)
    if profile.null_keys and on_null_key == "fail":
        raise GuardError(f"{what}: {profile.null_keys} delta rows have a NULL natural key")
    require_unique_delta(profile, what)
    return PreparedDelta(delta, quarantined, profile, rest, stored)


def mint_keys(prepared: PreparedDelta, target: DataFrame, key: Sequence[str], sk: str, high_water: int,
              carry: Sequence[str] = (), skip_on: str | None = None) -> KeyAssignment:
    """Dense keys for the delta's unseen natural keys, in natural-key order."""
    keys = assign_surrogate_keys(new_keys(prepared.delta, target, key, carry=carry, skip_on=skip_on), key, sk, high_water)
    prepared.stored.append(keys.path)
    return keys


def attach_new_keys(df: DataFrame, keys: KeyAssignment, key: Sequence[str], sk: str) -> DataFrame:
    """Left join the minted keys (flagged new) onto ``df``."""
    keyed = keys.keyed.select(*key, F.col(sk), F.lit(True).alias(NEW_FLAG))
    return df.join(keyed, on=list(key), how="left")


def both_forms(target: DataFrame, changes: DataFrame, key: Sequence[str], skip_on: str | None = None,
               only_met: bool = False, **options) -> dict[str, DataFrame]:
    """``table`` (the whole new version) and ``changes`` (its changed and inserted
    rows) of one merge; a store evaluates the one it writes. With ``skip_on``
    the second reads the target only where that key column meets ``changes``;
    with ``only_met`` (``changes`` are a part of the source) every layer of the
    target is cut to their keys where it is read, before the layers meet."""
    met = target if skip_on is None else within_ranges(target, skip_on, key_ranges(changes, skip_on))
    if only_met:
        met = met.join(changes.select(*key), list(key), "left_semi")
    return {"table": apply_changes(target, changes, key, **options),
            "changes": apply_changes(met, changes, key, **options, changed_only=True)}


def case_blind(load: Callable[..., JobResult], columns: Sequence[str], collation: str = CASE_BLIND_KEYS) -> Callable[..., JobResult]:
    """``load`` with the text columns named compared case-blind, trailing blanks
    ignored (the reference's session mode), in every DataFrame it is given.

    Joins, new-key probes, duplicate guards and key order follow the rule. A
    matched target row keeps its own spelling, an inserted one has the source's;
    what is published carries plain strings.
    """
    @wraps(load)
    def run(*args, **options) -> JobResult:
        def ruled(value):
            return collate_keys(value, columns, collation) if isinstance(value, DataFrame) else value

        result = load(*map(ruled, args), **{k: ruled(v) for k, v in options.items()})
        result.table = collate_keys(result.table, columns, PLAIN_KEYS)
        if result.changes is not None:
            result.changes = collate_keys(result.changes, columns, PLAIN_KEYS)
        result.quarantined = collate_keys(result.quarantined, columns, PLAIN_KEYS)
        return result

    return run
