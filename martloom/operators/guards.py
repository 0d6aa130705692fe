"""Guards that keep a merge well defined (unique keys, no NULL keys, ...).

Each guard is one aggregation; the ones a job runs are folded into as few
actions as possible (``delta_profile`` answers the duplicate check, the
NULL-key count and the delta size in a single pass).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.expressions import is_live, ts_literal


class GuardError(RuntimeError):
    """A load precondition does not hold; nothing has been written."""


def _any_null(on: Sequence[str]):
    cond = F.lit(False)
    for c in on:
        cond = cond | F.col(c).isNull()
    return cond


def split_null_keys(df: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a complete natural key, quarantined rows with a NULL in it)."""
    bad = _any_null(on)
    return df.filter(~bad), df.filter(bad)


def duplicate_keys(df: DataFrame, on: Sequence[str], count_col: str = "row_cnt") -> DataFrame:
    """Natural keys that occur more than once, with their row count."""
    return (
        df.groupBy(*on)
        .agg(F.count(F.lit(1)).cast("bigint").alias(count_col))
        .filter(F.col(count_col) > 1)
    )


def dedupe_newest(df: DataFrame, on: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Keep one row per natural key: the greatest ``by`` values win.

    Written as a max over a struct, which aggregates map-side before the
    shuffle (unlike a row_number window, which shuffles every row and sorts
    each key group in one task).
    """
    others = [c for c in df.columns if c not in on]
    packed = F.struct(*[F.col(c) for c in by], *[F.col(c).alias(f"_v_{c}") for c in others])
    best = df.groupBy(*on).agg(F.max(packed).alias("_best"))
    return best.select(*on, *[F.col(f"_best._v_{c}").alias(c) for c in others]).select(*df.columns)


@dataclass(frozen=True)
class DeltaProfile:
    rows: int            # delta rows
    null_keys: int       # rows with a NULL in the natural key (quarantined)
    duplicate_keys: int  # distinct non-NULL keys seen more than once
    max_copies: int


def delta_profile(delta: DataFrame, on: Sequence[str], check_duplicates: bool = True) -> DeltaProfile:
    """One aggregation answering G1 (unique keys), G2 (NULL keys) and the delta
    size. ``check_duplicates=False`` (for a source that guarantees unique
    keys) skips the group-by on the key: a plain count without a shuffle of
    rows."""
    if check_duplicates:
        per_key = delta.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    else:
        per_key = delta.select(*on, F.lit(1).alias("_n"))
    row = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(_any_null(on), F.col("_n"))), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum(F.when(~_any_null(on) & (F.col("_n") > 1), 1)), F.lit(0)).alias("dups"),
        F.coalesce(F.max(F.when(~_any_null(on), F.col("_n"))), F.lit(0)).alias("max_copies"),
    ).first()
    return DeltaProfile(*(int(v) for v in row))


def require_unique_delta(profile: DeltaProfile, what: str) -> None:
    if profile.duplicate_keys:
        raise GuardError(
            f"{what}: {profile.duplicate_keys} natural keys occur more than once in the delta "
            f"(up to {profile.max_copies} copies); pass dedupe_by=[...] to keep the newest"
        )


def surrogate_key_report(df: DataFrame, sk: str, old_high_water: int, new_high_water: int, *,
                         run_ts: datetime | str, insert_ts_col: str = "row_insrt_tms") -> DataFrame:
    """G3 as one row: rows of ``df``, rows inserted at ``run_ts``, distinct
    inserted keys, inserted keys at or below the old high-water mark, and keys
    that are not positive or above the new mark. The inserted rows are few, so
    the distinct count shuffles little."""
    new = F.col(insert_ts_col) == ts_literal(run_ts, df.schema[insert_ts_col].dataType)
    key = F.col(sk)
    return df.agg(
        F.count(F.lit(1)).alias("row_cnt"),
        F.coalesce(F.sum(new.cast("bigint")), F.lit(0)).alias("new_cnt"),
        F.count_distinct(F.when(new, key)).alias("new_key_cnt"),
        F.coalesce(F.sum((new & ~(key > F.lit(old_high_water))).cast("bigint")), F.lit(0)).alias("reused_cnt"),
        F.coalesce(F.sum((~key.between(1, max(new_high_water, old_high_water))).cast("bigint")), F.lit(0)).alias("outside_cnt"),
    )


def check_surrogate_keys(df: DataFrame, sk: str, old_high_water: int, new_high_water: int, *,
                         run_ts: datetime | str | None = None, insert_ts_col: str = "row_insrt_tms") -> None:
    """G3: keys positive and within the new mark, new keys unique and above
    the old mark. With ``run_ts`` the new keys are those of rows inserted
    then; without it all of ``df`` is new."""
    if run_ts is None:
        df, run_ts = df.withColumn(insert_ts_col, F.lit("1970-01-02").cast("timestamp_ntz")), "1970-01-02 00:00:00"
    row = surrogate_key_report(df, sk, old_high_water, new_high_water, run_ts=run_ts, insert_ts_col=insert_ts_col).first()
    if row["new_cnt"] != row["new_key_cnt"]:
        raise GuardError(f"{sk}: {row['new_cnt'] - row['new_key_cnt']} duplicate or NULL surrogate keys")
    if row["reused_cnt"]:
        raise GuardError(f"{sk}: {row['reused_cnt']} new keys at or below the high-water mark {old_high_water}")
    if row["outside_cnt"]:
        raise GuardError(f"{sk}: {row['outside_cnt']} keys not positive or above the high-water mark {new_high_water}")


def check_counter(target: DataFrame, sk: str, high_water: int) -> None:
    """The stored counter must not be behind the table's own keys."""
    top = target.agg(F.max(F.col(sk))).first()[0]
    if top is not None and top > high_water:
        raise GuardError(f"{sk}: the table holds key {top}, above the counter {high_water}")


def check_lookup_unique(dim: DataFrame, dim_id: str, status_col: str | None = "row_stat_cd") -> None:
    """G4: a lookup must not fan out: one live row per dimension id."""
    live = dim.filter(is_live(F.col(status_col))) if status_col else dim
    dup = duplicate_keys(live.filter(F.col(dim_id).isNotNull()), [dim_id]).limit(1).collect()
    if dup:
        raise GuardError(f"lookup on {dim_id} is not unique among live rows, e.g. {dup[0][dim_id]!r}")


def orphan_report(df: DataFrame, fk_cols: Sequence[str]) -> DataFrame:
    """Share of NOT_APPLICABLE (0) and UNKNOWN (-1) keys per foreign key column,
    one aggregation pass for all columns."""
    aggs = []
    for c in fk_cols:
        aggs += [
            F.count(F.col(c)).alias(f"{c}__rows"),
            F.sum(F.when(F.col(c) == -1, 1).otherwise(0)).alias(f"{c}__unknown"),
            F.sum(F.when(F.col(c) == 0, 1).otherwise(0)).alias(f"{c}__not_applicable"),
        ]
    wide = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("fk_col"),
            F.col(f"{c}__rows").cast("bigint").alias("row_cnt"),
            F.col(f"{c}__unknown").cast("bigint").alias("unknown_cnt"),
            F.col(f"{c}__not_applicable").cast("bigint").alias("not_applicable_cnt"),
        )
        for c in fk_cols
    ]
    return wide.select(F.inline(F.array(*rows)))
