"""Change capture: the delta of a run, its unseen keys, and the key spine."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DatetimeType, NumericType

from martloom.functions.expressions import UNASSIGNED, ts_literal


def incremental_delta(src: DataFrame, lo: datetime | str | None, ts_col: str = "row_updt_tms") -> DataFrame:
    """Rows changed since the window opened: ``ts_col >= lo`` (no upper bound);
    every row, those without a change time too, when there is no ``lo``.

    ``lo`` becomes a literal of the column's own type, so the predicate is
    pushed into the Parquet scan (row-group skipping, partition pruning).
    """
    if lo is None:
        return src
    return src.filter(F.col(ts_col) >= ts_literal(lo, src.schema[ts_col].dataType))


CELLS = 4096   # of equal width between the lowest and the highest key: rows sent to the driver, at most


def _measure(column: str, kind: DataType) -> Column | None:
    """The column as a number that keeps its order; None for a type without one."""
    if isinstance(kind, NumericType):
        return F.col(column).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, DatetimeType):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return None


def key_ranges(keys: DataFrame, column: str, pieces: int = 64) -> list[tuple]:
    """At most ``pieces`` ``(lowest, highest)`` pairs that cover the values of
    ``column``, apart at the widest gaps; one pair for a type without distances."""
    values = keys.filter(F.col(column).isNotNull())
    number = _measure(column, keys.schema[column].dataType)
    cell = F.lit(0)
    if number is not None:
        low, high = values.agg(F.min(number), F.max(number)).first()
        if low is not None and high > low:
            cell = F.floor((number - F.lit(low)) * (CELLS - 1) / F.lit(high - low))
    bounds = values.groupBy(cell.alias("cell")).agg(F.min(column).alias("low"), F.max(column).alias("high"))
    found = sorted((r["cell"], r["low"], r["high"]) for r in bounds.collect())
    gaps = sorted(range(1, len(found)), key=lambda i: found[i - 1][0] - found[i][0])[: pieces - 1]  # widest first
    cuts = [0, *sorted(gaps), len(found)]
    return [(found[a][1], found[b - 1][2]) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]


def within_ranges(df: DataFrame, column: str, ranges: Sequence[tuple]) -> DataFrame:
    """Rows of ``df`` whose ``column`` lies in one of ``ranges``: a predicate that
    reaches the Parquet scan, where row groups are skipped by their bounds and,
    for ranges of one value, by their bloom filters."""
    hit = F.lit(False)
    for low, high in ranges:
        hit = hit | (F.col(column) == F.lit(low) if low == high else F.col(column).between(F.lit(low), F.lit(high)))
    return df.filter(hit)


def new_keys(delta: DataFrame, target: DataFrame, on: Sequence[str], carry: Sequence[str] = (), skip_on: str | None = None) -> DataFrame:
    """Natural keys of ``delta`` that ``target`` does not hold (NOT EXISTS).

    A NULL key never matches, so it is kept, as NOT EXISTS keeps it.
    ``carry`` names delta columns to keep next to the key.

    The target's key columns are first reduced to those the delta holds: where
    Spark finds the delta's keys small enough to broadcast, the target is only
    probed and never shuffled; otherwise both joins share one shuffle of key
    columns. ``skip_on`` names a key column by whose ranges in the delta the
    target's scan is narrowed, for a target stored in its order
    (``SnapshotStore(sort_by=...)``).
    """
    on = list(on)
    probed = target if skip_on is None else within_ranges(target, skip_on, key_ranges(delta, skip_on))
    seen = probed.select(*on).join(delta.select(*on), on=on, how="left_semi")
    return delta.select(*on, *carry).join(seen, on=on, how="left_anti")


def key_spine(delta: DataFrame, target: DataFrame, on: Sequence[str], sk: str,
              status_col: str = "row_stat_cd") -> DataFrame:
    """Every known natural key with its surrogate key and status; the delta wins.

    Delta keys carry the target's key (``-1`` when unseen) and the *source*
    status; target keys outside the delta keep their key and *target* status.
    This is the row-number-over-union of a "prefer the delta" rule expressed
    as one full outer join on the natural key (one shuffle per side, key and
    status columns only).
    """
    on = list(on)
    d = delta.select(*on, F.col(status_col).alias("_d_status"), F.lit(True).alias("_d_hit"))
    t = target.select(*on, F.col(sk).alias("_t_sk"), F.col(status_col).alias("_t_status"))
    joined = d.join(t, on=on, how="full_outer")
    in_delta = F.col("_d_hit").isNotNull()
    return joined.select(
        *on,
        F.when(in_delta, F.coalesce(F.col("_t_sk"), F.lit(UNASSIGNED)))
        .otherwise(F.col("_t_sk"))
        .cast("bigint")
        .alias(sk),
        F.when(in_delta, F.col("_d_status")).otherwise(F.col("_t_status")).alias(status_col),
    )
