"""Foreign-key and role-playing calendar lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

from martloom.functions.expressions import is_live, key_default
from martloom.session import broadcasts_refused


def live_lookup(dim: DataFrame, dim_id: str, dim_key: str, *, live: bool = True,
                status_col: str = "row_stat_cd") -> DataFrame:
    """``(id, key)`` pairs of a dimension, soft-deleted (and NULL-status) rows
    removed when ``live``; filtered before any join so the predicate reaches
    the scan."""
    if live:
        dim = dim.filter(is_live(F.col(status_col)))
    return dim.select(F.col(dim_id), F.col(dim_key))


def null_spread(df: DataFrame, ref_col: str):
    """A second join key that is 0, or for rows whose reference is NULL a hash
    of the row: those rows match nothing, and without it they would all meet
    in one shuffle partition."""
    plain = [F.col(f.name).cast("string") if isinstance(f.dataType, StringType) else F.col(f.name)
             for f in df.schema.fields if not isinstance(f.dataType, MapType)]  # a collated string has no hash
    return F.when(F.col(ref_col).isNull(), F.xxhash64(*plain)).otherwise(F.lit(0).cast("bigint"))


def left_lookup(df: DataFrame, pairs: DataFrame, ref_col: str, pair_id: str) -> DataFrame:
    """Left join on ``ref_col = pair_id`` that spreads NULL references.

    Spark chooses the join: a broadcast within the session's threshold, else a
    shuffle whose hot reference values adaptive execution splits.
    """
    spread, zero = f"_ml_spread_{ref_col}", f"_ml_zero_{ref_col}"
    left = df.withColumn(spread, null_spread(df, ref_col))
    right = pairs.withColumn(zero, F.lit(0).cast("bigint"))
    return left.join(right, (left[ref_col] == right[pair_id]) & (left[spread] == right[zero]), "left").drop(spread, zero)


def resolve_key(df: DataFrame, dim: DataFrame, ref_col: str, dim_id: str, dim_key: str, out_col: str, *,
                live: bool = True, status_col: str = "row_stat_cd", drop_ref: bool = False) -> DataFrame:
    """Add ``out_col``: 0 when ``ref_col`` is NULL, the live dimension key when
    one matches, else -1. One read of ``df``, whatever its references hold."""
    lk = live_lookup(dim, dim_id, dim_key, live=live, status_col=status_col)
    rid, rkey = f"_lk_{out_col}_id", f"_lk_{out_col}_key"
    lk = lk.select(F.col(dim_id).alias(rid), F.col(dim_key).alias(rkey))
    out = left_lookup(df, lk, ref_col, rid).withColumn(out_col, key_default(F.col(ref_col), F.col(rkey))).drop(rid, rkey)
    return out.drop(ref_col) if drop_ref else out


def resolve_date_keys(df: DataFrame, calendar: DataFrame, roles: Mapping[str, str], *, date_col: str = "cld_dt",
                      key_col: str = "tm_ky", key: Sequence[str] | None = None) -> DataFrame:
    """Calendar keys for ``{date column: output key column}``; a missing date or
    a date not in the calendar gives NULL (no 0/-1 default for calendar keys).

    One left join per role to the same calendar, which one broadcast serves.
    Where the session refuses broadcasts and ``key`` names columns that
    identify a row of ``df`` (none NULL), the roles are stacked instead: (key,
    role, date) without NULL dates meets the calendar in one narrow join and
    comes back by the key, so the full rows are shuffled once, by the
    key the merge joins on, and not once a role.
    """
    if key and broadcasts_refused(df.sparkSession):
        return _stacked_date_keys(df, calendar, roles, date_col, key_col, list(key))
    out = df
    for role_date, out_col in roles.items():
        day = f"_cal_dt_{out_col}"
        c = calendar.select(F.col(date_col).alias(day), F.col(key_col).alias(out_col))
        out = left_lookup(out, c, role_date, day).drop(day)
    return out


def _stacked_date_keys(df: DataFrame, calendar: DataFrame, roles: Mapping[str, str], date_col: str, key_col: str,
                       key: list[str]) -> DataFrame:
    stack = F.array(*[F.struct(F.lit(out).alias("_ml_role"), F.col(day).alias("_ml_day")) for day, out in roles.items()])
    days = df.select(*key, F.inline(stack)).filter(F.col("_ml_day").isNotNull())
    # a day that very many rows share is spread: the calendar has one row for each (day, salt)
    salts = 16
    salted = days.withColumn("_ml_salt", F.pmod(F.xxhash64(*[F.col(c) for c in key]), F.lit(salts)).cast("int"))
    known = calendar.select(F.col(date_col).alias("_ml_day"), F.col(key_col).alias("_ml_found"),
                            F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_ml_salt"))
    found = salted.join(known, ["_ml_day", "_ml_salt"]).groupBy(*key).agg(*[
        F.max(F.when(F.col("_ml_role") == out, F.col("_ml_found"))).alias(out) for out in roles.values()])
    return df.join(found, key, "left")
