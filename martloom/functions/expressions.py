"""Column expressions shared by the operators.

Everything here returns a built-in Spark ``Column`` so it stays inside
whole-stage codegen; nothing calls back into Python per row.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

# Fixed values of the loading contract (they must not change):
#   foreign key when the source reference is NULL ........ 0
#   foreign key when no live dimension row matches ....... -1
#   surrogate key not assigned yet ....................... -1
#   row status: soft-deleted 'DEL', inserted 'NEW', updated 'UPDT'
NOT_APPLICABLE = 0
UNKNOWN = -1
UNASSIGNED = -1
DELETED = "DEL"
INSERTED = "NEW"
UPDATED = "UPDT"


def key_default(ref: Column, found_key: Column) -> Column:
    """0 when the reference is NULL, the found key, else -1 (orphan)."""
    return (
        F.when(ref.isNull(), F.lit(NOT_APPLICABLE))
        .otherwise(F.coalesce(found_key, F.lit(UNKNOWN)))
        .cast("bigint")
    )


def status_on_update(src_status: Column) -> Column:
    """A soft delete stays 'DEL'; anything else (NULL included) becomes 'UPDT'."""
    return F.when(src_status == F.lit(DELETED), F.lit(DELETED)).otherwise(F.lit(UPDATED))


def status_on_insert(src_status: Column) -> Column:
    """A soft delete stays 'DEL'; anything else (NULL included) becomes 'NEW'."""
    return F.when(src_status == F.lit(DELETED), F.lit(DELETED)).otherwise(F.lit(INSERTED))


def is_live(status: Column) -> Column:
    """SQL three-valued ``status <> 'DEL'``: a NULL status is *not* live."""
    return status != F.lit(DELETED)


def differs(a: Column, b: Column, null_safe: bool = False) -> Column:
    """``a <> b``; by default a NULL on either side never counts as a change."""
    return ~a.eqNullSafe(b) if null_safe else (a != b)


def _as_text(value: datetime | date | str) -> str:
    if isinstance(value, str):
        return value
    if isinstance(value, datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return value.strftime("%Y-%m-%d")


def ts_literal(value: datetime | date | str, like: DataType | None = None) -> Column:
    """A timestamp literal of the same type as the column it is compared with.

    Built from text so that no Python or JVM time zone touches a
    ``timestamp_ntz`` value (a zoned ``timestamp`` gets the text as UTC);
    Catalyst folds the cast, so the literal reaches the Parquet scan as a
    pushed filter.
    """
    text = _as_text(value)
    if like is None or isinstance(like, TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    if isinstance(like, TimestampType):
        # window bounds and run times are UTC ("GMT" in the reference): say so,
        # so the session time zone cannot shift a zoned timestamp
        return F.lit(text + ("" if isinstance(value, date) and not isinstance(value, datetime) else "Z")).cast(
            "timestamp")
    return F.lit(text).cast(like.simpleString())


# Case-blind comparison that ignores trailing blanks (the reference's session
# mode); Spark compares strings byte for byte unless told otherwise.
CASE_BLIND_KEYS = "UTF8_LCASE_RTRIM"
PLAIN_KEYS = "UTF8_BINARY"


def collate_keys(df, cols, collation: str = CASE_BLIND_KEYS):
    """``df`` with its string key columns carrying ``collation``: joins,
    anti joins, grouping and key ordering on them then follow that rule.
    Apply to both sides of every join (source, target, dimensions)."""
    from pyspark.sql.types import StringType

    wanted = set(cols)
    return df.select(*[
        F.collate(F.col(f.name), collation).alias(f.name)
        if f.name in wanted and isinstance(f.dataType, StringType) else F.col(f.name)
        for f in df.schema.fields
    ])
