"""Dense surrogate keys after a stored high-water mark."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from martloom.session import remove_path, stored_table

_POS = "_ml_pos"          # monotonically_increasing_id frozen into the stored table
_PART = "_ml_part"
_OFFSET = "_ml_offset"
_ROW_BITS = 33            # monotonically_increasing_id: partition index << 33 | row in partition
_ROW_MASK = (1 << _ROW_BITS) - 1


@dataclass(frozen=True)
class KeyAssignment:
    """Result of :func:`assign_surrogate_keys`."""

    keyed: DataFrame        # input columns + the surrogate key column
    assigned: int           # how many keys were handed out
    high_water: int         # counter after this assignment
    path: str = ""          # the stored numbering, removed by release()

    @property
    def first_key(self) -> int | None:
        return self.high_water - self.assigned + 1 if self.assigned else None

    def release(self) -> None:
        if self.path:
            remove_path(self.keyed.sparkSession, self.path)


def advance_high_water(old: int, new_max: int | None) -> int:
    """``greatest(old, coalesce(max(new keys), old))``: never NULL, never backwards."""
    if old is None:
        raise ValueError("the key registry has no value for this counter")
    return old if new_max is None else max(int(old), int(new_max))


def assign_surrogate_keys(df: DataFrame, order_by: Sequence[str], sk: str, high_water: int, *,
                          num_partitions: int | None = None) -> KeyAssignment:
    """Number every row of ``df`` densely from ``high_water + 1`` in ``order_by`` order.

    The rows never meet in one partition, whatever their number:

    1. range-partition by the order key and sort within partitions;
    2. tag each row with its (partition, position) and store the result beside
       the session's checkpoints, which fixes partition contents so later
       stages (and retries after a lost executor) see the same numbering;
    3. count rows per partition: one row per partition goes to the driver,
       which turns the counts into start offsets;
    4. key = high_water + offset(partition) + position + 1, joined against a
       broadcast of the offsets (one row per partition: a bound by construction).
    """
    sort_cols = [F.col(c).asc_nulls_first() for c in order_by]
    if num_partitions:
        ranged = df.repartitionByRange(num_partitions, *sort_cols)
    else:
        # no fixed count: adaptive execution may merge adjacent ranges of a
        # small key set (order across partitions is kept), a large one gets
        # the session's shuffle-partition count
        ranged = df.repartitionByRange(*sort_cols)
    tagged = ranged.sortWithinPartitions(*sort_cols).withColumn(_POS, F.monotonically_increasing_id())
    frozen, path = stored_table(tagged)

    part = F.shiftright(F.col(_POS), _ROW_BITS)
    counts = sorted(
        (r[0], r[1]) for r in frozen.groupBy(part.alias(_PART)).agg(F.count(F.lit(1))).collect()
    )
    offsets, total = [], 0
    for pid, cnt in counts:
        offsets.append((int(pid), total))
        total += int(cnt)
    schema = StructType([StructField(_PART, LongType(), False), StructField(_OFFSET, LongType(), False)])
    offsets_df = df.sparkSession.createDataFrame(offsets, schema)
    keyed = (
        frozen.withColumn(_PART, part)
        .join(F.broadcast(offsets_df), on=_PART, how="inner")
        .withColumn(
            sk,
            (F.lit(high_water) + F.col(_OFFSET) + F.col(_POS).bitwiseAND(F.lit(_ROW_MASK)) + 1).cast("bigint"),
        )
        .drop(_POS, _PART, _OFFSET)
    )
    return KeyAssignment(keyed, total, advance_high_water(high_water, high_water + total if total else None), path)
