"""Guards that ride on the write of a version, through ``DataFrame.observe``.

Spark computes the metrics while it writes, so neither the target nor the
written table is scanned again. Uniqueness of the new surrogate keys is checked
by a fingerprint: keys are minted densely, so count, bounds and the sum of
64-bit hashes of the keys written must be those of ``old + 1 .. old + n``.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.expressions import ts_literal
from martloom.operators.guards import GuardError


def _hashes(key: Column) -> Column:
    return F.sum(F.when(key.isNotNull(), F.xxhash64(key.cast("bigint")).cast("decimal(20,0)")))  # the hash of NULL is not NULL


@dataclass(frozen=True)
class KeyRange:
    """The keys of a run: ``assigned`` of them after the mark ``old``, up to ``new``."""

    column: str
    old: int
    new: int
    assigned: int
    run_ts: datetime | str
    insert_ts_col: str = "row_insrt_tms"

    def metrics(self, df: DataFrame) -> dict[str, Column]:
        key = F.col(self.column)
        new = F.coalesce(F.col(self.insert_ts_col) == ts_literal(self.run_ts, df.schema[self.insert_ts_col].dataType), F.lit(False))
        minted = F.when(new, key)
        return {
            "new_rows": F.count(F.when(new, 1)),
            "new_keys": F.count(minted),
            "lowest": F.min(minted),
            "highest": F.max(minted),
            "fingerprint": _hashes(minted),
            "not_positive": F.count(F.when(~F.coalesce(key >= 1, F.lit(False)), 1)),
            "old_above": F.count(F.when(~new & (key > F.lit(self.old)), 1)),
            "top": F.max(key),
        }

    def check(self, spark: SparkSession, seen: dict) -> None:
        """Raise unless what was written holds exactly the keys of the run and no old key above its mark."""
        name = self.column
        if seen["old_above"]:
            raise GuardError(f"{name}: {seen['old_above']} older rows hold keys above the counter {self.old}")
        if seen["not_positive"]:
            raise GuardError(f"{name}: {seen['not_positive']} keys are NULL or not positive")
        if seen["new_rows"] != self.assigned or seen["new_keys"] != self.assigned:
            raise GuardError(f"{name}: {seen['new_rows']} new rows with {seen['new_keys']} keys, {self.assigned} were handed out")
        if not self.assigned:
            return
        if self.new != self.old + self.assigned or (seen["lowest"], seen["highest"]) != (self.old + 1, self.new):
            raise GuardError(f"{name}: new keys {seen['lowest']} to {seen['highest']} are not {self.old + 1} to {self.new}")
        expected = spark.range(self.old + 1, self.new + 1).agg(_hashes(F.col("id"))).first()[0]
        if Decimal(seen["fingerprint"]) != expected:
            raise GuardError(f"{name}: the {self.assigned} new keys are not distinct")
