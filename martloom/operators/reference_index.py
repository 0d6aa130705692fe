"""A kept index of references, so a loopback reads what can have changed.

The full recheck resolves every source row again and joins the result with the
target. The index keeps, beside the target and versioned with it,

    <name>_entries   natural key -> reference, the key it resolved to, the key the target row holds,
                     in folders by a hash bucket of the reference
    <name>_pending   the entries whose two keys differ (the merge does not write
                     the key of a matched row, so its next run's loopback must)
    <name>_dim       dimension id -> live key, as of the last run

so a run compares the dimension with what it was, reads the entries of the
changed ids (their buckets only) and the pending ones, and repairs the target
rows whose key differs. It equals the full recheck as long as a source row whose
reference changes also carries a change time in the window, and rows are never
removed from the source without a trace (both hold for the loads: deletes are
soft).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.expressions import key_default
from martloom.sources.layers import GONE
from martloom.sources.snapshot import SideChange, SnapshotStore

BUCKET = "_ml_b"


@dataclass
class ReferenceIndex:
    """The index ``name`` of a store's table for one reference.

    ``ref``/``key_col`` are the reference column of the source and the key
    column of the target; the dimension's live rows come as ``(ref, key_col)``.
    """

    store: SnapshotStore
    name: str
    key: Sequence[str]
    ref: str
    key_col: str
    buckets: int = 256
    _live: DataFrame | None = field(default=None, repr=False)

    @property
    def ready(self) -> bool:
        """False until a first run has built the index from the whole source."""
        state = self.store.state()
        return state is not None and f"{self.name}_entries" in state.side

    def _bucket(self, ref: Column) -> Column:
        return F.pmod(F.xxhash64(ref), F.lit(self.buckets)).cast("int")

    def changed_ids(self, live: DataFrame) -> DataFrame:
        """``(ref, _now)``: ids whose live key is not what it was, with their key now (NULL: none)."""
        was = self.store.side(f"{self.name}_dim").withColumnRenamed(self.key_col, "_was")
        now = live.filter(F.col(self.ref).isNotNull()).withColumnRenamed(self.key_col, "_now")
        return now.join(was, self.ref, "full_outer").filter(~F.col("_now").eqNullSafe(F.col("_was"))).select(self.ref, "_now")

    def candidates(self, changed: DataFrame) -> DataFrame:
        """``key..., ref, resolved, held`` of all entries that may need a repair, resolved anew.

        ``changed`` is the stored result of :meth:`changed_ids`. The buckets
        read are those of the changed ids: at most ``buckets`` numbers.
        """
        touched = [r[0] for r in changed.select(self._bucket(F.col(self.ref))).distinct().collect()]
        entries = self.store.side(f"{self.name}_entries")
        hit = entries.filter(F.col(BUCKET).isin(touched)).drop(BUCKET).join(changed, self.ref).select(
            *self.key, self.ref, key_default(F.col(self.ref), F.col("_now")).alias("resolved"), "held")
        waiting = self.store.side(f"{self.name}_pending").join(changed.select(self.ref), self.ref, "left_anti")
        return hit.unionByName(waiting.select(*hit.columns))

    def differing(self, entries: DataFrame) -> DataFrame:
        return entries.filter(F.col("resolved") != F.col("held"))

    def _placed(self, entries: DataFrame) -> DataFrame:
        return entries.withColumn(BUCKET, self._bucket(F.col(self.ref)))

    def built(self, source: DataFrame, result: DataFrame, live: DataFrame,
              keep: Callable[[DataFrame], DataFrame]) -> dict[str, SideChange]:
        """The whole index from every source row (``key..., ref, key_col`` resolved
        by this run) and the run's new version of the target. ``keep`` stores the
        entries, which two tables are written from, so their joins run once."""
        held = result.select(*self.key, F.col(self.key_col).alias("held"))
        entries = source.select(*self.key, self.ref, F.col(self.key_col).alias("resolved")).join(held, list(self.key), "left")
        return self._changes(keep(entries), live.filter(F.col(self.ref).isNotNull()), whole=True)

    def advanced(self, delta: DataFrame, untouched: DataFrame, written: DataFrame, changed: DataFrame,
                 keep: Callable[[DataFrame], DataFrame]) -> dict[str, SideChange]:
        """What a run changes of the index.

        ``delta`` holds ``key..., ref, key_col`` of the run's rows, ``untouched``
        the candidates outside it (stored), ``written`` the target rows the run wrote.
        """
        held = written.select(*self.key, F.col(self.key_col).alias("_after"))
        own = delta.select(*self.key, self.ref, F.col(self.key_col).alias("resolved")).join(held, list(self.key), "left").withColumnRenamed("_after", "held")
        others = untouched.withColumn("held", F.when(F.col("resolved") != F.col("held"), F.col("resolved")).otherwise(F.col("held")))
        dim = changed.select(self.ref, F.col("_now").alias(self.key_col), F.col("_now").isNull().alias(GONE))
        return self._changes(keep(own).unionByName(others.select(*own.columns)), dim, whole=False)

    def _changes(self, entries: DataFrame, dim: DataFrame, whole: bool) -> dict[str, SideChange]:
        return {
            f"{self.name}_entries": SideChange(self._placed(entries), self.key, whole, partition=BUCKET),
            f"{self.name}_pending": SideChange(self.differing(entries), self.key, whole=True),
            f"{self.name}_dim": SideChange(dim, [self.ref], whole),
        }
