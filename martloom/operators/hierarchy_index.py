"""The kept index of a self-referencing dimension's pointers.

As :class:`~martloom.operators.reference_index.ReferenceIndex`, for a target
that is its own dimension and whose loopback repairs several pointers of a row
together. Beside the target are kept

    <name>_entries   (id, role) -> the role's reference, both references, the keys they
                     resolved to and the keys the target row holds, in folders by a
                     hash bucket of the role's reference
    <name>_pending   the rows the rule would repair and no run has yet
    <name>_last      the ids of the last run's delta and the live key each had in it

The last table is needed because a run sees its delta's own status (NULL is not
live) and the next one the status the merge wrote.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.expressions import NOT_APPLICABLE, is_live, key_default
from martloom.operators.reference_index import BUCKET
from martloom.sources.snapshot import SideChange, SnapshotStore


@dataclass
class HierarchyIndex:
    """The index ``name``: ``pointers`` maps reference columns to key columns of
    the target, whose ids are ``id_col`` and keys ``key_col``."""

    store: SnapshotStore
    name: str
    id_col: str
    key_col: str
    pointers: Mapping[str, str]
    buckets: int = 256

    @property
    def ready(self) -> bool:
        """False until a first run has built the index from the whole source."""
        state = self.store.state()
        return state is not None and f"{self.name}_entries" in state.side

    def _bucket(self, ref: Column) -> Column:
        return F.pmod(F.xxhash64(ref), F.lit(self.buckets)).cast("int")

    def _live(self, rows: DataFrame, as_: str) -> DataFrame:
        """``id, as_``: the key of live rows, NULL for others."""
        return rows.select(self.id_col, F.when(is_live(F.col("row_stat_cd")), F.col(self.key_col)).alias(as_))

    def seen(self, delta: DataFrame, spine: DataFrame) -> DataFrame:
        """``id, live`` of the delta's ids as this run's spine has them."""
        return self._live(spine.join(delta.select(self.id_col), self.id_col, "left_semi"), "live")

    def changed_ids(self, seen: DataFrame, target: DataFrame) -> DataFrame:
        """``id, _now``: ids whose live key differs from what the last run saw."""
        last = self.store.side(f"{self.name}_last").select(self.id_col, F.col("live").alias("_last"), F.lit(True).alias("_in_last"))
        both = seen.withColumnRenamed("live", "_seen").withColumn("_in_delta", F.lit(True)).join(last, self.id_col, "full_outer")
        held = self._live(target, "_held").join(both.select(self.id_col), self.id_col, "left_semi")
        both = both.join(held, self.id_col, "left")
        now = F.when(F.col("_in_delta"), F.col("_seen")).otherwise(F.col("_held"))
        was = F.when(F.col("_in_last"), F.col("_last")).otherwise(F.col("_held"))
        return both.filter(~now.eqNullSafe(was)).select(self.id_col, now.alias("_now"))

    def _columns(self) -> list[str]:
        return [self.id_col, *self.pointers, *[f"{p}_{c}" for p in ("resolved", "held") for c in self.pointers.values()]]

    def candidates(self, changed: DataFrame) -> DataFrame:
        """Entries that may need a repair, resolved anew; ``changed`` is a stored table.

        The buckets read are those of the changed ids: at most ``buckets`` numbers.
        """
        touched = [r[0] for r in changed.select(self._bucket(F.col(self.id_col))).distinct().collect()]
        entries = self.store.side(f"{self.name}_entries").filter(F.col(BUCKET).isin(touched))
        hit = entries.join(changed.select(F.col(self.id_col).alias("ref")), "ref", "left_semi").select(*self._columns())
        out = hit.unionByName(self.store.side(f"{self.name}_pending").select(*self._columns())).distinct()
        for ref, key in self.pointers.items():
            moved = changed.select(F.col(self.id_col).alias("_ref"), "_now", F.lit(True).alias("_moved"))
            out = out.join(moved, F.col(ref) == F.col("_ref"), "left").withColumn(
                f"resolved_{key}", F.when(F.col("_moved"), key_default(F.col(ref), F.col("_now"))).otherwise(F.col(f"resolved_{key}"))
            ).drop("_ref", "_now", "_moved")
        return out

    def differs(self) -> Column:
        """The loopback's rule: a pointer the row holds is not 0, and one differs."""
        nonzero = [F.col(f"held_{c}") != NOT_APPLICABLE for c in self.pointers.values()]
        unequal = [F.col(f"resolved_{c}") != F.col(f"held_{c}") for c in self.pointers.values()]
        either = [reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in cs]) for cs in (nonzero, unequal)]
        return either[0] & either[1]

    def repairs(self, candidates: DataFrame) -> DataFrame:
        """``id, key columns`` the target rows should hold."""
        return candidates.filter(self.differs()).select(
            self.id_col, *[F.col(f"resolved_{c}").alias(c) for c in self.pointers.values()])

    def built(self, source: DataFrame, result: DataFrame, seen: DataFrame,
              keep: Callable[[DataFrame], DataFrame]) -> dict[str, SideChange]:
        """The whole index from every source row with its pointers resolved, and the run's new version.
        ``keep`` stores the entries, which two tables are written from."""
        held = result.select(self.id_col, *[F.col(c).alias(f"held_{c}") for c in self.pointers.values()])
        entries = source.select(self.id_col, *self.pointers, *[F.col(c).alias(f"resolved_{c}") for c in self.pointers.values()]).join(
            held, self.id_col, "left")
        return self._changes(keep(entries), seen, whole=True)

    def advanced(self, delta: DataFrame, untouched: DataFrame, seen: DataFrame) -> dict[str, SideChange]:
        """What a run changes: its delta's rows (whose pointers the merge writes)
        and the candidates outside it."""
        own = delta.select(self.id_col, *self.pointers, *[F.col(c).alias(f"{p}_{c}") for p in ("resolved", "held")
                                                          for c in self.pointers.values()])
        others = untouched.withColumn("_fix", self.differs())
        for c in self.pointers.values():
            others = others.withColumn(f"held_{c}", F.when(F.col("_fix"), F.col(f"resolved_{c}")).otherwise(F.col(f"held_{c}")))
        return self._changes(own.unionByName(others.select(*own.columns)), seen, whole=False)

    def _changes(self, entries: DataFrame, seen: DataFrame, whole: bool) -> dict[str, SideChange]:
        roles = F.array(*[F.struct(F.lit(i).alias("role"), F.col(ref).alias("ref")) for i, ref in enumerate(self.pointers)])
        stacked = entries.select(*self._columns(), F.inline(roles)).withColumn(BUCKET, self._bucket(F.col("ref")))
        return {
            f"{self.name}_entries": SideChange(stacked, [self.id_col, "role"], whole, partition=BUCKET),
            f"{self.name}_pending": SideChange(entries.filter(self.differs()), [self.id_col], whole=True),
            f"{self.name}_last": SideChange(seen, [self.id_col], whole=True),
        }
