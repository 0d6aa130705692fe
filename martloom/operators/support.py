"""Exact distinct counts kept up to date by support counts.

``count(distinct member)`` per code, and ``count(distinct master)`` through
links from members to masters, over rows identified by a key. Beside the target
a store keeps, for a set of counts ``name``,

    <name>_rows      key -> code, member, as last counted
    <name>_support   (code, member) -> rows that carry the pair
    <name>_links     (member, master) pairs, as last counted
    <name>_masters   (code, master) -> members of the code that are linked to the master
    <name>_counts    code -> rows, distinct members, distinct masters

A changed row takes its old pair away and adds its new one; a pair whose
support leaves or reaches 0 changes the code's distinct members and, through
the links, the support of masters. A changed link changes the support of its
master under every code that has the member. No row that did not change is read
again, only its pair's support where a link of its member moved.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.session import remove_path, stored_table
from martloom.sources.layers import GONE, without_keys
from martloom.sources.snapshot import SideChange, SnapshotStore


@dataclass
class Advanced:
    """Counts after a run and what it changes of the side tables."""

    counts: DataFrame                    # code, rows, members, masters
    side: dict[str, SideChange]
    stored: list[str] = field(default_factory=list)


@dataclass
class SupportCounts:
    store: SnapshotStore
    name: str
    key: Sequence[str]
    code: str
    member: str
    master: str | None = None

    def _columns(self) -> list[str]:
        return list(dict.fromkeys([*self.key, self.code, self.member]))  # the key may hold the code or the member

    def _side(self, table: str, like: DataFrame) -> DataFrame:
        """A kept table, or an empty one with the columns it will have."""
        kept = self.store.side(f"{self.name}_{table}")
        return like.limit(0) if kept is None else kept.select(*like.columns)

    def _joined(self, a: DataFrame, b: DataFrame, on: Sequence[str], how: str) -> DataFrame:
        """A join on columns that may be NULL, keeping ``a``'s."""
        other = b.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in b.columns])
        same = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
        cond = same[0]
        for s in same[1:]:
            cond = cond & s
        return a.join(other, cond, how).drop(*[f"_r_{c}" for c in on])

    def _support(self, table: str, by: list[str], signed: DataFrame, keep) -> DataFrame:
        """``by..., before, after`` of the pairs that ``signed`` (``by..., d``) changes."""
        moved = signed.groupBy(*by).agg(F.sum("d").cast("bigint").alias("d")).filter("d <> 0")
        kept = self._side(table, moved.withColumnRenamed("d", "n"))
        return keep(self._joined(moved, kept, by, "left").select(
            *by, F.coalesce("n", F.lit(0).cast("bigint")).alias("before"), (F.coalesce("n", F.lit(0)) + F.col("d")).cast("bigint").alias("after")))

    @staticmethod
    def _presence(touched: DataFrame) -> DataFrame:
        """Pairs that came (d = 1) or went (d = -1)."""
        came = (F.col("after") > 0).cast("bigint") - (F.col("before") > 0).cast("bigint")
        return touched.withColumn("d", came).filter("d <> 0").drop("before", "after")

    def _change(self, touched: DataFrame, by: list[str]) -> SideChange:
        return SideChange(touched.select(*by, F.col("after").alias("n"), (F.col("after") == 0).alias(GONE)), by)

    def advance(self, changed: DataFrame, links: DataFrame | None = None) -> Advanced:
        """Count ``changed`` rows (``key..., code, member``, all rows the first
        time; a row whose ``_ml_gone`` is true is taken away) and ``links``
        (``member, master`` pairs, all of them). A key occurs once in
        ``changed``. NULL members count for no distinct member, NULL codes are
        a code, NULL masters are none.
        """
        stored: list[str] = []

        def keep(df: DataFrame) -> DataFrame:
            out, path = stored_table(df)
            stored.append(path)
            return out

        gone = F.coalesce(F.col(GONE), F.lit(False)) if GONE in changed.columns else F.lit(False)
        rows = keep(changed.select(*self._columns(), gone.alias(GONE)))
        old = self._joined(self._side("rows", rows.drop(GONE)), rows.select(*self.key), list(self.key), "left_semi")
        first = self.store.side(f"{self.name}_rows") is None
        signed = rows.filter(~F.col(GONE)).select(self.code, self.member, F.lit(1).cast("bigint").alias("d"))
        if not first:
            signed = keep(old.select(self.code, self.member, F.lit(-1).cast("bigint").alias("d")).unionByName(signed))
        pair = [self.code, self.member]
        touched = self._support("support", pair, signed.filter(F.col(self.member).isNotNull()), keep)
        came = self._presence(touched)
        per_code = signed.select(self.code, F.col("d").alias("rows"), F.lit(0).cast("bigint").alias("members"), F.lit(0).cast("bigint").alias("masters"))
        per_code = per_code.unionByName(came.select(self.code, F.lit(0).alias("rows"), F.col("d").alias("members"), F.lit(0).alias("masters")))
        side = {f"{self.name}_rows": SideChange(rows, self.key), f"{self.name}_support": self._change(touched, pair)}

        if links is not None:
            link = [self.member, self.master]
            now = keep(links.select(*link).filter(F.col(self.member).isNotNull() & F.col(self.master).isNotNull()).distinct())
            came_link = now.withColumn("d", F.lit(1).cast("bigint"))
            if self.store.side(f"{self.name}_links") is None:
                moved = came_link
            else:  # both are pairs that occur once: one that is in both cancels out
                went_link = self._side("links", now).withColumn("d", F.lit(-1).cast("bigint"))
                moved = keep(came_link.unionByName(went_link).groupBy(*link).agg(F.sum("d").cast("bigint").alias("d")).filter("d <> 0"))
            before = self._side("support", touched.select(*pair, F.col("before").alias("n"))).select(*pair)
            through = came.join(now, self.member).select(self.code, self.master, "d").unionByName(
                before.join(moved, self.member).select(self.code, self.master, "d"))
            owned = [self.code, self.master]
            touched_masters = self._support("masters", owned, through, keep)
            per_code = per_code.unionByName(self._presence(touched_masters).select(
                self.code, F.lit(0).alias("rows"), F.lit(0).alias("members"), F.col("d").alias("masters")))
            side[f"{self.name}_links"] = SideChange(moved.select(*link, (F.col("d") < 0).alias(GONE)), link)
            side[f"{self.name}_masters"] = self._change(touched_masters, owned)

        numbers = ["rows", "members", "masters"]
        delta = per_code.groupBy(self.code).agg(*[F.sum(c).cast("bigint").alias(f"_d_{c}") for c in numbers])
        shape = delta.select(self.code, *[F.col(f"_d_{c}").alias(c) for c in numbers])
        before_counts = self._side("counts", shape)
        counts = keep(self._joined(delta, before_counts, [self.code], "left").select(
            self.code, *[(F.coalesce(c, F.lit(0)) + F.col(f"_d_{c}")).cast("bigint").alias(c) for c in numbers]))
        side[f"{self.name}_counts"] = SideChange(counts.withColumn(GONE, F.col("rows") == 0), [self.code])
        after = without_keys(before_counts, counts, [self.code], null_safe=True).unionByName(counts.filter("rows > 0"))
        return Advanced(after, side, stored)

    def release(self, advanced: Advanced) -> None:
        for path in advanced.stored:
            remove_path(self.store.spark, path)
        advanced.stored.clear()
