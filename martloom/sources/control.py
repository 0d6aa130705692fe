"""Load window and key registry.

The reference keeps an "open process" row per job (its start time is the
lower bound of the delta) and a registry row per surrogate-key column
(the last key handed out). Here the counters live in the committed snapshot
state (:mod:`martloom.sources.snapshot`), so a counter cannot move without
the data, and the window of a run in progress is a stored record: a run that
fails before publish leaves it behind, and the next attempt resumes it with
the same lower bound.

A registry kept as a table is also supported (``read_high_water`` /
``update_registry``) for callers that store counters outside the snapshot.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.expressions import ts_literal

EPOCH = datetime(1970, 1, 1)


def utc_now() -> datetime:
    """Naive UTC wall clock, truncated to whole microseconds."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class LoadWindow:
    """``[lo, ...)`` is the change window; ``run_ts`` stamps every row this run
    writes and becomes the next run's ``lo``."""

    process: str
    lo: datetime | None   # None: no lower bound, rows without a change time included
    run_ts: datetime
    resumed: bool = False

    @classmethod
    def open(cls, process: str, committed_run_ts: datetime | None = None, now: datetime | None = None,
             pending: "LoadWindow | None" = None) -> "LoadWindow":
        """Open a window, or resume ``pending`` (a started, uncommitted run).

        ``lo`` = ``run_ts`` of the last committed run (epoch on the first run),
        so it is a low-water mark: rows changed while a run was in flight are
        picked up by the next one.
        """
        run_ts = now or utc_now()
        if pending is not None:
            return replace(pending, run_ts=run_ts, resumed=True)
        lo = committed_run_ts or EPOCH
        if run_ts <= lo:
            raise ValueError(f"run_ts {run_ts} is not after the window start {lo}")
        return cls(process, lo, run_ts)

    def close(self) -> datetime:
        """The lower bound of the next window."""
        return self.run_ts


def read_high_water(registry: DataFrame, tbl_nm: str, clmn_nm: str) -> int:
    """The registry row for one key column; a missing row is an error (the
    reference would silently merge keys of -1)."""
    rows = (
        registry.filter((F.col("tbl_nm") == tbl_nm) & (F.col("clmn_nm") == clmn_nm))
        .select("lst_assgnd_id")
        .limit(2)
        .collect()
    )
    if len(rows) != 1 or rows[0][0] is None:
        raise LookupError(f"key registry has {len(rows)} usable rows for {tbl_nm}.{clmn_nm}; expected 1")
    return int(rows[0][0])


def update_registry(registry: DataFrame, tbl_nm: str, clmn_nm: str, high_water: int,
                    run_ts: datetime | str) -> DataFrame:
    """The registry with one counter moved to ``high_water`` and stamped."""
    hit = (F.col("tbl_nm") == tbl_nm) & (F.col("clmn_nm") == clmn_nm)
    ts_type = registry.schema["row_updt_tms"].dataType
    return registry.select(
        "tbl_nm",
        "clmn_nm",
        F.when(hit, F.greatest(F.col("lst_assgnd_id"), F.lit(high_water).cast("bigint")))
        .otherwise(F.col("lst_assgnd_id"))
        .cast("bigint")
        .alias("lst_assgnd_id"),
        F.when(hit, ts_literal(run_ts, ts_type)).otherwise(F.col("row_updt_tms")).alias("row_updt_tms"),
    )
