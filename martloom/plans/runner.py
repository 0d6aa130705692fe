"""Run a load against a snapshot store: window, counter, job, publish.

The store's committed state supplies the target, the high-water mark and the
window start; no table is written until the job's result is complete, and the
state record that makes it visible is written last. Rejected rows are written
with the version and stay in the store until a later run replays them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from martloom.operators.guards import DeltaProfile, GuardError, check_counter
from martloom.operators.observed import KeyRange
from martloom.plans.common import JobResult
from martloom.session import run_tables, stored_table
from martloom.sources.control import LoadWindow
from martloom.sources.lease import LEASE, Heartbeat, Lease
from martloom.sources.snapshot import SnapshotStore, TableState


@dataclass(frozen=True)
class RunResult:
    """What remains of a job once it is published; its temporary tables are gone."""

    profile: DeltaProfile
    assigned: int
    high_water: int
    surrogate_key: str | None
    replayed: int = 0       # quarantined rows that entered this run's delta


@dataclass
class RunReport:
    window: LoadWindow
    state: TableState
    result: RunResult
    store: SnapshotStore

    @property
    def quarantined(self) -> DataFrame | None:
        """The rows this run rejected, read from the store; None if it rejected none or they were replayed since."""
        return self.store.quarantined([self.state.run])


def open_window(store: SnapshotStore, process: str, committed: datetime | None, now: datetime | None = None,
                start: datetime | None = None, lease: timedelta = LEASE) -> tuple[LoadWindow, Lease]:
    """Open the run's window under a lease, or resume the one a run left open.

    ``start`` overrides the lower bound (to load an older stretch again, for
    rows that reached the source late). The window of a run that failed, or
    died and let its lease expire, is resumed with its own start; one that a
    commit has overtaken is not. While another run holds the lease,
    :class:`~martloom.sources.lease.WindowBusy` is raised.
    """
    after = committed.isoformat() if committed else None
    opened: list[LoadWindow] = []

    def window(left: dict | None) -> dict:
        pending = None
        if left is not None and left["after"] == after:
            pending = LoadWindow(process, datetime.fromisoformat(left["lo"]), datetime.fromisoformat(left["run_ts"]))
        opened.append(LoadWindow.open(process, start or committed, now, None if start else pending))
        return {"lo": opened[-1].lo.isoformat(), "run_ts": opened[-1].run_ts.isoformat(), "after": after}

    held = store.leases.acquire(process, window, lease)
    return opened[-1], held


def _replayed(store: SnapshotStore, process: str, replay: Callable[[DataFrame], DataFrame] | None):
    """(batches of the process, their repaired rows stored once, count)."""
    state = store.state()
    batches = [r for r, b in (state.quarantine if state else {}).items() if b["process"] == process]
    rejected = store.quarantined(batches) if replay is not None and batches else None
    if rejected is None:
        return [], None, 0
    rows, _ = stored_table(replay(rejected).drop("_ml_run"))
    return batches, rows, rows.count()


def run_load(store: SnapshotStore, process: str, counter: str,
             job: Callable[..., JobResult], *, schema: StructType,
             initial_high_water: int | None = None, now: datetime | None = None, start: datetime | None = None,
             check_keys: bool = True, extra_stats: dict[str, int] | None = None,
             epochs: dict[str, int] | None = None, replay: Callable[[DataFrame], DataFrame] | None = None,
             lease: timedelta = LEASE) -> RunReport:
    """One incremental run.

    * first run (no committed state): empty target of ``schema``, counter
      ``initial_high_water`` (required, like a registry row), window from epoch;
    * later runs: the committed version, its counter (missing counter = error,
      before anything is written) and ``lo`` = the last committed ``run_ts``,
      or ``start``. A run that died leaves its window open and the next one
      resumes it, once the lease has expired; one that failed gives it up.

    ``job(target, window, high_water)`` makes the new version. Rows it rejects
    (G2) are kept in the store's quarantine. With ``replay`` the process's
    quarantined rows go through that function, and the job is called as
    ``job(target, window, high_water, repaired)`` to load what it returns with
    its delta; rows still without a key are rejected again.

    The counter must not be behind the table's keys: the state says the largest
    key written so far. While the version is written Spark observes its rows
    (G5: previous rows + inserts) and its keys (G3: new ones distinct, above
    the old and within the new high-water mark); neither the target nor the
    written table is scanned for a guard.
    """
    state = store.state()
    spark = store.spark
    if state is None:
        if initial_high_water is None:
            raise LookupError(f"{process}: no committed state and no initial high-water mark for {counter}")
        target = spark.createDataFrame([], schema)
        high_water, version, committed = initial_high_water, 0, None
    else:
        if counter not in state.high_water:
            raise LookupError(f"{process}: committed state has no counter {counter}")
        target = store.read(schema)
        high_water, version, committed = state.high_water[counter], state.version, state.committed_run_ts
    window, held = open_window(store, process, committed, now, start, lease)
    try:
        with Heartbeat(store.leases, held, lease), run_tables(spark):
            batches, repaired, replayed = _replayed(store, process, replay)
            result = job(target, window, high_water) if repaired is None else job(target, window, high_water, repaired)
            keys = None
            if check_keys and result.surrogate_key:
                keys = KeyRange(result.surrogate_key, high_water, result.high_water, result.assigned, window.run_ts)
                top = state.stats.get("top") if state else None
                if top is not None and top > high_water:
                    raise GuardError(f"{keys.column}: the table holds key {top}, above the counter {high_water}")
                if state is not None and top is None and (store.partition_by is not None or store.compact_at is not None):
                    check_counter(target, keys.column, high_water)  # a version published without its keys: the one scan
            stats = {"delta_rows": result.profile.rows, "quarantined": result.profile.null_keys, "new_keys": result.assigned,
                     "replayed": replayed, **(extra_stats or {})}
            new_state = store.publish(
                result.table, expect_version=version, high_water={counter: result.high_water}, run_ts=window.run_ts,
                process=process, stats=stats, epochs=epochs, changes=result.changes, keys=keys, inserted=result.assigned,
                quarantine=result.quarantined if result.profile.null_keys else None, replayed=batches, side=result.side,
                lease=held)
    except Exception:
        if store.leases.holds(held):
            store.leases.end(held, committed=False)
        raise
    store.leases.end(held, committed=True)
    return RunReport(window, new_state, RunResult(result.profile, result.assigned, result.high_water, result.surrogate_key, replayed),
                     store)
