"""Run a load for every micro-batch of a change stream (``foreachBatch``).

The reference loads on a schedule, selecting changed rows by timestamp. With
a stream of change records the micro-batch *is* the delta: each batch runs
the same load (keys, lookups, merge) against the latest committed snapshot
and publishes a new version. The state record of that version also holds, per
streaming query, the last epoch it committed, and every later version carries
the map on. A batch that Spark replays after a failure is recognised and
skipped; a query that starts again with a new checkpoint has a new identity,
and its epochs count from the start.

Loads whose loopback needs the whole source (company, direct mail) take it
from a table; only the delta comes from the stream.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from martloom.plans.common import JobResult
from martloom.plans.runner import run_load
from martloom.sources.control import LoadWindow
from martloom.sources.snapshot import SnapshotStore

BatchJob = Callable[[DataFrame, DataFrame, LoadWindow, int], JobResult]


def query_identity(batch: DataFrame, otherwise: str) -> str:
    """The id Spark keeps in a streaming query's checkpoint (``otherwise`` outside one)."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or otherwise


def load_micro_batch(batch: DataFrame, epoch_id: int, store: SnapshotStore, process: str, counter: str,
                     job: BatchJob, *, schema: StructType, initial_high_water: int | None = None,
                     query_id: str = "") -> bool:
    """Load one micro-batch as one committed version; False when ``query_id``
    has already committed the epoch (a replay after a failure between publish
    and the stream's own checkpoint), in which case nothing is written."""
    state = store.state()
    if state is not None and state.epochs.get(query_id, -1) >= epoch_id:
        return False

    def run(target: DataFrame, window: LoadWindow, high_water: int) -> JobResult:
        # every record of the batch belongs to this run, with or without a change time
        return job(batch, target, replace(window, lo=None), high_water)

    run_load(store, process, counter, run, schema=schema, initial_high_water=initial_high_water,
             extra_stats={"epoch": int(epoch_id)}, epochs={query_id: int(epoch_id)})
    return True


def start_incremental_load(changes: DataFrame, store: SnapshotStore, process: str, counter: str, job: BatchJob, *,
                           schema: StructType, checkpoint_location: str, initial_high_water: int | None = None,
                           available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Start a streaming query that loads each micro-batch of ``changes``.

    ``job(batch, target, window, high_water)`` is one of the loads with its
    other inputs bound, e.g.
    ``lambda b, t, w, hw: email.run(b, t, calendar, w, hw)``.
    """

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        load_micro_batch(batch, epoch_id, store, process, counter, job, schema=schema,
                         initial_high_water=initial_high_water,
                         query_id=query_identity(batch, checkpoint_location))

    writer = changes.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
