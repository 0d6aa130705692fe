"""Versioned snapshots: all-or-nothing publish of a table and its counters.

Layout under ``root`` (any Hadoop-compatible path):

    data/run=<id>/              Parquet files one run wrote: the whole table, or
    data/run=<id>/_ml_p=<p>/    the partitions that run changed (partitioned store), or
                                the rows that run changed (store of change sets)
    quarantine/run=<id>/        rows that run rejected, until a later run replays them
    side/<name>/run=<id>/       what that run changed of a table kept beside the main one
    _state/v=<n>                one JSON record per version: the run that holds the
                                data, high-water marks, window, stream epochs, open
                                quarantine batches, side tables, and for a
                                partitioned store the partition -> run map
    _open/<process>/<n>         the window of a run in progress (sources/lease.py)

A partitioned store (``partition_by=<integer expression>``, stable per row,
e.g. a month of a date in the natural key or a hash bucket of the key)
rewrites only the partitions a run changed; the others stay where they are. A
store of change sets (``key=[...], compact_at=<share>``) writes only the rows
a run changed, and a new base once they pass that share of it.

Counts and key bounds are observed while a version is written (``rows`` and
``top`` in the state's ``stats``), so the next run asks nothing of the table.

A run writes only into a folder of its own, named by a fresh run id, and then
commits by renaming a finished record to ``_state/v=<n+1>``, which fails if
that version exists. Whatever two writers do, the first to commit wins, the
other is refused, and its files are referenced by no state. A run that dies
before its commit leaves the previous table, counters and window in force.
``vacuum`` deletes data no recent state refers to. Where a rename is no
exclusive operation (object stores) the record is created conditionally, and a
store that offers neither is refused (:meth:`SnapshotStore.commit_mode`).
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from martloom.functions.expressions import ts_literal
from martloom.operators.guards import GuardError, duplicate_keys
from martloom.operators.observed import KeyRange
from martloom.session import hadoop_path, remove_path, stored_table
from martloom.sources.control import utc_now
from martloom.sources.layers import (
    GONE,
    due_for_compaction,
    read_layers,
    run_files,
    runs_of,
    with_change,
    without_keys,
)
from martloom.sources.lease import Lease, Leases

PART_COL = "_ml_p"   # partition number of a row in a partitioned store
SIDE_COMPACT_AT = 0.25   # a side table gets a new base once its change sets pass this share of it


# Schemes whose rename without overwrite is exclusive, and the capability of a conditional create.
RENAMES = ("file", "hdfs", "viewfs", "webhdfs", "swebhdfs", "abfs", "abfss", "ofs", "o3fs")
CONDITIONAL_CREATE = "fs.option.create.conditional.overwrite"


class CommitUnsafe(RuntimeError):
    """The file system cannot commit a version exclusively; nothing has been written."""


class VersionConflict(RuntimeError):
    """Another run committed first; nothing of this run is visible."""


@dataclass(frozen=True)
class TableState:
    version: int
    high_water: dict[str, int] = field(default_factory=dict)
    run_ts: str | None = None          # run that produced this version (next window's lo)
    process: str | None = None
    stats: dict[str, int] = field(default_factory=dict)
    bucketing: dict | None = None       # {"buckets": n, "columns": [...]} when stored bucketed
    partitions: dict[str, str] | None = None  # partition -> run that holds it, when partitioned
    run: str | None = None              # folder of an unpartitioned version
    epochs: dict[str, int] = field(default_factory=dict)  # stream query -> last epoch it committed
    partition_rows: dict[str, int] | None = None          # partition -> its rows
    layers: dict | None = None                            # base and change sets (sources/layers.py)
    quarantine: dict[str, dict] = field(default_factory=dict)  # run -> {"rows", "process", "run_ts"}, not replayed yet
    side: dict[str, dict] = field(default_factory=dict)   # name -> {"key", "layers"} of a table beside this one

    @property
    def committed_run_ts(self) -> datetime | None:
        return datetime.fromisoformat(self.run_ts) if self.run_ts else None


@dataclass(frozen=True)
class SideChange:
    """Rows to add, replace or (``_ml_gone`` true) remove by key in a side table."""

    rows: DataFrame
    key: Sequence[str]
    whole: bool = False          # the rows are the whole table: write a new base
    partition: str | None = None  # an integer column of few values: one folder for each


@dataclass
class _Written:
    """What a publish wrote: the fields of the new state and what was observed."""

    fields: dict
    rows: int
    seen: dict
    table: DataFrame


class SnapshotStore:
    """Versioned table under ``root``.

    ``bucket_by=(n, [natural key])`` stores every version bucketed (and
    sorted) by the natural key. A later run's merge/loopback join on that
    key then shuffles only the source side: the target, the big side at
    scale, is read bucket by bucket in place. The bucket spec is kept in the
    state record and the table is re-registered on read, so it works with a
    session-scoped catalog.

    With ``partition_by`` too, every partition is written in those buckets: a
    join is co-located, a filter on ``_ml_p`` prunes.

    ``key`` names the natural key. A partitioned store with a key rewrites a
    touched partition as its old rows without the changed keys and the
    changed rows, so the load's joins run once. ``compact_at`` (with ``key``)
    makes it a store of change sets. ``sort_by`` writes a whole version (or a
    new base) in ranges of those columns, sorted, with bloom filters on them,
    so a scan narrowed to a delta's keys skips row groups.
    """

    def __init__(self, spark: SparkSession, root: str, bucket_by: tuple[int, list[str]] | None = None,
                 partition_by: Column | None = None, update_ts_col: str = "row_updt_tms", insert_ts_col: str = "row_insrt_tms",
                 key: Sequence[str] | None = None, compact_at: float | None = None, sort_by: Sequence[str] | None = None,
                 clock: Callable[[], datetime] = utc_now):
        if compact_at is not None and (bucket_by is not None or partition_by is not None):
            raise ValueError("a store of change sets has no buckets or partitions")
        if compact_at is not None and not key:
            raise ValueError("a store of change sets needs its key")
        self.spark = spark
        self.root = root.rstrip("/")
        self.bucket_by = (int(bucket_by[0]), list(bucket_by[1])) if bucket_by else None
        self.partition_by = partition_by
        self.update_ts_col, self.insert_ts_col = update_ts_col, insert_ts_col
        self.key = list(key) if key else None
        self.compact_at = compact_at
        if sort_by and (bucket_by or partition_by is not None):
            raise ValueError("sort_by is for a store without buckets and partitions")
        self.sort_by = list(sort_by) if sort_by else None
        self.leases = Leases(self, self.root, clock)

    def _table_name(self, run: str) -> str:
        digest = hashlib.sha1(self.root.encode()).hexdigest()[:12]
        return f"ml_snapshot_{digest}_{run}"

    def data_path(self, run: str) -> str:
        return f"{self.root}/data/run={run}"

    def _state_path(self, version: int | None = None) -> str:
        base = f"{self.root}/_state"
        return base if version is None else f"{base}/v={version}"

    # ---- small files of the store, through the Hadoop file system
    def names(self, folder: str) -> list[str]:
        """Names in a folder; none if there is no such folder, any other fault is raised."""
        fs, path = hadoop_path(self.spark, folder)
        if not fs.exists(path):
            return []
        return [status.getPath().getName() for status in fs.listStatus(path)]

    def load(self, path: str) -> dict:
        return json.loads("\n".join(r[0] for r in self.spark.read.text(path, wholetext=True).collect()))

    def commit_mode(self) -> str:
        """How a record is created exclusively on the store's file system.

        ``rename``: a finished file is renamed and the rename fails if the name
        exists (local, HDFS and the other file systems of ``RENAMES``).
        ``create``: the file system promises that a create without overwrite
        fails, atomically, if the name exists (conditional writes of an object
        store). Anything else is refused before data is written.
        """
        fs, path = hadoop_path(self.spark, self.root)
        if fs.getUri().getScheme() in RENAMES:
            return "rename"
        if fs.hasPathCapability(path, CONDITIONAL_CREATE):
            return "create"
        raise CommitUnsafe(f"{self.root}: the file system offers neither an exclusive rename nor a conditional create")

    def save(self, path: str, record: dict, *, exclusive: bool) -> None:
        """Write a finished file into place; ``exclusive``: fail if it exists."""
        jvm = self.spark.sparkContext._jvm
        data = bytearray(json.dumps(record).encode())
        fs, place = hadoop_path(self.spark, path)
        if exclusive and self.commit_mode() == "create":
            # the object appears whole when the stream is closed, or the close fails
            builder = fs.createFile(place).overwrite(False).recursive()
            out = builder.opt(CONDITIONAL_CREATE, True).build()
            out.write(data)
            out.close()
            return
        fs, waiting = hadoop_path(self.spark, f"{self.root}/_waiting/{uuid.uuid4().hex}")
        out = fs.create(waiting, False)
        try:
            out.write(data)
        finally:
            out.close()
        fs.mkdirs(place.getParent())
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE if exclusive else rename.OVERWRITE
        context.rename(fs.makeQualified(waiting), fs.makeQualified(place), options)

    def remove(self, path: str) -> None:
        remove_path(self.spark, path)

    def versions(self) -> list[int]:
        return sorted(int(n[2:]) for n in self.names(self._state_path()) if n.startswith("v="))

    def state(self, version: int | None = None) -> TableState | None:
        """A committed state, the last by default; None for a table never published."""
        committed = self.versions()
        if not committed:
            return None
        return TableState(**self.load(self._state_path(committed[-1] if version is None else version)))

    def open_window(self, process: str) -> dict | None:
        """The stored window of a run that was started and not committed."""
        return self.leases.current(process)[0]

    # ---- data
    def read(self, schema: StructType | None = None, version: int | None = None) -> DataFrame | None:
        st = self.state(version)
        if st is None:
            return None
        if st.layers:
            return read_layers(self.spark, f"{self.root}/data", st.layers, self.key or st.layers["key"], schema, unique=True)
        if st.partitions:
            return self._partition_table(st, schema)
        if st.partitions is not None:
            return self._partitioned(st.partitions, schema)
        if st.bucketing:
            return self._bucketed_table(st.run, st.bucketing, schema)
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        return reader.parquet(self.data_path(st.run))

    def _partitioned(self, partitions: dict[str, str], schema: StructType | None) -> DataFrame:
        """The current version of every partition, each from the run that
        last wrote it; ``_ml_p`` comes back as a partition column, so a
        filter on it prunes folders."""
        base = f"{self.root}/data"
        if not partitions:
            if schema is None:
                raise ValueError("an empty partitioned table needs its schema")
            fields = [*schema.fields, StructField(PART_COL, LongType(), True)]
            return self.spark.createDataFrame([], StructType(fields))
        paths = [f"{base}/run={run}/{PART_COL}={p}" for p, run in sorted(partitions.items(), key=lambda kv: int(kv[0]))]
        reader = self.spark.read.option("basePath", base)
        if schema is not None:
            fields = [f for f in schema.fields if f.name != PART_COL]
            reader = reader.schema(StructType([*fields, StructField(PART_COL, LongType(), True),
                                               StructField("run", StringType(), True)]))
        return reader.parquet(*paths).drop("run")

    def _partition_table(self, st: TableState, schema: StructType | None) -> DataFrame:
        """A partitioned version as a table of the session's catalog, every
        partition in the folder of the run that last wrote it. The catalog
        prunes by ``_ml_p``, so a plan holds the partitions it reads and no list of all paths."""
        name = f"{self._table_name(st.run)}_v"
        if not self.spark.catalog.tableExists(name):
            if schema is None:
                schema = self.spark.read.parquet(next(f"{self.data_path(r)}/{PART_COL}={p}" for p, r in st.partitions.items())).schema
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != PART_COL)
            buckets = ""
            if st.bucketing:
                keys = ", ".join(f"`{c}`" for c in st.bucketing["columns"])
                buckets = f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {int(st.bucketing['buckets'])} BUCKETS"
            root = self.root.replace("'", "\\'")
            self.spark.sql(f"CREATE TABLE {name} ({cols}, {PART_COL} BIGINT) USING parquet PARTITIONED BY ({PART_COL}) {buckets} "
                           f"LOCATION '{root}/data/none'")
            places = [f"PARTITION ({PART_COL}={int(p)}) LOCATION '{root}/data/run={run}/{PART_COL}={int(p)}'"
                      for p, run in st.partitions.items()]
            for at in range(0, len(places), 1000):
                self.spark.sql(f"ALTER TABLE {name} ADD {' '.join(places[at : at + 1000])}")
        return self.spark.table(name)

    def _bucketed_table(self, run: str, bucketing: dict, schema: StructType | None) -> DataFrame:
        name = self._table_name(run)
        if not self.spark.catalog.tableExists(name):
            if schema is None:
                schema = self.spark.read.parquet(self.data_path(run)).schema
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            keys = ", ".join(f"`{c}`" for c in bucketing["columns"])
            path = self.data_path(run).replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                f"INTO {int(bucketing['buckets'])} BUCKETS LOCATION '{path}'"
            )
        return self.spark.table(name)

    def quarantined(self, runs: Sequence[str] | None = None) -> DataFrame | None:
        """Rejected rows not replayed yet (of ``runs``, or all), with the run
        that rejected them in ``_ml_run``; None where there are none."""
        st = self.state()
        batches = [r for r in (st.quarantine if st else {}) if runs is None or r in runs]
        out = None
        for run in batches:
            rows = run_files(self.spark, f"{self.root}/quarantine", run, None).withColumn("_ml_run", F.lit(run))
            out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
        return out

    def side(self, name: str, version: int | None = None) -> DataFrame | None:
        """The table kept beside the main one under ``name``; None if there is none yet."""
        st = self.state(version)
        kept = st.side.get(name) if st else None
        return None if kept is None else read_layers(
            self.spark, f"{self.root}/side/{name}", kept["layers"], kept["key"], StructType.fromJson(json.loads(kept["schema"])),
            null_safe=True)

    # ---- publish
    def publish(self, df: DataFrame, *, expect_version: int, high_water: dict[str, int] | None = None,
                run_ts: datetime | str | None = None, process: str | None = None,
                stats: dict[str, int] | None = None, epochs: dict[str, int] | None = None,
                verify: Callable[[DataFrame], None] | None = None, changes: DataFrame | None = None,
                keys: KeyRange | None = None, inserted: int | None = None, quarantine: DataFrame | None = None,
                replayed: Sequence[str] = (), side: Mapping[str, SideChange] | None = None,
                lease: Lease | None = None) -> TableState:
        """Write ``df`` as version ``expect_version + 1`` and commit it.

        ``changes`` are the rows of ``df`` this run changed or inserted, for
        stores that write only those (by default the rows of ``df`` stamped
        ``run_ts``). Observed while writing: row counts, and with ``keys`` the
        run's surrogate keys (G3). With ``inserted`` the new version must
        hold that many rows more than the last (G5). ``quarantine`` and
        ``side`` tables are written in the run's folders and become visible
        with the same record; ``replayed`` names quarantine batches this run
        used up. ``verify`` gets the written version (read back from storage)
        before the commit; an exception there, or a ``lease`` that was taken
        over, leaves the previous version current.
        """
        current = self.state()
        current_version = current.version if current else 0
        if current_version != expect_version:
            raise VersionConflict(f"{self.root}: version moved from {expect_version} to {current_version}")
        self.commit_mode()  # refused here, before data is written, where no commit is safe
        new_version, run = expect_version + 1, uuid.uuid4().hex
        if self.partition_by is not None:
            written = self._write_partitions(df, run, current, run_ts, changes, keys)
        elif self.compact_at is not None and current is not None and current.layers:
            written = self._write_changes(df, run, current, run_ts, changes, keys)
        else:
            written = self._write_whole(df, run, keys)
        if keys is not None:
            keys.check(self.spark, written.seen)
        if inserted is not None and current is not None and "rows" in current.stats:
            before = current.stats["rows"]
            if written.rows != before + inserted:
                raise GuardError(f"{process or self.root}: {written.rows} rows, expected {before} + {inserted} inserts")
        batches = {r: b for r, b in (current.quarantine if current else {}).items() if r not in set(replayed)}
        ts_text = run_ts.isoformat() if isinstance(run_ts, datetime) else run_ts
        if quarantine is not None:
            rows = self._observed_write(quarantine, f"{self.root}/quarantine/run={run}")["rows"]
            if rows:
                batches[run] = {"rows": rows, "process": process, "run_ts": ts_text}
        sides = {**(current.side if current else {}), **{
            name: self._write_side(name, change, run, current) for name, change in (side or {}).items()}}
        if verify is not None:
            verify(written.table)

        top = [v for v in (written.seen.get("top"), current.stats.get("top") if current else None) if v is not None]
        facts = {"rows": written.rows, **({"top": max(top)} if top else {})}
        new_state = TableState(
            new_version, {**(current.high_water if current else {}), **(high_water or {})}, ts_text, process,
            {**(stats or {}), **facts}, run=run, epochs={**(current.epochs if current else {}), **(epochs or {})},
            quarantine=batches, side=sides, **written.fields)
        if lease is not None:
            self.leases.check(lease)
        try:
            self.save(self._state_path(new_version), asdict(new_state), exclusive=True)
        except Exception as exc:
            if new_version in self.versions():
                raise VersionConflict(f"{self.root}: another run committed version {new_version} first") from exc
            raise
        return new_state

    def _observed_write(self, df: DataFrame, path: str, keys: KeyRange | None = None, partitioned: str | None = None,
                        bucketed: str | None = None, **metrics: Column) -> dict:
        """Write ``df`` and return what was observed: its rows, ``metrics`` and the key facts."""
        watch = Observation()
        wanted = {"rows": F.count(F.lit(1)), **metrics, **(keys.metrics(df) if keys else {})}
        writer = df.observe(watch, *[c.alias(n) for n, c in wanted.items()]).write
        for column in self.sort_by or []:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        if bucketed:
            n, cols = self.bucket_by
            writer = writer.partitionBy(partitioned) if partitioned else writer
            writer.bucketBy(n, *cols).sortBy(*cols).option("path", path).saveAsTable(bucketed)
        elif partitioned:
            writer.partitionBy(partitioned).parquet(path)
        else:
            writer.parquet(path)
        return watch.get

    def _ordered(self, df: DataFrame) -> DataFrame:
        return df if not self.sort_by else df.repartitionByRange(*self.sort_by).sortWithinPartitions(*self.sort_by)

    def _write_whole(self, df: DataFrame, run: str, keys: KeyRange | None) -> _Written:
        fields: dict = {}
        seen = self._observed_write(self._ordered(df), self.data_path(run), keys,
                                    bucketed=self._table_name(run) if self.bucket_by else None)
        if self.bucket_by:
            fields["bucketing"] = {"buckets": self.bucket_by[0], "columns": self.bucket_by[1]}
        if self.compact_at is not None:
            fields["layers"] = {"base": run, "rows": seen["rows"], "changes": [], "key": self.key}
        return _Written(fields, seen["rows"], seen, run_files(self.spark, f"{self.root}/data", run, df.schema))

    def _changes(self, df: DataFrame, changes: DataFrame | None, run_ts: datetime | str | None) -> DataFrame:
        if changes is not None:
            return changes
        if run_ts is None:
            raise ValueError("a store that writes changed rows needs them or the run timestamp")
        return df.filter(F.col(self.update_ts_col) == ts_literal(run_ts, df.schema[self.update_ts_col].dataType))

    def _require_unique(self, changes: DataFrame) -> None:
        """A key that a run changes twice is an error: the newest row would hide the other."""
        twice = duplicate_keys(changes, self.key).limit(1).collect()
        if twice:
            raise GuardError(f"{self.root}: a run changes a key more than once, e.g. {tuple(twice[0])[:-1]}")

    def _write_changes(self, df: DataFrame, run: str, current: TableState, run_ts: datetime | str | None,
                       changes: DataFrame | None, keys: KeyRange | None) -> _Written:
        """Write the changed rows; a new base once the change sets pass ``compact_at`` of it."""
        changed = self._changes(df, changes, run_ts).select(*df.columns)
        folder, path = f"{self.root}/data", self.data_path(run)
        if keys is None:
            stamp = ts_literal(run_ts, df.schema[self.insert_ts_col].dataType)
            seen = self._observed_write(changed, path, new_rows=F.count(F.when(F.col(self.insert_ts_col) == stamp, 1)))
        else:
            seen = self._observed_write(changed, path, keys)
        self._require_unique(run_files(self.spark, folder, run, df.schema))
        rows = current.stats["rows"] + seen["new_rows"]
        layers = with_change(current.layers, run, seen["rows"])
        if due_for_compaction(layers, self.compact_at):
            base = f"{run}-base"
            whole = self._observed_write(self._ordered(read_layers(self.spark, folder, layers, self.key, df.schema, unique=True)), self.data_path(base))
            if whole["rows"] != rows:
                raise GuardError(f"{self.root}: the new base has {whole['rows']} rows, expected {rows}")
            layers = {"base": base, "rows": rows, "changes": [], "key": self.key}
        return _Written({"layers": layers}, rows, seen, read_layers(self.spark, folder, layers, self.key, df.schema, unique=True))
    def _write_partitions(self, df: DataFrame, run: str, current: TableState | None, run_ts: datetime | str | None,
                          changes: DataFrame | None, keys: KeyRange | None) -> _Written:
        """Write only the partitions this run changed; the manifest of the new
        version keeps pointing at the run that holds each of the others.

        With the store's key the changed rows are stored once; a touched
        partition becomes its old rows without the changed keys, and the
        changed rows. Without it (or for a frame that does not come from the
        store) touched partitions are found by a narrow query over ``df`` and
        computed again at full width. Both count each touched partition's
        rows, and the rows written must be as many.
        """
        if run_ts is None:
            raise ValueError("a partitioned publish needs the run timestamp")
        manifest = dict(current.partitions or {}) if current is not None and current.partitions else {}
        rows = dict(current.partition_rows or {}) if current is not None and current.partition_rows else {}
        from_store = PART_COL in df.columns
        base = df if from_store else df.withColumn(PART_COL, F.lit(None).cast("bigint"))
        part = F.coalesce(F.col(PART_COL), self.partition_by).cast("bigint")
        if self.key and from_store:
            changed, path = stored_table(self._changes(base, changes, run_ts).select(*base.columns).withColumn("_ml_home", part))
            counts = changed.groupBy("_ml_home").agg(F.count(F.when(F.col(PART_COL).isNull(), 1))).collect()
            touched = {str(p): rows.get(str(p), 0) + n for p, n in counts}  # one row a touched partition
            placed = changed.withColumn(PART_COL, F.col("_ml_home")).drop("_ml_home")
            old = {p: manifest[p] for p in touched if p in manifest}
            whole = placed.unionByName(without_keys(self._partitioned(old, df.schema), changed, self.key)) if old else placed
        else:
            path = None
            stamp = ts_literal(run_ts, base.schema[self.update_ts_col].dataType)
            counts = base.groupBy(part.alias("p")).agg(
                F.count(F.lit(1)).alias("n"), F.count(F.when(F.col(self.update_ts_col) == stamp, 1)).alias("c")).filter("c > 0").collect()
            touched = {str(r["p"]): r["n"] for r in counts}
            kept = base.filter(F.col(PART_COL).isNotNull() & F.col(PART_COL).isin([int(p) for p in touched]))  # folder pruning
            fresh = base.filter(F.col(PART_COL).isNull()).withColumn(PART_COL, self.partition_by.cast("bigint"))
            whole = kept.unionByName(fresh)
        seen = dict.fromkeys(("rows", "new_rows", "new_keys", "old_above", "not_positive"), 0)
        if touched:
            bucketed = None
            if self.bucket_by:  # a task holds one bucket: one file for each partition and bucket
                whole, bucketed = whole.repartition(self.bucket_by[0], *self.bucket_by[1]), self._table_name(run)
            seen = self._observed_write(whole, self.data_path(run), keys, partitioned=PART_COL, bucketed=bucketed)
            if seen["rows"] != sum(touched.values()):
                raise GuardError(f"{self.root}: wrote {seen['rows']} rows to partitions that hold {sum(touched.values())}")
        if path:
            remove_path(self.spark, path)
        manifest.update(dict.fromkeys(touched, run))
        rows.update(touched)
        table = self._partitioned(manifest, df.schema).drop(PART_COL) if manifest else df.limit(0)
        fields = {"partitions": manifest, "partition_rows": rows}
        if self.bucket_by:
            fields["bucketing"] = {"buckets": self.bucket_by[0], "columns": self.bucket_by[1]}
        return _Written(fields, sum(rows.values()), seen, table)

    def _write_side(self, name: str, change: SideChange, run: str, current: TableState | None) -> dict:
        """Add a change set (or a new base) to a side table; its layers."""
        kept = current.side.get(name) if current else None
        folder, key = f"{self.root}/side/{name}", list(change.key)
        rows = change.rows if GONE in change.rows.columns else change.rows.withColumn(GONE, F.lit(False))
        part = change.partition

        def shaped(schema: StructType) -> str:
            """The stored columns, a partition column last, all of them nullable."""
            fields = [StructField(f.name, f.dataType, True) for f in schema.fields]
            return StructType([f for f in fields if f.name != part] + [f for f in fields if f.name == part]).json()

        if kept is None or change.whole:
            n = self._observed_write(rows.filter(~F.col(GONE)), f"{folder}/run={run}", partitioned=part)["rows"]
            return {"key": key, "schema": shaped(rows.schema), "layers": {"base": run, "rows": n, "changes": []}}
        n = self._observed_write(rows, f"{folder}/run={run}", partitioned=part)["rows"]
        layers = with_change(kept["layers"], run, n)
        if due_for_compaction(layers, SIDE_COMPACT_AT):
            whole = read_layers(self.spark, folder, layers, key, StructType.fromJson(json.loads(kept["schema"])), null_safe=True)
            n = self._observed_write(whole.withColumn(GONE, F.lit(False)), f"{folder}/run={run}-base", partitioned=part)["rows"]
            layers = {"base": f"{run}-base", "rows": n, "changes": []}
        return {**kept, "layers": layers}

    def _used(self, state: TableState) -> dict[str, set[str]]:
        """Run folders a state refers to, by the folder they are in."""
        used = {"data": {*([state.run] if state.run else []), *(state.partitions or {}).values(), *runs_of(state.layers)},
                "quarantine": set(state.quarantine)}
        return used | {f"side/{n}": set(runs_of(s["layers"])) for n, s in state.side.items()}

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete states older than the last ``keep`` and every run folder that no
        kept state refers to; returns the removed run ids. Not to be called
        while another run writes."""
        if keep < 1:
            raise ValueError("at least one version must be kept")
        versions = self.versions()
        used: dict[str, set[str]] = {}
        for st in map(self.state, versions[-keep:]):
            for folder, runs in self._used(st).items():
                used.setdefault(folder, set()).update(runs)
        for version in versions[:-keep]:
            remove_path(self.spark, self._state_path(version))
        gone = set()
        for folder in ["data", "quarantine", *(f"side/{n}" for n in self.names(f"{self.root}/side"))]:
            for name in self.names(f"{self.root}/{folder}"):
                if name.startswith("run=") and name[4:] not in used.get(folder, set()):
                    gone.add(name[4:])
                    if folder == "data":
                        for kept in (self._table_name(name[4:]), f"{self._table_name(name[4:])}_v"):
                            self.spark.sql(f"DROP TABLE IF EXISTS `{kept}`")
                    remove_path(self.spark, f"{self.root}/{folder}/{name}")
        return sorted(gone)


def publish_snapshot(store: SnapshotStore, df: DataFrame, *, expect_version: int, **state) -> TableState:
    """Publish ``df`` as the next version of ``store`` (all or nothing); see
    :meth:`SnapshotStore.publish` for the state fields and the checks."""
    return store.publish(df, expect_version=expect_version, **state)

