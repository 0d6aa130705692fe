"""Session helpers: a local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import threading
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings every load relies on; a cluster session should carry the same.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # drop checkpoint files once the DataFrames that wrote them are gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def cluster_conf(shuffle_bytes: int, partition_bytes: int = 128 * 1024 * 1024) -> dict[str, str]:
    """Settings for a cluster session, sized for the largest shuffle of a run
    (the target's key columns for a merge, or the whole target when it is
    neither bucketed nor broadcast-probed).

    Shuffle partitions are sized so each holds about ``partition_bytes``
    (adaptive execution coalesces them further when they are smaller), scan
    splits match, skew-join splitting is on, and checkpoint files are
    dropped with their DataFrames. ``spark.checkpoint.dir`` must be set by
    the cluster to a shared folder; it is not chosen here.
    """
    partitions = max(200, -(-int(shuffle_bytes) // partition_bytes))
    conf = dict(RECOMMENDED_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    })
    return conf


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "martloom",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A ``local[cpus]`` session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("MARTLOOM_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def broadcasts_refused(spark: SparkSession) -> bool:
    """Whether the session has broadcast joins turned off (a threshold of -1)."""
    static, adaptive = (spark.conf.get(k, None) for k in (
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"))
    return str(static).startswith("-") and (adaptive is None or adaptive.startswith("-"))


def checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint()`` has a reliable folder and return it.

    The folder is the one the cluster names in ``spark.checkpoint.dir``.
    Only a local-mode session without that setting (tests) gets a private
    temporary folder; on a cluster a machine-local folder would not survive
    the loss of an executor, so that case is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the Spark Connect server") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder (HDFS/object store)")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="martloom-ckpt-"))
    return sc.getCheckpointDir()


TABLES_LEASE_S = 24 * 3600   # an application that stored nothing for so long has ended
_RUN = threading.local()     # the tables of the run a thread is in


def _tables_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tables"


def _tables_folder(spark: SparkSession) -> str:
    """The application's folder of temporary tables, its lease renewed."""
    folder = f"{_tables_root(spark)}/{spark.sparkContext.applicationId}"
    leases = spark.sparkContext.__dict__.setdefault("_martloom_tables", {})
    now = time.time()
    if now - leases.get(folder, 0) > TABLES_LEASE_S / 4:
        fs, path = hadoop_path(spark, f"{folder}/_lease")
        fs.create(path, True).close()  # its modification time is the lease
        if folder not in leases:
            atexit.register(_remove_at_exit, spark, folder)
        leases[folder] = now
    return folder


def _remove_at_exit(spark: SparkSession, folder: str) -> None:
    with contextlib.suppress(Exception):  # the application may have been stopped already; the sweeper comes by
        if spark.sparkContext._jsc is not None:
            remove_path(spark, folder)


def stored_table(df: DataFrame, keep: bool = False) -> tuple[DataFrame, str]:
    """``df`` written once as a Parquet table beside the session's checkpoints,
    read back, and its path (for :func:`remove_path` once it is not needed).

    Like a reliable checkpoint it cuts lineage and survives a lost executor;
    unlike one, Spark knows the table's real size when it plans a join. Tables
    lie in a folder of the application, removed when its driver ends (or by
    :func:`sweep_tables`); inside :func:`run_tables` they last as long as the
    run, unless ``keep`` says that they outlive it.
    """
    spark = df.sparkSession
    path = f"{_tables_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    made = getattr(_RUN, "made", None)
    if made is not None and not keep:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextlib.contextmanager
def run_tables(spark: SparkSession) -> Iterator[None]:
    """Temporary tables that this thread stores inside are removed at the end, however it comes."""
    outer, made = getattr(_RUN, "made", None), []
    _RUN.made = made
    try:
        yield
    finally:
        _RUN.made = outer
        for path in made:
            remove_path(spark, path)


def sweep_tables(spark: SparkSession, older_than_s: float = TABLES_LEASE_S, now: float | None = None) -> list[str]:
    """Remove the temporary tables of applications whose lease is older than
    ``older_than_s`` seconds; returns the applications. Live ones (and this one) are left alone."""
    root, gone = _tables_root(spark), []
    fs, path = hadoop_path(spark, root)
    for status in fs.listStatus(path) if fs.exists(path) else []:
        name = status.getPath().getName()
        _, lease = hadoop_path(spark, f"{root}/{name}/_lease")
        renewed = (fs.getFileStatus(lease) if fs.exists(lease) else status).getModificationTime() / 1000
        if name != spark.sparkContext.applicationId and (now or time.time()) - renewed > older_than_s:
            remove_path(spark, f"{root}/{name}")
            gone.append(name)
    return sorted(gone)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of any Hadoop-compatible location."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def ship_package(spark: SparkSession) -> None:
    """Let the executors' Python workers import this package.

    Nothing happens where its folder is on ``PYTHONPATH`` already; otherwise
    the package is zipped once a session and distributed by Spark, as
    ``spark-submit --py-files`` would.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = [os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    sc = spark.sparkContext
    if os.path.realpath(root) in known or getattr(sc, "_martloom_shipped", False):
        return
    base = os.path.join(tempfile.mkdtemp(prefix="martloom-zip-"), "martloom")
    sc.addPyFile(shutil.make_archive(base, "zip", root, "martloom"))
    sc._martloom_shipped = True
