"""Session helpers: one place for the Spark settings every job relies on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings a job needs regardless of cluster size. The size of shuffle partitions and
# file splits is the cluster's, up to ``TASK_BYTES``; AQE coalesces and splits at run time.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffles start with many partitions that are joined up to the advisory size, so what a task sorts does not grow
    # with the input where the cluster's own count is a fixed number. (Beyond 2,000 Spark keeps no sizes of blocks.)
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from compressed-file size estimates; broadcasts are either explicit after
    # a bounded count (plans/joins.py) or chosen by AQE from measured shuffle sizes.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    # Tool arguments are decoded like Python's json.loads: duplicate keys, last one wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # A list of names reaches the parquet scan as such (not as its bounds): pages without any of them are skipped.
    "spark.sql.parquet.pushdown.inFilterThreshold": "256",
    # Python work (ast, file writes) runs over Arrow batches bounded in bytes as well as rows,
    # so a batch of large files stays small in worker memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
}

# The most bytes that a task is dealt; a cluster's smaller sizes stay. Bytes count compressed, and paths, hashes and
# records of source files, sorted or joined, take 7 to 22 times as much memory: at Spark's sizes (128 MB, 64 MB) one task
# fills all of an executor's execution memory.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": 32 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 64 << 20,
}
_UNITS = {unit: 1 << 10 * i for i, unit in enumerate(("", "k", "m", "g", "t", "p"))}


def _bytes(size: str) -> int:
    """A size as Spark writes it: ``64MB``, ``64m``, ``67108864b``, ``67108864``."""
    number, unit = re.fullmatch(r"([0-9]+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) * _UNITS[unit]


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sourcelens") -> SparkSession:
    """A local session for tests and benchmarks (UI off, checkpoint dir under /tmp)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_job_conf(spark: SparkSession) -> SparkSession:
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)
    for k, most in TASK_BYTES.items():
        if _bytes(spark.conf.get(k)) > most:
            spark.conf.set(k, str(most))
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint dir; create a scratch one only when unset (tests).

    On a cluster every executor would write a machine-local folder to its own disk, so there an
    unset dir is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a shared folder before running on {master}")
    path = tempfile.mkdtemp(prefix="sourcelens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``sourcelens`` importable in Python workers (zip shipped with ``addPyFile``).

    Needed by every operator whose functions run in tasks (mapInArrow / mapInPandas).
    Idempotent per application.
    """
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = Path(__file__).resolve().parent
    out = Path(tempfile.mkdtemp(prefix="sourcelens-pkg-")) / "sourcelens.zip"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for f in pkg.rglob("*.py"):
            z.write(f, f.relative_to(pkg.parent).as_posix())
    sc.addPyFile(str(out))
    _SHIPPED.add(app)


def checkpoint(df):
    """Eager reliable checkpoint into the session's shared checkpoint dir (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_WRITTEN: dict[str, list[str]] = {}


def shared_table_path(spark: SparkSession, name: str, release: bool = False) -> str:
    """A fresh location for an intermediate table under the shared checkpoint dir; ``release_tables`` deletes it if
    asked to here."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex}"
    if release:
        _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def written_tables(spark: SparkSession) -> int:
    """How many intermediate tables this application has written and not released."""
    return len(_WRITTEN.get(spark.sparkContext.applicationId, []))


def release_tables(spark: SparkSession, since: int = 0, but_last: int = 0) -> int:
    """Delete the intermediate tables that this application has written; the number deleted.

    For the end of a job, or of a step of one (``since``: the tables written before it,
    ``but_last``: so many stay): results that still read them must have been written before.
    """
    paths = _WRITTEN.get(spark.sparkContext.applicationId, [])
    end = max(since, len(paths) - but_last)
    gone_paths = paths[since:end]
    del paths[since:end]
    jvm = spark.sparkContext._jvm
    conf, gone = spark.sparkContext._jsc.hadoopConfiguration(), 0
    for path in gone_paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        gone += bool(place.getFileSystem(conf).delete(place, True))
    return gone


def write_and_read(df, name: str, partition_by: str | None = None):
    """Write ``df`` as parquet in the shared checkpoint dir and read it back.

    Unlike an RDD checkpoint, later readers get column pruning, predicate pushdown and
    partition pruning; the write also cuts the lineage.
    """
    path = shared_table_path(df.sparkSession, name, release=True)
    w = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)
