"""Session helpers: local sessions for tests/bench and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every session we build gets. On a cluster the same keys belong in the
# job's submit configuration; AQE re-plans joins/aggregates from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a long-lived session running ~60 distinct query shapes: keep their compiled
    # whole-stage code (the default cache of 100 classes evicts and recompiles)
    "spark.sql.codegen.cache.maxEntries": "2000",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tarmac", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir``. Only a local-mode session
    without one gets a private temporary folder (tests, laptops); a cluster
    session without one is an error, since a machine-local folder would not
    survive the loss of the machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tarmac-ckpt-"))
    return sc.getCheckpointDir()


_FOLDERS: dict[str, list[str]] = {}


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one intermediate table, remembered for ``release_scratch``."""
    path = f"{scratch_root(spark).rstrip('/')}/tarmac/{name}-{uuid.uuid4().hex}"
    _FOLDERS.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete every folder that ``scratch_folder`` gave this application (by the Hadoop file system
    API, so on shared storage too); returns how many held anything."""
    conf, removed = spark.sparkContext._jsc.hadoopConfiguration(), 0
    for path in _FOLDERS.pop(spark.sparkContext.applicationId, []):
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        removed += bool(p.getFileSystem(conf).delete(p, True))
    return removed


# Target shuffle partition size for the big one-off writes (de-duplication of
# the whole flight table). Parquet expands several-fold into shuffle rows.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024
PARQUET_EXPANSION = 3


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (Hadoop file system API, no data read)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


@contextmanager
def shuffle_partitions_for(spark: SparkSession, input_bytes: int,
                           target_bytes: int = TARGET_PARTITION_BYTES):
    """Raise ``spark.sql.shuffle.partitions`` for one job so each shuffle partition
    holds about ``target_bytes``; a larger current setting is kept. AQE then
    coalesces partitions that come out small. Restored afterwards."""
    key = "spark.sql.shuffle.partitions"
    current = int(spark.conf.get(key))
    wanted = -(-input_bytes * PARQUET_EXPANSION // target_bytes)
    if wanted > current:
        spark.conf.set(key, str(wanted))
    try:
        yield max(wanted, current)
    finally:
        spark.conf.set(key, str(current))


# Most bytes by the planner's estimate that a job with sizes it cannot know broadcasts; the rows may have
# some twenty times as many.
ESTIMATE_BYTES = 256 * 1024
STATIC_BROADCAST_KEY = "spark.sql.autoBroadcastJoinThreshold"
RUN_BROADCAST_KEY = "spark.sql.adaptive.autoBroadcastJoinThreshold"


@contextmanager
def broadcasts_by_run_size(spark: SparkSession):
    """For the jobs run meanwhile, AQE broadcasts a join's side by the bytes its shuffle had; by the planner's
    estimate only one of ``ESTIMATE_BYTES`` is. That is far too low for arrays (taken as one element) and what
    is exploded from them, and for well-compressed files, so the driver would gather tables that grow with
    the input. Restored afterwards; a frame that is planned later wants a join hint."""
    before = {key: spark.conf.get(key, None) for key in (STATIC_BROADCAST_KEY, RUN_BROADCAST_KEY)}
    most = spark.conf.get(STATIC_BROADCAST_KEY)
    spark.conf.set(RUN_BROADCAST_KEY, before[RUN_BROADCAST_KEY] or most)
    if not most.startswith("-"):  # else off
        as_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
        spark.conf.set(STATIC_BROADCAST_KEY, str(min(ESTIMATE_BYTES, as_bytes(most))))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


SWEEP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def swept_shuffles(spark: SparkSession):
    """Delete a job's shuffle files when it ends, for jobs whose result is written: else they stay on the
    executors' disks until the driver happens to collect its garbage. Restored afterwards."""
    before = spark.conf.get(SWEEP_KEY, None)
    spark.conf.set(SWEEP_KEY, "true")
    try:
        yield
    finally:
        spark.conf.unset(SWEEP_KEY) if before is None else spark.conf.set(SWEEP_KEY, before)


# Bytes a task of the one-off writes of the wide flight tables reads, of files or of a shuffle: a
# narrow compressed row becomes over 500 bytes in memory there, so a task of 64 MB would spill.
WIDE_TASK_BYTES = 16 * 1024 * 1024
TASK_SIZE_KEYS = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")


@contextmanager
def small_tasks(spark: SparkSession, most: int = WIDE_TASK_BYTES):
    """Lower the bytes that a scan or AQE gives one task to ``most`` for one job; a smaller current
    setting is kept. Restored afterwards."""
    as_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    before = {key: spark.conf.get(key) for key in TASK_SIZE_KEYS}
    for key, value in before.items():
        spark.conf.set(key, f"{min(most, as_bytes(value))}b")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
