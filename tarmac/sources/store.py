"""Write-once tables in the shared scratch folder, for any input files.

A table is stored under its name and the state of the files it was made from: their names,
sizes and modification times. The first request writes it (Parquet by default) under
``spark.checkpoint.dir``; later ones read those files. That cuts the lineage (a lost
executor re-reads files instead of re-running joins), lets each query read only the columns
it needs, and takes the place of an in-memory cache that would not fit at full scale. A file
that was added, removed or changed gives another state, so the table is written anew; the
older one stays for DataFrames that still read it. A folder counts only with the writer's
commit marker, so a write that broke off is done again. ``release_tables`` deletes all that
an application stored.

``flight_files`` stores the tables of a user's own flight files, ``flight_tables`` those of
the flights derived from a folder of the test data.
"""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.derive import add_features
from tarmac.operators.quality import clean_from_distinct, distinct_counts
from tarmac.session import path_bytes, release_scratch, scratch_folder, shuffle_partitions_for, small_tasks, swept_shuffles
from tarmac.sources.flights import load_flights
from tarmac.sources.star import STAR_TABLES, flights_for

MARKER = "_SUCCESS"
# Input file bytes, expanded, per shuffle partition of a job over all flight columns.
WIDE_PARTITION_BYTES = 32 * 1024 * 1024

_GUARD = threading.Lock()  # of the dictionaries; a table's own lock is held while it is written
_LOCKS: dict[tuple, threading.Lock] = {}
_PATHS: dict[tuple, str] = {}
_READS: dict[str, DataFrame] = {}


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def input_state(spark: SparkSession, paths: Sequence[str]) -> str:
    """Digest of the names, sizes and modification times of the files at some paths or globs.

    A folder's files are listed and folded together by Spark (sums over all files in it), so a
    folder of a million files sends one row to the driver.
    """
    parts = []
    for path in sorted(paths):
        p, fs = _file_system(spark, path)
        for status in fs.globStatus(p) or []:
            name = status.getPath().toString()
            if not status.isDirectory():
                parts.append((name, 1, status.getLen(), status.getModificationTime()))
                continue
            file = F.xxhash64("path", "length", "modificationTime")
            listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(name)
                      .agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(file), F.sum(file.cast("decimal(38,0)"))).first())
            parts.append((name, *listed))
    return hashlib.sha1(repr(parts).encode()).hexdigest()


def _key(spark: SparkSession, name: str, inputs: Sequence[str], state: str | None) -> tuple:
    return spark.sparkContext.applicationId, name, tuple(sorted(inputs)), state or input_state(spark, inputs)


def _committed(spark: SparkSession, key: tuple) -> str | None:
    path = _PATHS.get(key)
    if path is not None:
        marker, fs = _file_system(spark, f"{path}/{MARKER}")
        if fs.exists(marker):
            return path
    return None


def stored_path(spark: SparkSession, name: str, inputs: Sequence[str],
                write: Callable[[str], None], state: str | None = None) -> str:
    """The committed folder of a table, written by ``write(folder)`` unless it is there. ``state``:
    the inputs' state it belongs to (default: as they are now)."""
    key = _key(spark, name, inputs, state)
    with _GUARD:
        lock = _LOCKS.setdefault(key, threading.Lock())
    with lock:
        path = _committed(spark, key)
        if path is not None:
            return path
        path = scratch_folder(spark, name)
        write(path)
        _PATHS[key] = path
        return path


@contextmanager
def wide_job(spark: SparkSession, sized_by: Sequence[str]):
    """Settings of a job over all flight columns, whose tasks must stay small: what its memory does
    not hold is spilled."""
    with shuffle_partitions_for(spark, sum(path_bytes(spark, p) for p in sized_by), WIDE_PARTITION_BYTES), small_tasks(spark):
        yield


def stored(spark: SparkSession, name: str, inputs: Sequence[str], build: Callable[[], DataFrame],
           sized_by: Sequence[str] | None = None, state: str | None = None) -> DataFrame:
    """``build()`` written once per state of ``inputs``; a read of its files. The shuffles that led
    to it go when it is written.

    The read is kept, so later queries skip listing the files. The size of the files at
    ``sized_by`` (default: the inputs) sets the job's shuffle partition count.
    """
    def write(path: str) -> None:
        with wide_job(spark, sized_by or inputs), swept_shuffles(spark):
            build().write.parquet(path)

    path = stored_path(spark, name, inputs, write, state)
    with _GUARD:
        if path not in _READS:
            _READS[path] = spark.read.parquet(path)
        return _READS[path]


@dataclass(frozen=True)
class FlightTables:
    """Raw rows, distinct date-parsed rows with their copy counts (one all-column shuffle, which
    the duplicate statistics and the cleaning waterfall read too), and the cleaned and featured
    views over them: the cleaning filters reach the Parquet scan, derived columns are computed
    only for the columns read. Raw and distinct rows are each written at their first use; the
    distinct ones come from the written raw ones if there are any, else straight from the input.
    ``state`` is that of the inputs when the tables were asked for."""
    spark: SparkSession
    inputs: tuple[str, ...]
    state: str
    label: str
    build: Callable[[], DataFrame]

    @property
    def raw(self) -> DataFrame:
        return stored(self.spark, f"{self.label}-raw", self.inputs, self.build, state=self.state)

    @property
    def raw_once(self) -> DataFrame:
        """The raw rows for one pass, which does not write them."""
        written = _committed(self.spark, _key(self.spark, f"{self.label}-raw", self.inputs, self.state))
        return self.raw if written else self.build()

    @property
    def distinct(self) -> DataFrame:
        return stored(self.spark, f"{self.label}-distinct", self.inputs,
                      lambda: distinct_counts(self.raw_once, move_once=True), state=self.state)

    @property
    def clean(self) -> DataFrame:
        return clean_from_distinct(self.distinct)

    @property
    def featured(self) -> DataFrame:
        return add_features(self.clean)


def flight_files(spark: SparkSession, path: str, fmt: str = "csv") -> FlightTables:
    """The tables of flight files (a file, folder or glob), read with the fixed schema."""
    return FlightTables(spark, (path,), input_state(spark, [path]), f"files-{fmt}", lambda: load_flights(spark, path, fmt=fmt))


def flight_tables(spark: SparkSession, sf_dir: str) -> FlightTables:
    """The tables of the flights derived from a test-data folder's star schema.

    The lineitem x orders hash join builds orders per shuffle partition: partitions sized
    from the inputs keep that build side small.
    """
    inputs = tuple(f"{sf_dir}/{t}.parquet" for t in STAR_TABLES)
    return FlightTables(spark, inputs, input_state(spark, inputs), "star", lambda: flights_for(spark, sf_dir))


def release_tables(spark: SparkSession) -> int:
    """Delete the scratch folders this application wrote; returns how many were there."""
    app = spark.sparkContext.applicationId
    with _GUARD:
        for key in [k for k in _PATHS if k[0] == app]:
            _READS.pop(_PATHS.pop(key), None)
    return release_scratch(spark)
