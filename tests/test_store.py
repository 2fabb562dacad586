"""Write-once tables: keyed by the state of the input files, committed, shared between queries."""

import os
import tempfile
import time

import pytest
from conftest import SF001

from tarmac.operators import quality as Q
from tarmac.sources import store
from tarmac.sources.flights import save_table


@pytest.fixture
def files(spark):
    folder = tempfile.mkdtemp(prefix="tarmac-files-") + "/csv"
    save_table(store.flight_tables(spark, SF001).raw, folder)
    return folder


def _folders(df):
    return {f.rsplit("/", 1)[0] for f in df.inputFiles()}


def test_two_queries_read_one_stored_table(spark, files):
    t = store.flight_files(spark, files)
    again = store.flight_files(spark, files)
    assert _folders(t.distinct) == _folders(again.distinct) == _folders(again.clean) and len(_folders(t.clean)) == 1
    raw = store.flight_tables(spark, SF001)
    assert sorted(t.clean.collect()) == sorted(raw.clean.collect())
    assert Q.duplicate_stats(t.raw, t.distinct).collect() == Q.duplicate_stats(raw.raw).collect()


def test_changed_files_are_read_again(spark, files):
    t = store.flight_files(spark, files)
    n = t.raw.count()
    part = next(f for f in sorted(os.listdir(files)) if f.endswith(".csv"))
    with open(f"{files}/{part}") as f:
        lines = f.read().splitlines()
    with open(f"{files}/part-more.csv", "w") as f:
        f.write("\n".join(lines[:3]) + "\n")
    more = store.flight_files(spark, files)
    assert more.raw.count() == n + 2
    assert t.raw.count() == n  # the older table is still there for those who hold it
    os.utime(f"{files}/part-more.csv", (1, 1))
    assert _folders(store.flight_files(spark, files).raw) != _folders(more.raw)


def test_a_write_without_its_marker_is_done_again(spark, files):
    path = store.stored_path(spark, "probe", [files], lambda p: spark.range(3).write.parquet(p))
    assert store.stored_path(spark, "probe", [files], lambda p: pytest.fail("written twice")) == path
    os.remove(f"{path.replace('file:', '')}/{store.MARKER}")
    other = store.stored_path(spark, "probe", [files], lambda p: spark.range(4).write.parquet(p))
    assert other != path and spark.read.parquet(other).count() == 4
    with pytest.raises(ZeroDivisionError):
        store.stored_path(spark, "broken", [files], lambda p: 1 / 0)
    assert store.stored_path(spark, "broken", [files], lambda p: spark.range(1).write.parquet(p))


def test_state_of_globs_and_missing_paths(spark, files):
    assert store.input_state(spark, [f"{files}/*.csv"]) == store.input_state(spark, [f"{files}/*.csv"])
    assert store.input_state(spark, [f"{files}/*.csv"]) != store.input_state(spark, [f"{files}/none*"])


def test_cleaned_flights_do_not_write_the_raw_ones(spark, monkeypatch):
    monkeypatch.setattr(store, "_PATHS", {})
    t = store.flight_tables(spark, SF001)
    written = t.clean.count()
    assert [key[1] for key in store._PATHS] == ["star-distinct"]
    monkeypatch.setattr(store, "_PATHS", {})
    rows = t.raw.count()
    assert t.clean.count() == written and t.raw_once.count() == rows and t.raw_once.inputFiles() == t.raw.inputFiles()


def test_gzipped_flight_files(spark):
    folder = tempfile.mkdtemp(prefix="tarmac-files-") + "/csv"
    raw = store.flight_tables(spark, SF001).raw
    save_table(raw, folder, compression="gzip")
    assert all(f.endswith(".csv.gz") for f in os.listdir(folder) if f.startswith("part-"))
    assert sorted(map(str, store.flight_files(spark, folder).raw.collect())) == sorted(map(str, raw.collect()))


def test_a_stored_table_leaves_no_shuffle_files(spark, files):
    def shuffles():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {blocks.apply(i).name() for i in range(blocks.size()) if blocks.apply(i).name().startswith("shuffle_")}

    tables = store.flight_files(spark, files)
    before = shuffles()
    rows = tables.distinct
    # the files are deleted beside the query's end
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before
    assert rows.count() == store.flight_tables(spark, SF001).distinct.count() > 0
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
