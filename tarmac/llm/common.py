"""Table reading, written intermediate tables and the fold rule shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import scratch_folder, swept_shuffles

# Word separators of the word counts (fixed values): space, tab, LF, VT, FF, CR.
WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder under ``spark.checkpoint.dir`` and read it back
    (``tarmac.session.release_scratch`` deletes the application's folders).

    This cuts the lineage: tasks lost later re-read files that every executor sees.
    """
    path = scratch_folder(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def swept_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``table`` of a large shuffle, whose files go when the table is written."""
    with swept_shuffles(spark):
        return table(spark, df, name)


def drop_table(spark: SparkSession, written: DataFrame) -> None:
    """Delete the folder of a ``table`` whose readers have all been written themselves."""
    files = written.inputFiles()
    if files:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(files[0])).getParent()
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


# Rows that a Python task receives at once. Texts average a few kilobytes; the default of
# 10,000 rows would hold tens of megabytes twice in every task.
BATCH_ROWS = 512
# Bytes after which a batch ends before it has that many rows (long texts, whole files).
BATCH_BYTES = 16 << 20


def map_arrow(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` with small batches (session settings, read when the query is planned)."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def fold(doc_id: Column) -> Column:
    """crc32 of the id's text, modulo 4 (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def held_out(doc_id: Column) -> Column:
    """Rows no model may learn labels from; a null id counts as not held out."""
    return F.coalesce(fold(doc_id) == 2, F.lit(False))


def learnable(doc_id: Column) -> Column:
    """Rows whose labels a model may learn from; a null id is never learned from."""
    return F.coalesce(fold(doc_id) != 2, F.lit(False))


def draw(doc_id: Column, seed: int) -> Column:
    """A uniform number in [0, 1) fixed by the id, for bounded training samples."""
    return F.pmod(F.xxhash64(F.lit(seed), doc_id), F.lit(1 << 30)) / F.lit(float(1 << 30))
