"""Flight file scans (IO1, IO2) and result sinks (IO3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, IntegerType, StringType, StructField, StructType

from tarmac.schema import FLIGHT_SCHEMA


def _read_schema(schema: StructType) -> StructType:
    """Integer columns read as double: a CSV cell like ``12.0`` typed as int would
    silently become NULL; read wide, then cast."""
    return StructType([StructField(f.name, DoubleType() if isinstance(f.dataType, IntegerType)
                                   else f.dataType, True) for f in schema.fields])


def typed(name: str, kind: DataType) -> Column:
    """A read column in its schema type; an integer cell that is no whole number, is not
    finite or does not fit is NULL, and the rest of its row is kept."""
    c = F.col(name)
    if isinstance(kind, IntegerType):
        wide = c.try_cast("double")
        c = F.when(wide % 1 == 0, wide)
    return c.try_cast(kind).alias(name)


def rejected_cells(spark: SparkSession, path: str, schema: StructType = FLIGHT_SCHEMA, header: bool = True) -> DataFrame:
    """IO1: (file, line, column, text) of every cell that its column's type cannot hold.

    ``load_flights`` reads such a cell as NULL; this is the record of what it was. Files are read
    once more as text; ``line`` counts the file's lines from 1, the header apart. A file's
    blocks are read by different tasks, so a line's number is the lines of the file's earlier
    blocks (one row a block is aggregated for them) and its place in its own.
    """
    names = [f.name for f in schema.fields]
    text = StructType([StructField(n, StringType(), True) for n in names])
    lines = (spark.read.option("header", header).schema(text).csv(path)
             .select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_at")))
    cells = F.array(*[F.when(F.col(f.name).isNotNull() & typed(f.name, f.dataType).isNull(),
                             F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("text")))
                      for f in schema.fields if not isinstance(f.dataType, StringType)])
    bad = lines.select("file", "_block", "_at", F.inline(F.filter(cells, lambda c: c.isNotNull())))
    blocks = lines.groupBy("file", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    line = F.col("_before") + F.col("_at") - F.col("_first") + 1
    return bad.join(blocks, ["file", "_block"]).select("file", line.alias("line"), "column", "text")


def load_flights(spark: SparkSession, path: str, fmt: str = "csv",
                 schema: StructType = FLIGHT_SCHEMA, mode: str = "PERMISSIVE",
                 header: bool = True, corrupt_col: str | None = None) -> DataFrame:
    """IO1: read flight files with the fixed schema (no inference pass).

    CSV: header row, numeric integer columns read as double and cast back (``typed``).
    ``mode`` is Spark's CSV parse mode (PERMISSIVE / DROPMALFORMED / FAILFAST);
    with ``corrupt_col`` (PERMISSIVE) a malformed line's text is kept in that
    extra string column and its fields are NULL.
    Parquet: read as stored, then cast to the schema.
    """
    if fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        read_schema = _read_schema(schema)
        reader = spark.read.option("header", header).option("mode", mode)
        if corrupt_col:
            read_schema = read_schema.add(StructField(corrupt_col, StringType(), True))
            reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
        df = reader.schema(read_schema).csv(path)
    cols = [typed(f.name, f.dataType) for f in schema.fields]
    if corrupt_col and fmt != "parquet":
        cols.append(F.col(corrupt_col))
    return df.select(*cols)


def save_table(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = False,
               compression: str | None = None) -> DataFrame:
    """IO3: write a result table (overwrite; CSV with a header) and return the input.

    ``single_file`` coalesces to one partition first; use it only for small,
    aggregated results. ``compression`` is a codec of the format, e.g. gzip.
    """
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
    return df
