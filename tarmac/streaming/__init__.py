"""Streaming form of the flight scan and the delay breakdown.

The analysis itself is batch; nothing here adds semantics. New flight files
dropped into a folder can be read as a stream with the same fixed schema
(IO1), cleaned with the stateless steps (CL1, CL3-CL5) and summarised by the
AG0 measures, kept as running per-key state by Structured Streaming.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.functions.derive import add_features
from tarmac.operators import quality as Q
from tarmac.operators.summarize import summary_metrics
from tarmac.schema import FLIGHT_SCHEMA
from tarmac.sources.flights import _read_schema, typed


def read_flight_stream(spark: SparkSession, path: str, fmt: str = "csv",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """IO1 as a file stream: header CSV (or Parquet) with the fixed schema."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        df = reader.option("header", True).schema(_read_schema(FLIGHT_SCHEMA)).csv(path)
    else:
        df = reader.schema(FLIGHT_SCHEMA).parquet(path)
    return df.select(*[typed(f.name, f.dataType) for f in FLIGHT_SCHEMA.fields])


def clean_stream(df: DataFrame) -> DataFrame:
    """CL1, CL3-CL5 on a stream. De-duplicate (CL2) the stored rows in batch: a watermark
    would drop rows that arrive late."""
    out = Q.parse_dates(df)
    return (out.transform(Q.drop_cancelled_and_diverted)
               .transform(Q.drop_missing_delays)
               .transform(Q.remove_delay_outliers))


def delay_summary_stream(df: DataFrame, by: str) -> DataFrame:
    """AG0 over a stream: running per-key state (use output mode complete/update)."""
    return add_features(df).groupBy(by).agg(*summary_metrics())
