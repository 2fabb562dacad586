"""Cleaning chain and data-quality reports (CL1-CL11, IO7, WN1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.numeric import stable_round

# Outlier window for both delays, minutes, inclusive.
OUTLIER_LOW = -120
OUTLIER_HIGH = 1440
DELAY_COLUMNS = ["dep_delay", "arr_delay"]
DESCRIBE_COLUMNS = ["dep_delay", "arr_delay", "distance", "air_time", "taxi_out"]


def parse_dates(df: DataFrame, col: str = "fl_date", fmt: str = "yyyy-MM-dd",
                strict: bool = False) -> DataFrame:
    """CL1: text -> date. Bad text becomes NULL (``strict=True`` raises instead)."""
    fn = F.to_date if strict else F.try_to_date
    return df.withColumn(col, fn(F.col(col), fmt))


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """CL2: drop exact duplicate rows (or rows equal on ``subset``).

    A hash aggregate with a map-side partial step: copies of one row collapse
    inside each map task before the shuffle, so a hot group of copies costs one
    row per task on the wire.
    """
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def flew_normally(cancelled: str = "cancelled", diverted: str = "diverted"):
    """Predicate of CL3. A NULL flag makes the row fail the test."""
    return (F.col(cancelled) == 0) & (F.col(diverted) == 0)


def drop_cancelled_and_diverted(df: DataFrame) -> DataFrame:
    """CL3."""
    return df.filter(flew_normally())


def delays_present(cols: Sequence[str] = DELAY_COLUMNS):
    cond = None
    for c in cols:
        t = F.col(c).isNotNull()
        cond = t if cond is None else cond & t
    return cond


def drop_missing_delays(df: DataFrame, cols: Sequence[str] = DELAY_COLUMNS) -> DataFrame:
    """CL4."""
    return df.dropna(subset=list(cols))


def delays_in_range(low: float = OUTLIER_LOW, high: float = OUTLIER_HIGH,
                    cols: Sequence[str] = DELAY_COLUMNS):
    cond = None
    for c in cols:
        t = F.col(c).between(low, high)
        cond = t if cond is None else cond & t
    return cond


def remove_delay_outliers(df: DataFrame, low: float = OUTLIER_LOW,
                          high: float = OUTLIER_HIGH) -> DataFrame:
    """CL5: both delays within [low, high]."""
    return df.filter(delays_in_range(low, high))


def clean_flights(df: DataFrame, low: float = OUTLIER_LOW, high: float = OUTLIER_HIGH) -> DataFrame:
    """CL6: CL1 -> CL5 in the reference order."""
    return (df.transform(parse_dates)
              .transform(drop_duplicates)
              .transform(drop_cancelled_and_diverted)
              .transform(drop_missing_delays)
              .transform(lambda d: remove_delay_outliers(d, low, high)))


def table_profile(df: DataFrame) -> DataFrame:
    """IO7: one row (rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "columns", F.lit(len(df.columns)).cast("int"))


def missing_value_report(df: DataFrame) -> DataFrame:
    """CL7: NULL count of every column, one wide row, one pass."""
    return df.select([F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def missing_value_long(df: DataFrame) -> DataFrame:
    """CL8: (column_name, null_count), most NULLs first."""
    wide = missing_value_report(df)
    return (wide.unpivot([], wide.columns, "column_name", "null_count")
                .orderBy(F.desc("null_count"), "column_name"))


COPY_COUNT = "_n"
SPELLINGS = "_spellings"


def distinct_counts(df: DataFrame, dates: str = "fl_date", fmt: str = "yyyy-MM-dd", move_once: bool = False) -> DataFrame:
    """Each distinct date-parsed row once, with its copies ``_n`` and how many different raw rows
    (date texts) they were, ``_spellings``.

    De-duplicated rows, the duplicate count and the cleaning waterfall all come from this one
    aggregate; written once, it saves re-shuffling every column. Copies collapse map-side; a
    first shuffle meets equal raw rows, a second one moves those distinct rows by what they
    parse to. Texts that parse to the same date (all that do not parse give NULL) make
    rows equal that were not.

    ``move_once`` (large tables of few copies) deals the rows by what they parse to first: the
    aggregates find them in place, so there is one shuffle instead of two and no map-side table of
    rows that outgrows its task. Copies of one row then all move, to one task, which folds them
    as they come.
    """
    text = F.col("_text")
    parsed = df.withColumns({"_text": F.col(dates), dates: F.try_to_date(F.col(dates), fmt)})
    if move_once:
        parsed = parsed.repartition(*df.columns)
    spellings = F.count_distinct(text) + F.max(F.when(text.isNull(), 1).otherwise(0))
    return parsed.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPY_COUNT), spellings.alias(SPELLINGS))


def clean_from_distinct(distinct: DataFrame, low: float = OUTLIER_LOW,
                        high: float = OUTLIER_HIGH) -> DataFrame:
    """CL3-CL5 over the (date-parsed) distinct rows: the same rows as ``clean_flights``."""
    return (distinct.drop(COPY_COUNT, SPELLINGS)
                    .transform(drop_cancelled_and_diverted)
                    .transform(drop_missing_delays)
                    .transform(lambda d: remove_delay_outliers(d, low, high)))


def duplicate_stats(df: DataFrame, distinct: DataFrame | None = None) -> DataFrame:
    """CL9: total_rows, distinct_rows, duplicate_rows in one pass.

    ``distinct`` (``distinct_counts(df)``, e.g. already written) skips the shuffle.
    """
    return ((distinct if distinct is not None else distinct_counts(df))
            .agg(F.coalesce(F.sum(COPY_COUNT), F.lit(0)).alias("total_rows"),
                 F.coalesce(F.sum(SPELLINGS), F.lit(0)).alias("distinct_rows"))
            .withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_rows")))


# Cleaning waterfall step names.
WATERFALL_STEPS = ["start", "parse dates", "drop duplicates", "drop cancelled/diverted",
                   "drop missing delays", "remove outliers"]


def cleaning_waterfall(df: DataFrame, low: float = OUTLIER_LOW, high: float = OUTLIER_HIGH,
                       distinct: DataFrame | None = None) -> DataFrame:
    """CL10 + WN1: rows left after each cleaning step, and rows each step removed.

    One scan: the de-duplication aggregate gives each distinct parsed row and its
    copy count; the later steps are cumulative conditional counts over it. Pass
    ``distinct`` (``distinct_counts(df)``, e.g. already written) to skip the aggregate.
    """
    d = distinct if distinct is not None else distinct_counts(df)
    c3 = F.coalesce(flew_normally(), F.lit(False))
    c4 = c3 & F.coalesce(delays_present(), F.lit(False))
    c5 = c4 & F.coalesce(delays_in_range(low, high), F.lit(False))
    total = F.coalesce(F.sum("_n"), F.lit(0))
    counts = d.agg(
        total.alias("s0"), total.alias("s1"), F.count(F.lit(1)).alias("s2"),
        F.count_if(c3).alias("s3"), F.count_if(c4).alias("s4"), F.count_if(c5).alias("s5"))
    steps = F.array(*[
        F.struct(F.lit(i).alias("step_no"), F.lit(name).alias("step"),
                 F.col(f"s{i}").cast("bigint").alias("rows"))
        for i, name in enumerate(WATERFALL_STEPS)])
    long = counts.select(F.inline(steps))
    # six rows: a single-partition window is the natural tool here
    w = Window.orderBy("step_no")
    return long.withColumn("removed", F.lag("rows").over(w) - F.col("rows"))


def numeric_summary(df: DataFrame, cols: Sequence[str] = DESCRIBE_COLUMNS,
                    digits: int = 4) -> DataFrame:
    """CL11: count, mean, sample stddev, min, max per column, long, one pass."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).cast("double").alias(f"lo{i}"),
                 F.max(x).cast("double").alias(f"hi{i}")]
    wide = df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("count"),
                 F.round(F.col(f"m{i}"), digits).alias("mean"),
                 stable_round(F.col(f"s{i}"), digits).alias("stddev"),
                 F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
        for i, c in enumerate(cols)])
    return wide.select(F.inline(rows))
