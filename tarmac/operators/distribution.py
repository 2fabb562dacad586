"""Distribution tables read off one value histogram (AD1-AD4, VZ1), and mergeable sketches.

``value_counts`` groups a table by (group, value) into counts, with a map-side partial step,
so a group that holds a third of all rows ships one row per distinct value and task.
``ranked`` puts the running count beside every value; quartiles, percentiles, fences and
whiskers of all groups are conditional aggregates over that. The facts are scanned once,
sorts spill, and no aggregate keeps a map or an array of values. One group's distinct values
(about 1,600 for minute delays inside the outlier window) are ranked in one task, so
measures with unbounded distinct values belong to the sketches: ``sketch_values`` stores a KLL
sketch per group and day, ``merged_sketches`` merges any of them later, and
``percentiles_of`` reads them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.bands import fixed_bin
from tarmac.functions.numeric import stable_round

# Reported percentile points and their labels.
PERCENTILES = [0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99]
PERCENTILE_LABELS = ["P10", "P25", "P50", "P75", "P90", "P95", "P99"]

ROWS, UP_TO, TOTAL = "_rows", "_up_to", "_total"


def value_counts(df: DataFrame, value: str, by: Sequence[str] = (), extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows of each (group, value), with further additive aggregates; NULL is a value too."""
    return df.groupBy(*by, value).agg(F.count(F.lit(1)).alias(ROWS), *[c.alias(n) for n, c in (extra or {}).items()])


def ranked(counts: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """The counts with the rows at or below each value and the rows of the group, NULL values apart
    (both 0 or the group's for a NULL value)."""
    n = F.when(F.col(value).isNotNull(), F.col(ROWS)).otherwise(0)
    group = Window.partitionBy(*by)
    return counts.withColumns({UP_TO: F.sum(n).over(group.orderBy(F.asc_nulls_first(value))), TOTAL: F.sum(n).over(group)})


def _at_rank(value: str, rank: Column) -> Column:
    """The value of the rank-th row (from 1) in order, as an aggregate over ranked counts."""
    return F.min(F.when(F.col(UP_TO) >= rank, F.col(value)))


def smallest_reaching(value: str, p: float) -> Column:
    """Quantile: the smallest value whose cumulative share reaches ``p`` (``percentile_disc``)."""
    total = F.col(TOTAL)
    return _at_rank(value, F.greatest(F.lit(1), total - F.floor(total - p * total)))


def _between_rows(value: str, p: float, group) -> Column:
    """Quantile between the two rows around position p * (n - 1), linearly (``percentile``), beside
    every value of the group."""
    position = p * (F.col(TOTAL) - 1)
    low, high = (_at_rank(value, step(position) + 1).over(group) for step in (F.floor, F.ceil))
    return low + (high - low) * (position - F.floor(position))


def value_summary(df: DataFrame, col: str = "arr_delay", digits: int = 2) -> DataFrame:
    """AD1: count, mean, sample standard deviation, min and max of a measure, one row."""
    return df.select(F.count(col).alias("count"), F.round(F.avg(col), digits).alias("mean"),
                     stable_round(F.stddev_samp(col), digits).alias("stddev"),
                     F.min(col).alias("min"), F.max(col).alias("max"))


def percentiles(df: DataFrame, col: str = "arr_delay", points: Mapping[str, float] | None = None) -> DataFrame:
    """AD2: (percentile, minutes) of a measure over the whole table, long."""
    points = points or dict(zip(PERCENTILE_LABELS, PERCENTILES))
    wide = ranked(value_counts(df, col), col).agg(
        *[smallest_reaching(col, p).cast("double").alias(name) for name, p in points.items()])
    return wide.unpivot([], list(points), "percentile", "minutes")


def binned_counts(df: DataFrame, col: str = "arr_delay", low: int = -60, high: int = 240, step: int = 15) -> DataFrame:
    """AD3: flights per bin of ``step`` whose start lies in [low, high]."""
    bins = df.withColumn("bin", fixed_bin(F.col(col), step)).filter(F.col("bin").between(low, high))
    return value_counts(bins, "bin").select("bin", F.col(ROWS).alias("flights")).orderBy("bin")


def group_percentiles(df: DataFrame, by: str = "op_unique_carrier", col: str = "arr_delay",
                      points: Mapping[str, float] | None = None, min_flights: int = 1000, digits: int = 1) -> DataFrame:
    """AD4: flights and the named percentiles of each group with ``min_flights`` rows, by the last of them."""
    points = points or {"median_delay": 0.5, "p90_delay": 0.9}
    out = ranked(value_counts(df, col, [by]), col, [by]).groupBy(by).agg(
        F.sum(ROWS).alias("flights"), *[F.round(smallest_reaching(col, p), digits).alias(name) for name, p in points.items()])
    return out.filter(F.col("flights") >= min_flights).orderBy(list(points)[-1], by)


def box_stats(df: DataFrame, group: str = "season", value: str = "arr_delay", max_groups: int = 12,
              whisker: float = 1.5, digits: int = 4) -> DataFrame:
    """VZ1: box-plot numbers of the ``max_groups`` most frequent non-NULL groups.

    Groups rank by all their rows, NULL values included; a group without values is left out.
    Quartiles interpolate; whiskers are the outermost values inside ``whisker`` x IQR of the
    box, values beyond count as outliers.
    """
    counts = ranked(value_counts(df.filter(F.col(group).isNotNull()), value, [group]), value, [group])
    whole = Window.partitionBy(group)
    quartiles = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    boxed = counts.withColumns({name: _between_rows(value, p, whole) for name, p in quartiles.items()})
    reach = whisker * (F.col("q3") - F.col("q1"))
    v = F.col(value)
    inside = v.between(F.col("q1") - reach, F.col("q3") + reach)
    out = boxed.groupBy(group).agg(
        F.sum(ROWS).alias("_all"), F.max(TOTAL).alias("n"), *[F.round(F.max(q), digits).alias(q) for q in quartiles],
        F.min(F.when(inside, v)).cast("double").alias("lower_whisker"),
        F.max(F.when(inside, v)).cast("double").alias("upper_whisker"),
        F.sum(F.when(~inside, F.col(ROWS)).otherwise(0)).alias("n_outliers"))
    return (out.orderBy(F.desc("_all"), group).limit(max_groups).drop("_all").filter(F.col("n") > 0)
            .orderBy(F.desc("n"), group))


# --- sketches --------------------------------------------------------------------

SKETCH_K = 400  # a KLL sketch of this size is off by at most about 0.7 % of the rows in rank
RANK_BOUND = 0.01  # what the approximate percentiles promise


def sketch_values(df: DataFrame, value: str, keys: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """A KLL sketch of a measure per key (say, airline and day), of bounded size whatever the rows:
    (keys, sketch). Sketches are built map-side and merged behind the shuffle; written, they answer
    for any union of their keys without the facts."""
    return (df.filter(F.col(value).isNotNull()).groupBy(*keys)
            .agg(F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch")))


def merged_sketches(sketches: DataFrame, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """One sketch a group from the stored ones of its days."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def percentiles_of(sketches: DataFrame, points: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """(group, percentile, p, minutes) read from one sketch a group, long."""
    rows = F.array(*[F.struct(F.lit(name).alias("percentile"), F.lit(float(p)).alias("p"),
                              F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("minutes"))
                     for name, p in points.items()])
    return sketches.select(*by, F.inline(rows))


def with_rank_error(answers: DataFrame, df: DataFrame, value: str, by: Sequence[str] = (), bound: float = RANK_BOUND) -> DataFrame:
    """The answers with the group's rows, their exact ``rank_error`` and whether that is within ``bound``.

    A sketch answers with a value of the data, whose ranks run from the share of rows below it to
    the share at or below it; the error is how far ``p`` lies outside. A value that is not in the
    data has no error and is not within the bound.
    """
    counts = value_counts(df.filter(F.col(value).isNotNull()), value, list(by))
    at, rows, total = F.col(UP_TO), F.col(ROWS), F.col(TOTAL)
    ranks = ranked(counts, value, list(by)).select(*by, F.col(value).cast("double").alias("minutes"), total.alias("flights"),
                                                   ((at - rows) / total).alias("_from"), (at / total).alias("_to"))
    error = F.greatest(F.lit(0.0), F.col("_from") - F.col("p"), F.col("p") - F.col("_to"))
    return (answers.join(ranks, [*by, "minutes"], "left")
            .withColumn("rank_error", F.when(F.col("_to").isNotNull(), error))
            .withColumn("within_bound", F.coalesce(F.col("rank_error") <= bound, F.lit(False))).drop("_from", "_to"))
