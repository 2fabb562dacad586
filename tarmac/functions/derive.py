"""Row-local derived columns (FE1-FE20). All are built-in Catalyst expressions.

Boolean flags are ``(test).cast("int")``: NULL in, NULL out. Labels come from CASE
chains, which send NULL to their last label. Both are the reference semantics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.bands import (
    DAY_PART_BOUNDS, DAY_PART_LABELS, DELAY_BAND_BOUNDS, DELAY_BAND_LABELS,
    DISTANCE_BAND_BOUNDS, DISTANCE_BAND_LABELS, DOW_NAMES, SEASON_MONTHS, SEASON_OTHER, band,
)
from tarmac.schema import CAUSES

# Lateness thresholds in minutes.
DELAYED_MIN = 15
BIG_DELAY_MIN = 60
LONGHAUL_MILES = 1200
REDEYE_FROM_HOUR = 22
REDEYE_TO_HOUR = 5
WEEKEND_DAYS = [6, 7]


def flag(test: Column) -> Column:
    return test.cast("int")


def add_delay_flags(df: DataFrame, arr: str = "arr_delay", dep: str = "dep_delay") -> DataFrame:
    """FE1-FE5: is_delayed, is_early, is_on_time, is_big_delay, made_up_time."""
    a = F.col(arr)
    return df.withColumns({
        "is_delayed": flag(a >= DELAYED_MIN),
        "is_early": flag(a < 0),
        "is_on_time": flag(a < DELAYED_MIN),
        "is_big_delay": flag(a >= BIG_DELAY_MIN),
        "made_up_time": F.col(dep) - a,
    })


def add_delay_severity(df: DataFrame, arr: str = "arr_delay") -> DataFrame:
    """FE6: delay_band."""
    return df.withColumn("delay_band", band(F.col(arr), DELAY_BAND_BOUNDS, DELAY_BAND_LABELS))


def dep_hour(hhmm: Column) -> Column:
    """FE7: hour of an hhmm clock value; 2400 gives 24 (division truncates)."""
    return (hhmm / 100).cast("int")


def add_time_buckets(df: DataFrame, sched: str = "crs_dep_time") -> DataFrame:
    """FE7-FE9: dep_hour, day_part, is_redeye."""
    df = df.withColumn("dep_hour", dep_hour(F.col(sched)))
    h = F.col("dep_hour")
    return df.withColumns({
        "day_part": band(h, DAY_PART_BOUNDS, DAY_PART_LABELS),
        "is_redeye": flag((h >= REDEYE_FROM_HOUR) | (h <= REDEYE_TO_HOUR)),
    })


def season(month: Column) -> Column:
    """FE11: season of a month number; NULL and anything unknown give Autumn."""
    expr = None
    for name, months in SEASON_MONTHS.items():
        test = month.isin(*months)
        expr = F.when(test, name) if expr is None else expr.when(test, name)
    return expr.otherwise(SEASON_OTHER)


def dow_name(day_of_week: Column) -> Column:
    """FE12: 1 -> Mon ... 6 -> Sat; anything else (NULL too) -> Sun."""
    expr = None
    for i, name in enumerate(DOW_NAMES[:-1], start=1):
        expr = F.when(day_of_week == i, name) if expr is None else expr.when(day_of_week == i, name)
    return expr.otherwise(DOW_NAMES[-1])


def add_calendar_features(df: DataFrame) -> DataFrame:
    """FE10-FE12: is_weekend, season, dow_name."""
    return df.withColumns({
        "is_weekend": flag(F.col("day_of_week").isin(*WEEKEND_DAYS)),
        "season": season(F.col("month")),
        "dow_name": dow_name(F.col("day_of_week")),
    })


def add_route(df: DataFrame, origin: str = "origin", dest: str = "dest") -> DataFrame:
    """FE13: route = origin-dest; a NULL end is skipped, leaving the other code."""
    return df.withColumn("route", F.concat_ws("-", F.col(origin), F.col(dest)))


def add_distance_buckets(df: DataFrame, distance: str = "distance") -> DataFrame:
    """FE14-FE15: distance_band, is_longhaul."""
    d = F.col(distance)
    return df.withColumns({
        "distance_band": band(d, DISTANCE_BAND_BOUNDS, DISTANCE_BAND_LABELS),
        "is_longhaul": flag(d >= LONGHAUL_MILES),
    })


def add_cause_flags(df: DataFrame, causes=CAUSES) -> DataFrame:
    """FE16: has_<cause> = cause > 0 (NULL stays NULL), in one projection."""
    return df.withColumns({f"has_{c}": flag(F.col(c) > 0) for c in causes})


def add_features(df: DataFrame) -> DataFrame:
    """FE17: every derived column, in the reference order."""
    return (df.transform(add_delay_flags)
              .transform(add_delay_severity)
              .transform(add_time_buckets)
              .transform(add_calendar_features)
              .transform(add_route)
              .transform(add_distance_buckets)
              .transform(add_cause_flags))


FEATURE_COLUMNS = [
    "is_delayed", "is_early", "is_on_time", "is_big_delay", "made_up_time", "delay_band",
    "dep_hour", "day_part", "is_redeye", "is_weekend", "season", "dow_name", "route",
    "distance_band", "is_longhaul",
] + [f"has_{c}" for c in CAUSES]


def yes_no(value: Column, yes: str, no: str) -> Column:
    """FE20: readable label of a 0/1 key; NULL goes to ``no`` like a CASE's ELSE."""
    return F.when(value == 1, yes).otherwise(no)
