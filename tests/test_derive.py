"""Derived columns: band edges, NULL through CASE chains, hour 24, routes, bins."""

from pyspark.sql import functions as F

from tarmac.functions import bands as B
from tarmac.functions import derive as D


def _one(spark, expr, values, dtype="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_delay_band_edges_and_null(spark):
    got = _one(spark, lambda c: B.band(c, B.DELAY_BAND_BOUNDS, B.DELAY_BAND_LABELS),
               [-1.0, 0.0, 14.0, 15.0, 59.0, 60.0, 179.0, 180.0, None])
    assert got == ["Early", "On time", "On time", "Minor (15-60m)", "Minor (15-60m)",
                   "Major (1-3h)", "Major (1-3h)", "Severe (3h+)", "Severe (3h+)"]


def test_dep_band_first_bound_inclusive(spark):
    got = _one(spark, lambda c: B.band(c, B.DEP_BAND_BOUNDS, B.DEP_BAND_LABELS, first_inclusive=True),
               [0.0, 0.5, 15.0, 119.0, 120.0, None])
    assert got == ["On time / early", "1-15 late", "15-30 late", "60-120 late", "120+ late",
                   "120+ late"]


def test_band_rejects_bad_labels():
    import pytest
    with pytest.raises(ValueError):
        B.band(F.col("x"), [1, 2], ["a", "b"])


def test_fixed_bin_floors_negative(spark):
    assert _one(spark, lambda c: B.fixed_bin(c, 15), [-1.0, 0.0, 14.9, 15.0, -15.0, -16.0]) == \
        [-15, 0, 0, 15, -15, -30]


def test_dep_hour_truncates_and_keeps_24(spark):
    assert _one(spark, D.dep_hour, [0, 59, 100, 1859, 2359, 2400, None], "int") == \
        [0, 0, 1, 18, 23, 24, None]


def test_time_buckets(spark):
    df = spark.createDataFrame([(5,), (600,), (1159,), (1200,), (2100,), (2200,), (2400,), (None,)],
                               "crs_dep_time int")
    rows = D.add_time_buckets(df).collect()
    assert [r.day_part for r in rows] == ["Night (0-6)", "Morning (6-12)", "Morning (6-12)",
                                          "Afternoon (12-17)", "Late (21-24)", "Late (21-24)",
                                          "Late (21-24)", "Late (21-24)"]
    assert [r.is_redeye for r in rows] == [1, 0, 0, 0, 0, 1, 1, None]


def test_calendar_features(spark):
    df = spark.createDataFrame([(1, 12), (5, 3), (6, 6), (7, 9), (None, None)],
                               "day_of_week int, month int")
    rows = D.add_calendar_features(df).collect()
    assert [r.is_weekend for r in rows] == [0, 0, 1, 1, None]
    assert [r.season for r in rows] == ["Winter", "Spring", "Summer", "Autumn", "Autumn"]
    assert [r.dow_name for r in rows] == ["Mon", "Fri", "Sat", "Sun", "Sun"]


def test_flags_null_stays_null(spark):
    df = spark.createDataFrame([(20.0, 15.0), (5.0, -1.0), (70.0, 60.0), (None, None)],
                               "dep_delay double, arr_delay double")
    rows = D.add_delay_flags(df).collect()
    assert [(r.is_delayed, r.is_early, r.is_on_time, r.is_big_delay) for r in rows] == [
        (1, 0, 0, 0), (0, 1, 1, 0), (1, 0, 0, 1), (None, None, None, None)]
    assert [r.made_up_time for r in rows] == [5.0, 6.0, 10.0, None]


def test_route_skips_null_end(spark):
    df = spark.createDataFrame([("A", "B"), ("A", None), (None, "B")], "origin string, dest string")
    assert [r.route for r in D.add_route(df).collect()] == ["A-B", "A", "B"]


def test_distance_and_cause_flags(spark):
    df = spark.createDataFrame([(249.0, 0), (250.0, 5), (1200.0, None), (None, 1)],
                               "distance double, carrier_delay int")
    rows = D.add_distance_buckets(df).collect()
    assert [r.distance_band for r in rows] == ["Very short (<250mi)", "Short (250-600)",
                                               "Long (1200-2500)", "Very long (2500+)"]
    assert [r.is_longhaul for r in rows] == [0, 0, 1, None]
    flags = D.add_cause_flags(df, ["carrier_delay"]).collect()
    assert [r.has_carrier_delay for r in flags] == [0, 1, None, 1]
