"""Delay breakdowns, grouping-set summary, causes and cancellations."""

from conftest import SF01, flight_rows
from pyspark.sql import functions as F

from tarmac.functions.derive import add_features
from tarmac.operators import summarize as S
from tarmac.sources.store import flight_tables


def _featured(spark):
    rows = [
        dict(op_unique_carrier="AA", origin="X", dest="Y", month=1, day_of_week=6,
             crs_dep_time=2300, distance=300.0, dep_delay=10.0, arr_delay=20.0,
             carrier_delay=10, weather_delay=0, nas_delay=10, security_delay=0,
             late_aircraft_delay=0, cancelled=0, diverted=0),
        dict(op_unique_carrier="AA", origin="X", dest="Z", month=1, day_of_week=1,
             crs_dep_time=800, distance=1300.0, dep_delay=-5.0, arr_delay=-10.0,
             cancelled=0, diverted=0),
        dict(op_unique_carrier="BB", origin=None, dest="Y", month=2, day_of_week=2,
             crs_dep_time=1200, distance=700.0, dep_delay=70.0, arr_delay=65.0,
             carrier_delay=30, weather_delay=35, nas_delay=0, security_delay=0,
             late_aircraft_delay=0, cancelled=0, diverted=0),
    ]
    return add_features(flight_rows(spark, rows))


def test_delay_summary_values(spark):
    out = {r.op_unique_carrier: r for r in S.breakdown(_featured(spark), "airline").collect()}
    aa = out["AA"]
    assert (aa.flights, aa.avg_arr_delay, aa.avg_dep_delay) == (2, 5.0, 2.5)
    assert (aa.delayed_pct, aa.big_delay_pct, aa.early_pct) == (50.0, 0.0, 50.0)
    assert out["BB"].big_delay_pct == 100.0


def test_null_key_is_a_group_and_having(spark):
    df = _featured(spark)
    keys = {r.origin for r in S.breakdown(df, "origin").collect()}
    assert keys == {"X", None}
    assert {r.origin for r in S.breakdown(df, "origin", 2).collect()} == {"X"}


def test_weekend_and_redeye_labels(spark):
    df = _featured(spark)
    wk = {r.is_weekend: r.kind for r in S.breakdown(df, "weekend").collect()}
    assert wk == {1: "Weekend", 0: "Weekday"}
    re = {r.is_redeye: r.kind for r in S.breakdown(df, "redeye").collect()}
    assert re == {1: "Red-eye", 0: "Daytime"}


def test_all_dimensions_equal_single_breakdowns(spark):
    df = flight_tables(spark, SF01).featured
    allx = S.all_breakdowns(df)
    for name, col in [("airline", "op_unique_carrier"), ("hour", "dep_hour"), ("route", "route")]:
        one = S.delay_summary(df, col).select(F.col(col).cast("string").alias("key"),
                                              *S.SUMMARY_COLUMNS)
        part = allx.filter(F.col("dimension") == name).drop("dimension")
        assert sorted(one.collect()) == sorted(part.collect())


def test_all_dimensions_keeps_null_keys_apart(spark):
    df = _featured(spark)
    out = S.all_breakdowns(df, ["origin", "dest"])
    rows = {(r.dimension, r.key): r.flights for r in out.collect()}
    assert rows[("origin", None)] == 1 and rows[("origin", "X")] == 2
    assert rows[("dest", "Y")] == 2


def test_cause_tables(spark):
    df = _featured(spark)
    tot = {r.cause: (r.minutes, r.share_pct) for r in S.causes_long(S.per_cause(df, S.minutes), "minutes").withColumn("share_pct", S.share_of_total("minutes")).collect()}
    assert tot["carrier_delay"] == (40, 47.06)
    freq = {r.cause: r.pct_of_flights for r in S.causes_long(S.per_cause(df, S.share_of_recorded), "pct_of_flights").collect()}
    # recorded denominator: 2 flights have causes recorded, both with carrier minutes
    assert freq["carrier_delay"] == 100.0 and freq["weather_delay"] == 50.0
    freq_all = {r.cause: r.pct_of_flights
                for r in S.causes_long(S.per_cause(df, S.share_of_all), "pct_of_flights").collect()}
    assert freq_all["carrier_delay"] == 66.67
    stacked = S.stacked(S.causes_long(S.per_cause(df, S.minutes, ["month"]), "minutes", ["month"]), "minutes", ["month"]).filter("month = 1").orderBy("cause_no").collect()
    assert [r.stack_base for r in stacked] == [0, 10, 10, 20, 20]


def test_bands_share_sums_to_100(spark):
    df = flight_tables(spark, SF01).featured
    rows = S.band_counts(df).collect()
    assert sum(r.flights for r in rows) == df.count()
    assert abs(sum(r.share_pct for r in rows) - 100.0) < 0.05
    assert len(rows) == 5


def test_cancellations_parts_sum(spark):
    raw = flight_tables(spark, SF01).raw
    total = raw.filter("cancelled = 1").count()
    assert sum(r.cancellations for r in S.counts_where(raw, "cancelled", "cancellation_code", "cancellations").collect()) == total
    ov = S.rates(raw, count="total_flights").first()
    assert ov.total_flights == 61176
    by_air = S.rates(raw, ["op_unique_carrier"], worst_first=True).collect()
    assert sum(r.flights for r in by_air) == 61176
