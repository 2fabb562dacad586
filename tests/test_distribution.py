"""Percentiles, histogram and box statistics against brute force."""

import numpy as np
from conftest import SF01

from tarmac.operators import distribution as D
from tarmac.sources.store import flight_tables


def _values(spark, vals, groups=None):
    groups = groups or ["g"] * len(vals)
    return spark.createDataFrame(list(zip(groups, vals)), "season string, arr_delay double")


def test_percentiles_exact_match_rank_rule(spark):
    vals = [float(v) for v in [5, -3, 12, 40, 7, 7, 100, -20, 0, 15, 33]]
    got = {r.percentile: r.minutes for r in D.percentiles(_values(spark, vals)).collect()}
    s = sorted(vals)
    for p, lab in zip(D.PERCENTILES, D.PERCENTILE_LABELS):
        # smallest value whose cumulative share reaches p
        k = next(i for i in range(len(s)) if (i + 1) / len(s) >= p - 1e-12)
        assert got[lab] == s[k], lab


def test_percentiles_monotone_on_fixture(spark):
    df = flight_tables(spark, SF01).featured
    got = {r.percentile: r.minutes for r in D.percentiles(df).collect()}
    seq = [got[lab] for lab in D.PERCENTILE_LABELS]
    assert seq == sorted(seq)


def test_sketches_merge_to_answers_within_the_bound(spark):
    df = flight_tables(spark, SF01).featured
    days = D.sketch_values(df, "arr_delay", ["op_unique_carrier", "fl_date"])
    points = dict(zip(D.PERCENTILE_LABELS, D.PERCENTILES))
    rows = D.with_rank_error(D.percentiles_of(D.merged_sketches(days), points), df, "arr_delay").collect()
    assert len(rows) == 7 and all(r.within_bound and r.rank_error <= D.RANK_BOUND for r in rows)
    assert {r.flights for r in rows} == {df.count()}
    by = ["op_unique_carrier"]
    each = D.with_rank_error(D.percentiles_of(D.merged_sketches(days, by), points, by), df, "arr_delay", by)
    assert each.filter("within_bound").count() == each.count() == 7 * 12
    # a value that is not in the data, and one that is far off
    wrong = spark.createDataFrame([("P50", 0.5, 0.25), ("P50", 0.5, 500.0)], "percentile string, p double, minutes double")
    assert not any(r.within_bound for r in D.with_rank_error(wrong, df, "arr_delay").collect())


def test_one_scan_and_no_object_aggregate(spark):
    from tarmac.operators.score import scorecard
    df = flight_tables(spark, SF01).featured
    for out in (D.percentiles(df), D.group_percentiles(df), D.box_stats(df), scorecard(df)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "ObjectHashAggregate" not in plan and "Join" not in plan


def test_percentiles_of_nulls_and_nothing(spark):
    empty = _values(spark, [None, None])
    assert {r.minutes for r in D.percentiles(empty).collect()} == {None}
    assert D.box_stats(empty).collect() == []
    assert {r.minutes for r in D.percentiles(_values(spark, [1.0, 2.0]).limit(0)).collect()} == {None}


def test_histogram_bins_and_range(spark):
    df = _values(spark, [-61.0, -60.0, -1.0, 0.0, 14.0, 15.0, 254.0, 255.0])
    got = {r.bin: r.flights for r in D.binned_counts(df).collect()}
    # -61 falls in bin -75 (dropped), 255 in bin 255 (dropped)
    assert got == {-60: 1, -15: 1, 0: 2, 15: 1, 240: 1}


def test_histogram_wide_range_sums_to_rows(spark):
    df = flight_tables(spark, SF01).featured
    rows = D.binned_counts(df, low=-10_000, high=10_000).collect()
    assert sum(r.flights for r in rows) == df.filter("arr_delay IS NOT NULL").count()


def test_box_stats_brute_force(spark):
    rng = np.random.default_rng(7)
    a = rng.integers(-30, 60, 200).astype(float).tolist() + [500.0, -200.0]
    b = rng.integers(0, 10, 50).astype(float).tolist()
    groups = ["A"] * len(a) + ["B"] * len(b) + [None] * 5
    vals = a + b + [1.0] * 5
    df = _values(spark, vals, groups)
    got = {r.season: r for r in D.box_stats(df, "season", "arr_delay").collect()}
    assert set(got) == {"A", "B"}
    for g, xs in (("A", a), ("B", b)):
        x = np.array(xs)
        q1, med, q3 = np.percentile(x, [25, 50, 75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = x[(x >= lo) & (x <= hi)]
        r = got[g]
        assert (r.q1, r.median, r.q3) == (round(q1, 4), round(med, 4), round(q3, 4))
        assert (r.lower_whisker, r.upper_whisker) == (inside.min(), inside.max())
        assert r.n_outliers == int(((x < lo) | (x > hi)).sum())
        assert r.n == len(xs)


def test_box_stats_top_groups(spark):
    df = _values(spark, [1.0] * 6, ["a", "a", "a", "b", "b", "c"])
    assert [r.season for r in D.box_stats(df, max_groups=2).collect()] == ["a", "b"]


def test_group_percentiles_having(spark):
    df = _values(spark, [1.0, 2.0, 3.0, 10.0], ["x", "x", "x", "y"])
    df = df.withColumnRenamed("season", "op_unique_carrier")
    out = D.group_percentiles(df, min_flights=2).collect()
    assert [(r.op_unique_carrier, r.flights, r.median_delay, r.p90_delay) for r in out] == [
        ("x", 3, 2.0, 3.0)]


def test_describe(spark):
    r = D.value_summary(_values(spark, [1.0, 2.0, 3.0, None])).first()
    assert (r["count"], r.mean, r.stddev, r["min"], r["max"]) == (3, 2.0, 1.0, 1.0, 3.0)
