"""Cleaning chain, quality reports and the one-pass waterfall."""

import datetime as dt

from conftest import SF01, flight_rows

from tarmac.operators import quality as Q


def _edge_rows(spark):
    base = dict(year=2024, month=1, fl_date="2024-01-05", op_unique_carrier="AA", origin="X",
                dest="Y", cancelled=0, diverted=0, dep_delay=0.0, arr_delay=0.0)
    rows = [
        base,                                            # kept
        dict(base),                                      # exact duplicate
        dict(base, dep_delay=-120.0, arr_delay=1440.0),  # both on the inclusive bounds
        dict(base, dep_delay=-121.0),                    # outlier
        dict(base, arr_delay=1441.0),                    # outlier
        dict(base, cancelled=1, dep_delay=None, arr_delay=None),
        dict(base, diverted=1, arr_delay=None),
        dict(base, cancelled=None, dep_delay=3.0),       # NULL flag fails the filter
        dict(base, arr_delay=None, dep_delay=4.0),       # missing delay
        dict(base, fl_date="not a date", dep_delay=5.0),  # bad date -> NULL, kept
    ]
    return flight_rows(spark, rows)


def test_clean_flights_edges(spark):
    out = Q.clean_flights(_edge_rows(spark)).collect()
    assert len(out) == 3
    dates = sorted((r.fl_date is None, r.dep_delay) for r in out)
    assert dates == [(False, -120.0), (False, 0.0), (True, 5.0)]
    assert any(r.fl_date == dt.date(2024, 1, 5) for r in out)


def test_waterfall_equals_chained_steps(spark):
    df = _edge_rows(spark)
    got = {r.step: (r.rows, r.removed) for r in Q.cleaning_waterfall(df).collect()}
    d = Q.parse_dates(df)
    expect = [df.count(), d.count()]
    d = Q.drop_duplicates(d); expect.append(d.count())
    d = Q.drop_cancelled_and_diverted(d); expect.append(d.count())
    d = Q.drop_missing_delays(d); expect.append(d.count())
    d = Q.remove_delay_outliers(d); expect.append(d.count())
    assert [got[s][0] for s in Q.WATERFALL_STEPS] == expect
    assert got["start"][1] is None
    assert got["drop duplicates"][1] == 1


def test_waterfall_matches_on_fixture(spark):
    from tarmac.sources.store import flight_tables
    raw = flight_tables(spark, SF01).raw
    rows = [r.rows for r in Q.cleaning_waterfall(raw).orderBy("step_no").collect()]
    assert rows == [61176, 61176, 60000, 58512, 57588, 57355]


def test_null_profile_and_duplicates(spark):
    df = _edge_rows(spark)
    nulls = {r.column_name: r.null_count for r in Q.missing_value_long(df).collect()}
    assert nulls["arr_delay"] == 3 and nulls["cancelled"] == 1 and nulls["dest"] == 0
    assert len(nulls) == 35
    d = Q.duplicate_stats(df).first()
    assert (d.total_rows, d.distinct_rows, d.duplicate_rows) == (10, 9, 1)


def test_profile_and_describe(spark):
    df = _edge_rows(spark)
    p = Q.table_profile(df).first()
    assert (p.rows, p.columns) == (10, 35)
    s = {r.column_name: r for r in Q.numeric_summary(df).collect()}
    assert s["dep_delay"]["count"] == 9 and s["dep_delay"]["min"] == -121.0
    assert s["distance"]["count"] == 0 and s["distance"]["mean"] is None


def test_empty_input(spark):
    df = flight_rows(spark, [])
    assert Q.clean_flights(df).count() == 0
    assert [r.rows for r in Q.cleaning_waterfall(df).orderBy("step_no").collect()] == [0] * 6


def test_distinct_rows_merge_when_texts_parse_alike(spark):
    base = dict(year=2024, month=1, op_unique_carrier="AA", cancelled=0, diverted=0,
                dep_delay=1.0, arr_delay=1.0)
    texts = ["junk", "other junk", None, "2024-01-05", "2024-01-05", "2024-01-06"]
    df = flight_rows(spark, [dict(base, fl_date=t) for t in texts])
    got = sorted((str(r.fl_date), r[Q.COPY_COUNT], r[Q.SPELLINGS]) for r in Q.distinct_counts(df).collect())
    assert got == [("2024-01-05", 2, 1), ("2024-01-06", 1, 1), ("None", 3, 3)]
    d = Q.duplicate_stats(df).first()
    assert (d.total_rows, d.distinct_rows, d.duplicate_rows) == (6, df.distinct().count(), 1)
    assert Q.clean_from_distinct(Q.distinct_counts(df)).count() == Q.clean_flights(df).count() == 3


def test_strict_date_parse_raises_lenient_gives_null(spark):
    import pytest
    df = flight_rows(spark, [dict(fl_date="2024-13-45")])
    assert Q.parse_dates(df).first().fl_date is None
    with pytest.raises(Exception):
        Q.parse_dates(df, strict=True).collect()
