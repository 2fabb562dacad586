"""File scans and sinks (CSV hazard, round trip) and the streaming breakdown."""

import tempfile

from conftest import SF001

from tarmac.operators import summarize as S
from tarmac.operators.quality import clean_flights
from tarmac.functions.derive import add_features
from tarmac.schema import FLIGHT_COLUMNS, FLIGHT_SCHEMA
from tarmac.sources.flights import load_flights, save_table
from tarmac.sources.store import flight_tables
from tarmac.streaming import clean_stream, delay_summary_stream, read_flight_stream


def _write_csv(path, lines):
    with open(path, "w") as f:
        f.write(",".join(FLIGHT_COLUMNS) + "\n")
        for ln in lines:
            f.write(ln + "\n")


def test_csv_int_columns_written_as_decimals(spark):
    d = tempfile.mkdtemp(prefix="tarmac-csv-")
    row = ["2024", "1", "5", "5", "2024-01-05", "AA", "12.0", "X", "c", "s", "Y", "c", "s",
           "1830", "1840.0", "10.0", "5.0", "1845.0", "2000.0", "4.0", "2010", "2015.0", "5.0",
           "0.0", "", "0.0", "100.0", "95.0", "80.0", "500.0", "12.0", "0.0", "0", "0", "0"]
    _write_csv(f"{d}/a.csv", [",".join(row)])
    r = load_flights(spark, d).first()
    assert r.carrier_delay == 12 and r.cancelled == 0 and r.crs_dep_time == 1830
    assert r.cancellation_code is None
    assert load_flights(spark, d).schema == FLIGHT_SCHEMA


def test_save_and_reload_round_trip(spark):
    raw = flight_tables(spark, SF001).raw
    d = tempfile.mkdtemp(prefix="tarmac-save-")
    assert save_table(raw, f"{d}/csv") is raw
    back = load_flights(spark, f"{d}/csv")
    assert sorted(back.collect()) == sorted(raw.collect())
    small = S.breakdown(flight_tables(spark, SF001).featured, "airline")
    save_table(small, f"{d}/one", single_file=True)
    assert len([p for p in __import__("os").listdir(f"{d}/one") if p.endswith(".csv")]) == 1


def test_stream_summary_equals_batch(spark):
    raw = flight_tables(spark, SF001).raw
    src = tempfile.mkdtemp(prefix="tarmac-stream-src-")
    save_table(raw.dropDuplicates(), src)
    stream = clean_stream(read_flight_stream(spark, src))
    q = (delay_summary_stream(stream, "op_unique_carrier").writeStream
         .outputMode("complete").format("memory").queryName("tarmac_stream_test")
         .option("checkpointLocation", tempfile.mkdtemp(prefix="tarmac-stream-ck-"))
         .start())
    try:
        q.processAllAvailable()
        got = spark.sql("SELECT * FROM tarmac_stream_test").orderBy("op_unique_carrier").collect()
    finally:
        q.stop()
    batch = (S.delay_summary(add_features(clean_flights(raw)), "op_unique_carrier")
             .orderBy("op_unique_carrier").collect())
    assert [tuple(r) for r in got] == [tuple(r) for r in batch]


def test_bad_integer_cells_become_null(spark):
    d = tempfile.mkdtemp(prefix="tarmac-cells-")
    line = lambda day: ",".join(["2024", "1", day, "5", "2024-01-05", "AA"] + [""] * 29)
    _write_csv(f"{d}/a.csv", [line("5"), line("NaN"), line("99999999999"), line("12.7")])
    rows = load_flights(spark, d).collect()
    assert sorted(str(r.day_of_month) for r in rows) == ["5", "None", "None", "None"]
    assert all(r.op_unique_carrier == "AA" for r in rows)


def test_corrupt_lines_kept_aside(spark):
    d = tempfile.mkdtemp(prefix="tarmac-bad-")
    good = ",".join(["2024", "1", "5", "5", "2024-01-05", "AA"] + [""] * 29)
    bad = ",".join(["2024", "oops", "5"] + [""] * 32)
    _write_csv(f"{d}/a.csv", [good, bad])
    rows = load_flights(spark, d, corrupt_col="_corrupt").collect()
    assert len(rows) == 2
    by = {r.month: r for r in rows}
    assert by[1]._corrupt is None and by[None]._corrupt.startswith("2024,oops")
    # count() alone prunes every column, so the parser never sees the bad field
    assert len(load_flights(spark, d, mode="DROPMALFORMED").collect()) == 1


def test_cli_saves_a_result_and_releases_its_tables(spark, monkeypatch):
    from tarmac import __main__, session
    monkeypatch.setattr(session, "local_session", lambda: spark)
    folder = tempfile.mkdtemp(prefix="tarmac-cli-") + "/out"
    assert __main__.main(["delay_by_season", SF001, "--save", folder]) == 0
    assert spark.read.option("header", True).csv(folder).count() == 4


def test_cli_lists_queries(capsys):
    from tarmac.__main__ import main
    assert main(["list"]) == 0
    out = capsys.readouterr().out
    assert "delay_by_airline" in out and "rows-only" in out
    assert main(["delay_by_airline", "--sql"]) == 0
    assert "GROUP BY op_unique_carrier" in capsys.readouterr().out

