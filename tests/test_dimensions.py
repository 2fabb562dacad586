"""Dimension files in a fixed schema, unique keys before a join, rejected cells of flight files."""

import tempfile

import pytest
from conftest import SF001

from tarmac.operators.joins import attach_coords, attach_state_codes
from tarmac.schema import FLIGHT_COLUMNS
from tarmac.sources.dims import read_dimension, unique_by, us_state_codes
from tarmac.sources.flights import load_flights, rejected_cells, save_table
from tarmac.sources.store import flight_tables


def _file(text):
    path = tempfile.mkdtemp(prefix="tarmac-dim-") + "/a.csv"
    with open(path, "w") as f:
        f.write(text)
    return path


def test_coordinates_have_numbers(spark):
    good = read_dimension(spark, _file("code,name,lat,lon\nAA,Alpha,1.5,-2\n"))
    assert good.schema.simpleString() == "struct<code:string,name:string,lat:double,lon:double>"
    assert good.first().lat == 1.5
    with pytest.raises(Exception):
        read_dimension(spark, _file("code,name,lat,lon\nAA,Alpha,north,-2\n")).collect()
    with pytest.raises(Exception):
        read_dimension(spark, _file("code,name,lon,lat\nAA,Alpha,1,-2\n")).collect()


def test_repeated_codes_raise_or_give_their_least_row(spark):
    dim = spark.createDataFrame([("A", "x", 1.0, 2.0), ("A", "x", 1.0, 2.0), ("B", "y", 3.0, 4.0), ("B", "a", 9.0, 9.0), (None, "n", 0.0, 0.0)],
                                "code string, name string, lat double, lon double")
    flights = spark.createDataFrame([("A",), ("B",), ("B",), (None,), ("C",)], "origin string")
    rows = attach_coords(flights, dim, on_repeat="least").orderBy("origin").collect()
    assert [(r.origin, r.airport_name) for r in rows] == [("A", "x"), ("B", "a"), ("B", "a")]
    with pytest.raises(Exception, match="repeated code"):
        attach_coords(flights, dim).collect()
    assert attach_coords(flights, dim.filter("code = 'A'")).count() == 1  # equal rows are no conflict
    with pytest.raises(ValueError):
        unique_by(dim, "code", "any")


def test_us_state_codes_join(spark):
    df = spark.createDataFrame([("Texas",), ("Nowhere",)], "origin_state_nm string")
    assert [r.code for r in attach_state_codes(df, us_state_codes(spark)).collect()] == ["TX"]
    assert attach_state_codes(df, us_state_codes(spark), keep_unmatched=True).count() == 2


def _line(**cells):
    return ",".join(cells.get(c, "") for c in FLIGHT_COLUMNS)


def test_rejected_cells_know_their_lines(spark):
    folder = tempfile.mkdtemp(prefix="tarmac-rejects-")
    for name, lines in {"a": [_line(month="1"), _line(month="x", dep_delay="n/a"), _line(month="12.0"), _line(month="1.5")],
                        "b": [_line(cancelled="99999999999", origin="any text")]}.items():
        with open(f"{folder}/{name}.csv", "w") as f:
            f.write("\n".join([",".join(FLIGHT_COLUMNS), *lines]) + "\n")
    got = sorted((r.file[-5], r.line, r.column, r.text) for r in rejected_cells(spark, folder).collect())
    assert got == [("a", 2, "dep_delay", "n/a"), ("a", 2, "month", "x"), ("a", 4, "month", "1.5"), ("b", 1, "cancelled", "99999999999")]
    assert sorted(str(r.month) for r in load_flights(spark, folder).collect()) == ["1", "12", "None", "None", "None"]


def test_lines_count_over_the_blocks_of_a_file(spark):
    folder = tempfile.mkdtemp(prefix="tarmac-blocks-") + "/csv"
    lines = [_line(month="x" if i % 50 == 7 else "1", origin=f"N{i}") for i in range(3000)]
    path = _file("\n".join([",".join(FLIGHT_COLUMNS), *lines]) + "\n")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "8192")
    try:
        got = sorted(r.line for r in rejected_cells(spark, path).collect())
    finally:
        spark.conf.set(key, before)
    assert got == [i + 1 for i in range(3000) if i % 50 == 7] and folder


def test_clean_files_reject_nothing(spark):
    folder = tempfile.mkdtemp(prefix="tarmac-clean-") + "/csv"
    save_table(flight_tables(spark, SF001).raw, folder)
    assert rejected_cells(spark, folder).count() == 0
