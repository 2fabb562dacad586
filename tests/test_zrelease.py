"""Runs last (file order): releasing scratch tables invalidates DataFrames read from them."""

import os

from conftest import SF001


def test_release_tables_leaves_nothing_behind(spark):
    from tarmac.session import scratch_root
    from tarmac.sources import store
    before = store.flight_tables(spark, SF001).raw.count()
    folder = scratch_root(spark).replace("file:", "") + "/tarmac"
    held = os.listdir(folder)
    assert held and before > 0
    assert store.release_tables(spark) >= 2
    assert os.listdir(folder) == []
    assert store.release_tables(spark) == 0
    # tables are rebuilt on the next request
    assert store.flight_tables(spark, SF001).raw.count() == before
