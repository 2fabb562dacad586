import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tarmac.session import local_session
    s = local_session("*", shuffle_partitions=8, app="tarmac-tests")
    yield s
    s.stop()


def flight_rows(spark, rows):
    """A flight-schema DataFrame from dicts (missing columns are NULL)."""
    from tarmac.schema import FLIGHT_SCHEMA
    full = [tuple(r.get(f.name) for f in FLIGHT_SCHEMA.fields) for r in rows]
    return spark.createDataFrame(full, FLIGHT_SCHEMA)
