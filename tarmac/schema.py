"""Flight table layout: the fixed 35-column schema, column groups and checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

# The flight table layout (name, type) in file order.
_LAYOUT = [
    ("year", "int"), ("month", "int"), ("day_of_month", "int"), ("day_of_week", "int"),
    ("fl_date", "string"), ("op_unique_carrier", "string"), ("op_carrier_fl_num", "double"),
    ("origin", "string"), ("origin_city_name", "string"), ("origin_state_nm", "string"),
    ("dest", "string"), ("dest_city_name", "string"), ("dest_state_nm", "string"),
    ("crs_dep_time", "int"), ("dep_time", "double"), ("dep_delay", "double"),
    ("taxi_out", "double"), ("wheels_off", "double"), ("wheels_on", "double"),
    ("taxi_in", "double"), ("crs_arr_time", "int"), ("arr_time", "double"),
    ("arr_delay", "double"), ("cancelled", "int"), ("cancellation_code", "string"),
    ("diverted", "int"), ("crs_elapsed_time", "double"), ("actual_elapsed_time", "double"),
    ("air_time", "double"), ("distance", "double"), ("carrier_delay", "int"),
    ("weather_delay", "int"), ("nas_delay", "int"), ("security_delay", "int"),
    ("late_aircraft_delay", "int"),
]

_TYPES = {"int": IntegerType(), "double": DoubleType(), "string": StringType()}

FLIGHT_SCHEMA = StructType([StructField(n, _TYPES[t], True) for n, t in _LAYOUT])
FLIGHT_COLUMNS = [n for n, _ in _LAYOUT]

# The five delay-cause minute columns, in reporting order.
CAUSES = ["carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay"]

# Columns known only after departure; a delay predictor must not use them.
POST_DEPARTURE = [
    "dep_time", "dep_delay", "taxi_out", "wheels_off", "wheels_on", "taxi_in", "arr_time",
    "arr_delay", "cancelled", "cancellation_code", "diverted", "actual_elapsed_time",
    "air_time", "carrier_delay", "weather_delay", "nas_delay", "security_delay",
    "late_aircraft_delay", "is_delayed", "is_early", "is_on_time", "is_big_delay",
    "made_up_time", "delay_band", "has_carrier_delay", "has_weather_delay", "has_nas_delay",
    "has_security_delay", "has_late_aircraft_delay",
]


def existing_columns(df: DataFrame, wanted: Iterable[str], *, required: bool = False) -> list[str]:
    """Keep the wanted columns that ``df`` has, in the wanted order.

    With ``required=True`` a missing column raises instead of being skipped.
    """
    have = set(df.columns)
    wanted = list(wanted)
    missing = [c for c in wanted if c not in have]
    if required and missing:
        raise ValueError(f"missing required columns: {missing}")
    return [c for c in wanted if c in have]


def check_pre_departure(features: Iterable[str]) -> None:
    """Fail when a model feature is only known after the flight has left."""
    leaked = [c for c in features if c in POST_DEPARTURE]
    if leaked:
        raise ValueError(f"post-departure columns cannot be model features: {leaked}")
