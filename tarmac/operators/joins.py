"""Dimension joins (JN2, JN3). No hints: the planner broadcasts a side only below its byte
threshold, and AQE only when the size at run time allows it. A dimension is reduced to one row
a key before the join (``dims.unique_by``)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.sources.dims import unique_by


def attach(df: DataFrame, dimension: DataFrame, key: str, column: str, adds: Mapping[str, str],
           how: str = "inner", on_repeat: str = "raise") -> DataFrame:
    """Join ``dimension`` on its ``key`` to ``column`` and add its columns under new names
    (``adds``: dimension column -> result column). ``how="left"`` keeps rows without a match."""
    slim = unique_by(dimension.select(key, *adds), key, on_repeat)
    return df.join(slim.select(F.col(key).alias(column), *[F.col(c).alias(n) for c, n in adds.items()]), column, how)


def attach_coords(df: DataFrame, coords: DataFrame, code_col: str = "origin", on_repeat: str = "raise") -> DataFrame:
    """JN2: adds ``airport_name, lat, lon``; codes without coordinates are dropped, as a map cannot
    place them. ``coords`` has columns ``code, name, lat, lon``."""
    return attach(df, coords, "code", code_col, {"name": "airport_name", "lat": "lat", "lon": "lon"}, on_repeat=on_repeat)


def attach_state_codes(df: DataFrame, states: DataFrame, state_col: str = "origin_state_nm",
                       keep_unmatched: bool = False, on_repeat: str = "raise") -> DataFrame:
    """JN3: state name -> short code. Unmatched names are dropped (or kept as NULL)."""
    return attach(df, states, "state", state_col, {"code": "code"}, "left" if keep_unmatched else "inner", on_repeat)
