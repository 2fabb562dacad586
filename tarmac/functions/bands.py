"""Right-open band labelling built from bounds, plus the fixed band label sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band bounds and labels (labels are part of every result table).
DELAY_BAND_BOUNDS = [0, 15, 60, 180]
DELAY_BAND_LABELS = ["Early", "On time", "Minor (15-60m)", "Major (1-3h)", "Severe (3h+)"]

DAY_PART_BOUNDS = [6, 12, 17, 21]
DAY_PART_LABELS = ["Night (0-6)", "Morning (6-12)", "Afternoon (12-17)", "Evening (17-21)",
                   "Late (21-24)"]

DISTANCE_BAND_BOUNDS = [250, 600, 1200, 2500]
DISTANCE_BAND_LABELS = ["Very short (<250mi)", "Short (250-600)", "Medium (600-1200)",
                        "Long (1200-2500)", "Very long (2500+)"]

DEP_BAND_BOUNDS = [0, 15, 30, 60, 120]
DEP_BAND_LABELS = ["On time / early", "1-15 late", "15-30 late", "30-60 late", "60-120 late",
                   "120+ late"]

SEASON_MONTHS = {"Winter": [12, 1, 2], "Spring": [3, 4, 5], "Summer": [6, 7, 8]}
SEASON_OTHER = "Autumn"
SEASON_LABELS = ["Winter", "Spring", "Summer", "Autumn"]

DOW_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def band(value: Column, bounds: Sequence[float], labels: Sequence[str],
         first_inclusive: bool = False) -> Column:
    """Label ``value`` by the first bound it is below; the last label takes the rest.

    ``labels`` has one more entry than ``bounds``. The rest, NULL included, goes to
    the last label (a CASE chain sends NULL to its ELSE branch). With
    ``first_inclusive`` the first test is ``<=`` instead of ``<``.
    """
    if len(labels) != len(bounds) + 1:
        raise ValueError("labels must have exactly one more entry than bounds")
    expr = None
    for i, (b, lab) in enumerate(zip(bounds, labels)):
        test = (value <= b) if (i == 0 and first_inclusive) else (value < b)
        expr = F.when(test, lab) if expr is None else expr.when(test, lab)
    return expr.otherwise(labels[-1])


def band_order(value: Column, labels: Sequence[str]) -> Column:
    """Position (1-based) of a band label, for sorting bands in their natural order."""
    return F.array_position(F.array(*[F.lit(x) for x in labels]), value).cast("int")


def fixed_bin(value: Column, step: int) -> Column:
    """Fixed-width bin start: floor(x / step) * step as int (floor, so -1 -> -step)."""
    return (F.floor(value / step) * step).cast("int")
