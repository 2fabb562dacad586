"""Numeric helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Places kept before the reported rounding of sums-of-products measures.
GUARD_DIGITS = 10


def stable_round(value: Column, digits: int, guard: int = GUARD_DIGITS) -> Column:
    """Round to ``digits`` places after rounding to ``guard`` places.

    Correlations and standard deviations come out of floating-point sums whose
    last bits depend on the order rows are added (partition layout, engine).
    Rounding to ``guard`` places first removes that noise, so a value that sits
    on a rounding boundary is reported the same way on any cluster layout.
    """
    return F.round(F.round(value, guard), digits)
