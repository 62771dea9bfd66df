"""Rounding with binary-double semantics.

Spark's own ``round`` works on the decimal text of a double (1.005 -> 1.01). Reports and model
tables are rounded on the double itself, the way the SQL and array libraries they are compared
with do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_away(value: Column, digits: int) -> Column:
    """Round half away from zero (SQL ``ROUND`` on doubles)."""
    scale = float(10**digits)
    value = value.cast("double")
    scaled = F.abs(value) * scale
    # From 2**52 on a double has no fraction left to round.
    whole = F.when(scaled < float(2**52), F.floor(scaled + F.lit(0.5)).cast("double")).otherwise(scaled)
    return F.signum(value) * whole / scale


def half_even(value: Column, digits: int) -> Column:
    """Round half to even (array-library rounding)."""
    scale = float(10**digits)
    return F.rint(value.cast("double") * scale) / scale
