"""Rounding, clamping and guarded division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(col: Column, digits: int) -> Column:
    """Round half to even by scaling, as array libraries round doubles.

    ``bround`` goes through the decimal text of the double and breaks ties
    differently, so it is not used.
    """
    scale = F.lit(float(10**digits))
    return F.rint(col.cast("double") * scale) / scale


def at_least_zero(col: Column) -> Column:
    return F.greatest(col, F.lit(0.0))


def unit_interval(col: Column) -> Column:
    return F.least(F.greatest(col, F.lit(0.0)), F.lit(1.0))


def interval_bounds(qty: Column, sigma: Column, z: float = 1.28) -> tuple[Column, Column]:
    """Lower and upper bound of the prediction interval, floored at zero."""
    half = F.lit(z) * sigma
    return (
        at_least_zero(round_even(qty - half, 1)),
        at_least_zero(round_even(qty + half, 1)),
    )
