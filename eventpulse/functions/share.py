"""Shares and scalings."""

from pyspark.sql import Column, functions as F

from eventpulse._columns import ColumnOrName, as_column


def percent_half_up(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """Whole percent, half rounded up; -1 where there is nothing to divide by."""
    p, w = as_column(part), as_column(whole)
    share = F.floor(p * F.lit(100.0) / w + F.lit(0.5)).cast("int")
    return F.when(w == 0, F.lit(-1)).otherwise(share)


def linear_scale(value: Column, low: Column, high: Column, to_low: float, to_high: float) -> Column:
    """Map ``low..high`` linearly to ``to_low..to_high``; a single value maps to ``to_high``."""
    span = F.lit(float(to_high) - float(to_low))
    scaled = F.lit(float(to_low)) + (value - low) * span / (high - low)
    return F.when(high == low, F.lit(float(to_high))).otherwise(scaled)
