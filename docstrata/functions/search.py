"""Search in sorted arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements up to which counting them all takes less time than halving.
SHORT = 64


def at_or_before(ticks: Column, value: Column) -> Column:
    """How many elements of a sorted array are at or before the value, counted in short arrays and by halving in long ones.

    0 for empty arrays, null for a null array or value.
    """
    size = F.size(ticks)
    halve = lambda s, _: F.when(s["low"] >= s["high"], s).otherwise(_half(ticks, value, s))
    start = F.struct(F.lit(0).alias("low"), size.alias("high"))
    steps = F.sequence(F.lit(1), F.greatest(F.ceil(F.log2(size + 1)).cast("int"), F.lit(1)))
    short = F.size(F.filter(ticks, lambda t: t <= value))
    return F.when(ticks.isNotNull() & value.isNotNull(), F.when(size <= SHORT, short).otherwise(F.aggregate(steps, start, halve)["low"]))


def _half(ticks: Column, value: Column, s: Column) -> Column:
    middle = F.shiftright(s["low"] + s["high"], 1)
    behind = F.get(ticks, middle) <= value
    return F.struct(F.when(behind, middle + 1).otherwise(s["low"]).alias("low"), F.when(behind, s["high"]).otherwise(middle).alias("high"))
