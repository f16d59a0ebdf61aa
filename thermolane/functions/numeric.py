"""Rounding, scaling and closed-form numeric expressions."""

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F


MEAN_DIGITS = 8
MEAN2_DIGITS = 11


def round_half_even(x: Column, digits: int = 1) -> Column:
    """Round to `digits` decimals with ties to the even digit (Spark's round goes half up)."""
    scale = float(10**digits)
    return F.rint(x * scale) / scale


def round_to_half(x: Column) -> Column:
    """Round to the nearest 0.5, ties to even."""
    return F.rint(x * 2.0) / 2.0


def steady(x: Column, digits: int = MEAN_DIGITS) -> Column:
    """Cut an aggregated double at `digits` decimals.

    The last bits of a distributed sum depend on the order in which tasks finish. Cutting
    them makes later rounding and rankings the same on every run and cluster size.
    Adding 0.0 turns -0.0 into 0.0. A mean of means is cut later (MEAN2_DIGITS), so that it
    rarely lies half way between two values of the last digit.
    """
    return round_half_even(x, digits) + F.lit(0.0)


def steady_mean(x: Column, digits: int = MEAN_DIGITS) -> Column:
    return steady(F.avg(x), digits)


def zscore(x: Column, mean: Column, sd: Column) -> Column:
    """Standard score; 0 where the deviation is null or not positive."""
    return F.when(sd > 0, (x - mean) / sd).otherwise(F.lit(0.0))


def null_safe_sum(columns) -> Column:
    """Row sum that skips nulls; all null gives 0."""
    return reduce(add, [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns])


def popcount(mask: Column) -> Column:
    return F.bit_count(mask)


def hour_mask(hour: Column) -> Column:
    """Set of hours as a bit mask: a distinct count of hours that combines map-side."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1), hour.cast("int")))


def wet_bulb(temp: Column, humidity: Column) -> Column:
    """Wet-bulb temperature in degrees Celsius by Stull (2011), humidity in percent."""
    return (
        temp * F.atan(0.151977 * F.sqrt(humidity + 8.313659))
        + F.atan(temp + humidity)
        - F.atan(humidity - 1.676331)
        + 0.00391838 * F.pow(humidity, F.lit(1.5)) * F.atan(0.023101 * humidity)
        - 4.686035
    )
