"""Numeric typing and arithmetic that is safe with ANSI mode on or off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def finite_or_null(value: Column) -> Column:
    """NaN sorts above every number in Spark, so one comparison rules out NaN and both infinities."""
    return F.when(F.abs(value) < F.lit(INF), value)


def finite_double(col: Column) -> Column:
    """Text to double; malformed, NaN and infinite become NULL."""
    return finite_or_null(col.try_cast("double"))


def integral_code(col: Column, data_type: str) -> Column:
    """Whole number of the given type; fractions, overflow, NaN and infinities become NULL.

    ``floor`` gives a bigint, so no infinity or NaN equals its own floor.
    """
    value = col.try_cast("double")
    return F.when(value == F.floor(value), value.try_cast(data_type))


def typed(col: Column, data_type: str) -> Column:
    return integral_code(col, data_type) if data_type in ("int", "bigint") else finite_double(col)


def ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole)


def percent(part: Column, whole: Column) -> Column:
    return F.lit(100.0) * F.try_divide(part, whole)


def relative_change(previous: Column, current: Column) -> Column:
    """Reduction from previous to current in percent of previous."""
    return percent(previous - current, previous)


def close_to(left: Column, right: Column, tolerance: float = 1e-6) -> Column:
    scale = F.greatest(F.lit(1.0), F.abs(left), F.abs(right))
    return F.abs(left - right) <= F.lit(tolerance) * scale


def correlation(x: Column, y: Column) -> Column:
    """Pearson aggregate over complete pairs; NULL (not an ANSI error) if a side is constant."""
    both = x.isNotNull() & y.isNotNull()
    sd_x, sd_y = F.stddev_pop(F.when(both, x)), F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), sd_x * sd_y)


def positive_log(col: Column) -> Column:
    return F.when(col > 0, F.log(col))


def tenure(years: Column, months: Column) -> Column:
    return years + months / F.lit(12.0)
