"""Degree-day and precipitation features.

``greatest`` and ``least`` skip nulls, so a missing temperature gives 0.0 degree
days.  Pass ``missing_as_zero=False`` to get null instead.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clamp(value: Column, low: float, high: float) -> Column:
    """``value`` limited to ``[low, high]``; null gives ``low``."""
    return F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high)))


def _positive_part(value: Column) -> Column:
    return F.greatest(value, F.lit(0.0))


def _feature(value: Column, temperature: Column, missing_as_zero: bool) -> Column:
    return value if missing_as_zero else F.when(temperature.isNotNull(), value)


def heating_degree_days(
    temperature: Column | str, base: float = 18.0, *, missing_as_zero: bool = True
) -> Column:
    t = as_column(temperature)
    return _feature(_positive_part(F.lit(float(base)) - t), t, missing_as_zero)


def cooling_degree_days(
    temperature: Column | str, base: float = 18.0, *, missing_as_zero: bool = True
) -> Column:
    t = as_column(temperature)
    return _feature(_positive_part(t - F.lit(float(base))), t, missing_as_zero)


def growing_degree_days(
    temperature: Column | str,
    low: float = 10.0,
    high: float = 30.0,
    *,
    missing_as_zero: bool = True,
) -> Column:
    """Degrees above ``low`` after limiting the temperature to ``[low, high]``."""
    t = as_column(temperature)
    return _feature(clamp(t, low, high) - F.lit(float(low)), t, missing_as_zero)


def precipitation_flag(precipitation: Column | str) -> Column:
    """``'Y'`` where it rained, otherwise (dry or unknown) ``'N'``."""
    wet = as_column(precipitation) > F.lit(0.0)
    return F.when(wet, F.lit("Y")).otherwise(F.lit("N"))


def nan_as_null(value: Column | str) -> Column:
    """NaN as null: Spark orders NaN above every number and counts it as a value."""
    v = as_column(value)
    return F.when(~F.isnan(v), v)
