"""Column expressions.  All are JVM-side built-ins; none is a Python UDF."""

from daylake.functions.degree_days import (
    clamp,
    cooling_degree_days,
    growing_degree_days,
    heating_degree_days,
    nan_as_null,
    precipitation_flag,
)
from daylake.functions.dates import (
    iso_date,
    month_key,
    parse_date,
    partition_suffix,
    try_parse_date,
)

__all__ = [
    "clamp",
    "cooling_degree_days",
    "growing_degree_days",
    "heating_degree_days",
    "iso_date",
    "month_key",
    "nan_as_null",
    "parse_date",
    "partition_suffix",
    "precipitation_flag",
    "try_parse_date",
]
