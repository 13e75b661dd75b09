"""Date parsing, formatting and partition keys."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

from daylake.functions.degree_days import as_column


def parse_date(text: Column | str) -> Column:
    """ISO text to date; malformed text is an error under ANSI mode."""
    return F.to_date(as_column(text), "yyyy-MM-dd")


def try_parse_date(text: Column | str) -> Column:
    """ISO text to date; malformed text is null."""
    return F.try_to_date(as_column(text), "yyyy-MM-dd")


def iso_date(day: Column | str) -> Column:
    """``2024-01-31``."""
    return F.date_format(as_column(day), "yyyy-MM-dd")


def partition_suffix(day: Column | str) -> Column:
    """``20240131``: the name of a day partition in the serving store."""
    return F.date_format(as_column(day), "yyyyMMdd")


def month_key(day: Column | str) -> Column:
    """``202401`` as an integer: the month partition key."""
    d = as_column(day)
    return (F.year(d) * F.lit(100) + F.month(d)).cast("int")


def month_number(day: date) -> int:
    """The value of :func:`month_key` for a Python date."""
    return day.year * 100 + day.month


def as_date(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def day_literal(value: date | str) -> Column:
    return F.lit(as_date(value))


def within_days(column: Column | str, start: date | str, end: date | str) -> Column:
    """Inclusive day range.  Literal bounds, so partitions prune at planning."""
    return as_column(column).between(day_literal(start), day_literal(end))
