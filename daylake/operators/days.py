"""Calendar work: day ranges, the location x day grid, missing days, ageing."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from daylake.functions.dates import as_date, day_literal, within_days

# First day of the daily partition set.
ORIGIN = date(2024, 1, 1)

# Days a partition stays in the standard storage class, by layer (fixed values).
TIER_AFTER_DAYS: dict[str, int] = {"bronze": 60, "silver": 120, "gold": 365}

# Files and snapshots younger than this are never candidates for removal.
SAFETY_HORIZON = timedelta(hours=168)


@dataclass(frozen=True)
class DayRange:
    """An inclusive range of days."""

    start: date
    end: date

    def __post_init__(self) -> None:
        if self.end < self.start:
            raise ValueError("the end date must not lie before the start date")

    @classmethod
    def lookback(cls, days: int, as_of: date | None = None) -> "DayRange":
        """``as_of`` (default today) and the ``days`` days before it."""
        end = as_of or date.today()
        return cls(end - timedelta(days=days), end)

    def contains(self, column: Column | str) -> Column:
        return within_days(column, self.start, self.end)


@dataclass(frozen=True)
class BackfillRequest:
    """A checked request to rebuild a range of days."""

    days: DayRange
    location_set: str

    @classmethod
    def from_mapping(
        cls, mapping: dict, default_location_set: str = "data/locations.csv"
    ) -> "BackfillRequest":
        """``start`` is required; ``end`` defaults to it."""
        start = as_date(mapping["start"])
        end = as_date(mapping.get("end") or start)
        return cls(DayRange(start, end), mapping.get("location_set") or default_location_set)


def _days_between(start: date | str, end: date | str) -> Column:
    return F.explode(F.sequence(day_literal(start), day_literal(end), F.expr("INTERVAL 1 DAY")))


def date_spine(
    spark: SparkSession, start: date | str, end: date | str, column: str = "observation_date"
) -> DataFrame:
    """One row per day of the inclusive range."""
    return spark.range(0, 1, 1, 1).select(_days_between(start, end).alias(column))


def location_date_grid(locations: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Every location on every day: each location row generates its own days.

    A generator, not a join: nothing is shuffled or broadcast.
    """
    return locations.select("*", _days_between(start, end).alias("observation_date"))


def missing_days(
    present: DataFrame, start: date | str, end: date | str, column: str = "observation_date"
) -> DataFrame:
    """Days of the range without a single row in ``present``.

    Only the day column is read (a partition column: file footers only), and
    days are made distinct before they are shuffled.
    """
    spine = date_spine(present.sparkSession, start, end, column)
    seen = present.where(within_days(column, start, end)).select(column).distinct()
    return spine.join(seen, column, "left_anti")


def retention_tiers(
    partitions: DataFrame,
    as_of: date | str,
    column: str = "observation_date",
    after_days: dict[str, int] | None = None,
) -> DataFrame:
    """Storage tier of each ``(layer, day)`` partition by its age at ``as_of``."""
    limits = after_days or TIER_AFTER_DAYS
    limit = F.lit(None).cast("int")
    for layer, days in limits.items():
        limit = F.when(F.col("layer") == layer, F.lit(days)).otherwise(limit)
    age = F.datediff(day_literal(as_of), F.col(column))
    return partitions.select(
        "*",
        age.alias("age_days"),
        F.when(age >= limit, F.lit("cold")).otherwise(F.lit("standard")).alias("tier"),
    )


def safety_cutoff(as_of: datetime, horizon: timedelta = SAFETY_HORIZON) -> datetime:
    """The instant before which files may be removed."""
    return as_of - horizon
