"""Dashboard queries over the serving table."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from daylake.functions.dates import day_literal, within_days
from daylake.sources.tables import day_partition

MEASURES = ("avg_temp_c", "total_prcp_mm", "had_precip", "avg_hdd18", "avg_cdd18")


def available_dates(df: DataFrame, limit: int = 30) -> DataFrame:
    """The newest ``limit`` distinct days, newest first (a top-k, no full sort)."""
    days = df.select("observation_date").distinct()
    return days.orderBy(F.desc("observation_date")).limit(limit)


def regions(df: DataFrame) -> DataFrame:
    """Distinct region names in order."""
    return df.select("region_id").distinct().orderBy("region_id")


def region_snapshot(df: DataFrame, day: date | str) -> DataFrame:
    """All regions on one day, by region."""
    rows = day_partition(df, day).select("region_id", *MEASURES)
    return rows.withColumn("observation_date", day_literal(day)).orderBy("region_id")


def snapshot_totals(
    df: DataFrame, day: date | str | None = None, *, approximate: bool = False
) -> DataFrame:
    """Number of regions, total precipitation and mean temperature of one day (or of
    all rows).  Takes the table, not a sorted snapshot: a sort would be kept."""
    rows = df if day is None else day_partition(df, day)
    count = F.approx_count_distinct if approximate else F.count_distinct
    return rows.agg(
        count("region_id").alias("regions"),
        F.sum("total_prcp_mm").alias("total_prcp_mm"),
        F.avg("avg_temp_c").alias("avg_temp_c"),
    )


def region_history(
    df: DataFrame,
    region: str,
    days: int = 30,
    *,
    as_of: date | None = None,
    newest_first: bool = False,
) -> DataFrame:
    """One region from ``days`` days before ``as_of`` up to it, both included."""
    end = as_of or date.today()
    start = end - timedelta(days=days)
    rows = df.where(
        (F.col("region_id") == F.lit(region)) & within_days("observation_date", start, end)
    ).select("observation_date", *MEASURES)
    return rows.orderBy(F.desc("observation_date") if newest_first else "observation_date")


def head_rows(df: DataFrame, order_by: list, n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order_by).limit(n)
