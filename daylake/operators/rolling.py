"""Rolling windows over daily rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def rolling_rows(value: Column, key: Sequence[str], order: str, width: int) -> Column:
    """``value`` (an aggregate) over the current row and the ``width`` - 1 before it."""
    frame = Window.partitionBy(*key).orderBy(order).rowsBetween(1 - width, Window.currentRow)
    return value.over(frame)


def rolling_windows(
    daily: DataFrame,
    widths: tuple[int, int] = (7, 30),
    region: str | None = None,
    *,
    key: str = "region_id",
    order: str = "observation_date",
    mean_of: str = "avg_temp_c",
    sum_of: str = "total_prcp_mm",
    mean_name: str = "avg_temp",
    sum_name: str = "prcp",
) -> DataFrame:
    """Rolling mean over the short width, rolling sums over both.

    Frames count rows, not days: a gap in the days widens the span and the first
    rows have short frames.  Output names carry the widths (``avg_temp_7d``,
    ``prcp_7d``, ``prcp_30d``).

    ``daily`` must hold one row per key and day, as gold does, so a window group is
    no longer than the calendar whatever the number of observations behind it.
    Rows are cut to four columns before the shuffle; all frames share one
    exchange and one sort.  ``region`` filters below the window.
    """
    short, long = widths
    thin = daily.select(order, key, mean_of, sum_of)
    if region is not None:
        thin = thin.where(F.col(key) == F.lit(region))
    return thin.select(
        order,
        key,
        rolling_rows(F.avg(mean_of), [key], order, short).alias(f"{mean_name}_{short}d"),
        rolling_rows(F.sum(sum_of), [key], order, short).alias(f"{sum_name}_{short}d"),
        rolling_rows(F.sum(sum_of), [key], order, long).alias(f"{sum_name}_{long}d"),
    )
