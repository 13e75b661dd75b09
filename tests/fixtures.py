"""Small hand-made frames shared by the tests."""

from __future__ import annotations

from datetime import date, datetime

from daylake.schemas import BRONZE

LOADED = datetime(2024, 2, 1)


def day(n: int) -> date:
    return date(2024, 1, n)


def bronze_row(location, n, tavg, prcp, source="openmeteo", lat=1.0, lon=2.0):
    return (source, location, day(n), day(n), tavg, prcp, lat, lon, LOADED)


def bronze_frame(spark, rows):
    return spark.createDataFrame([bronze_row(*r) for r in rows], BRONZE)


def two_locations_three_days(spark):
    return bronze_frame(
        spark,
        [
            ("LOC1", 1, 10.0, 0.0),
            ("LOC2", 1, 25.0, 1.5),
            ("LOC1", 2, None, 2.0),
            ("LOC2", 2, 35.0, None),
            ("LOC1", 3, 18.0, 0.0),
            ("LOC2", 3, 5.0, 4.0),
        ],
    )


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
