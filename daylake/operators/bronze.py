"""Typed bronze rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from daylake.functions import nan_as_null
from daylake.functions.degree_days import as_column
from daylake.operators.days import DayRange, location_date_grid
from daylake.schemas import BRONZE, conform


def _required(name: str, value: Column | str) -> Column:
    """The value, failing the job on a null instead of storing it."""
    value = as_column(value)
    failure = F.raise_error(F.lit(f"bronze column {name} must not be null"))
    return F.when(value.isNotNull(), value).otherwise(failure).alias(name)


def bronze_rows(
    readings: DataFrame,
    *,
    source: str | Column = "openmeteo",
    ingested_at: datetime | Column | None = None,
) -> DataFrame:
    """Readings as bronze rows.

    ``readings`` has location_id, observation_date, tavg_c, prcp_mm, latitude and
    longitude.  Lineage columns are added: ``source``, ``ingest_date`` (always the
    observation day) and one ``ingested_at`` for the whole run.  NaN measures
    become null.  A projection: no shuffle.
    """
    origin = source if isinstance(source, Column) else F.lit(source)
    if ingested_at is None:
        loaded = F.current_timestamp()
    else:
        loaded = ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at)
    day = _required("observation_date", F.to_date("observation_date"))
    rows = readings.select(
        _required("source", origin),
        _required("location_id", "location_id"),
        day,
        day.alias("ingest_date"),
        nan_as_null(F.col("tavg_c").cast("double")).alias("tavg_c"),
        nan_as_null(F.col("prcp_mm").cast("double")).alias("prcp_mm"),
        "latitude",
        "longitude",
        _required("ingested_at", loaded),
    )
    return conform(rows, BRONZE)


def unique_locations(locations: DataFrame) -> DataFrame:
    """The dimension, failing the job where a location occurs more than once."""
    one = locations.groupBy("location_id").agg(
        F.first("latitude").alias("latitude"), F.first("longitude").alias("longitude"), F.count("*").alias("_n")
    )
    failure = F.raise_error(F.concat(F.lit("location occurs more than once: "), F.col("location_id")))
    sound = F.when(F.col("_n") > 1, failure).otherwise(F.lit(True))
    return one.where(sound.cast("boolean")).drop("_n")


def readings_with_places(readings: DataFrame, locations: DataFrame) -> DataFrame:
    """Every reading with the coordinates of its location and ``known_place``.

    Readings of places that the dimension lacks stay, without coordinates: no reading is
    lost here, whoever takes the known ones has the others in the same frame.  The size
    of the location side decides between broadcast and shuffled join at run time (its
    files' size when planned, its measured size under AQE).
    """
    places = unique_locations(locations).withColumn("_known", F.lit(True))
    joined = readings.join(places, "location_id", "left")
    return joined.withColumn("known_place", F.coalesce("_known", F.lit(False))).drop("_known")


def load_report(readings: DataFrame, locations: DataFrame, days: DayRange) -> DataFrame:
    """``location_id, observation_date, problem, readings`` where a load is not one to
    one with the places on all days of a range: ``missing`` (no reading), ``unknown
    place`` or ``unexpected day`` (readings that no pair takes).

    Places come from the dimension itself; the pairs are generated, and readings are
    counted before they are shuffled.
    """
    keys = ["location_id", "observation_date"]
    counts = readings.groupBy(*keys).agg(F.count("*").alias("readings"))
    known = unique_locations(locations).select("location_id")
    pairs = location_date_grid(known, days.start, days.end).withColumn("_expected", F.lit(True))
    joined = counts.join(pairs, keys, "full").join(
        known.withColumn("_place", F.lit(True)), "location_id", "left"
    )
    problem = (
        F.when(F.col("readings").isNull(), "missing")
        .when(F.col("_place").isNull(), "unknown place")
        .when(F.col("_expected").isNull(), "unexpected day")
    )
    return joined.where(problem.isNotNull()).select(
        *keys, problem.alias("problem"), F.coalesce("readings", F.lit(0)).cast("long").alias("readings")
    )
