"""Landed JSON replies of the daily weather service.

A reply holds parallel arrays below ``daily``.  Both readers are projections over
the reply rows: no shuffle, and no state beyond one reply.
"""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from daylake.functions.dates import parse_date
from daylake.schemas import DAILY_REPLY

BadReplies = Literal["raise", "skip"]


def read_replies(spark: SparkSession, path: str) -> DataFrame:
    """Landed files, one JSON reply a line with its ``location_id``."""
    return spark.read.schema("location_id string, body string").json(path)


_CORRUPT = "_corrupt"
_REPLY = StructType([*DAILY_REPLY.fields, StructField(_CORRUPT, StringType())])


def _parsed(replies: DataFrame, body: str) -> DataFrame:
    """Replies with ``_daily`` and ``_problem`` (null for a sound reply).

    A value array shorter than ``time`` is sound: the values of its last days are null.
    The parsed reply and its problem come from generators of one row each, which the
    optimiser does not copy into every place that uses them: a reply is parsed once.
    """
    read = F.from_json(F.col(body), _REPLY, {"columnNameOfCorruptRecord": _CORRUPT})
    parsed = replies.select("*", F.explode(F.array(read)).alias("_reply"))
    daily = F.col("_reply.daily")
    arrays = [daily.getField(f.name) for f in DAILY_REPLY["daily"].dataType.fields]
    sizes = [F.size(a) for a in arrays]
    problem = (
        F.when(F.col(body).isNull(), "no reply")
        .when(F.col("_reply").isNull() | F.col(f"_reply.{_CORRUPT}").isNotNull(), "not readable")
        .when(daily.isNull(), "no daily values")
        .when(F.array_contains(F.array(*[a.isNull() for a in arrays]), True), "an array is missing")
        .when((sizes[1] > sizes[0]) | (sizes[2] > sizes[0]), "values without a day")
        .when(F.exists(arrays[0], lambda day: F.try_to_date(day, "yyyy-MM-dd").isNull()), "a day is not a date")
    )
    checked = F.struct(daily.alias("daily"), problem.alias("problem"))
    return parsed.select("*", F.explode(F.array(checked)).alias("_read")).select(
        *replies.columns, F.col("_read.daily").alias("_daily"), F.col("_read.problem").alias("_problem")
    )


def _sound(replies: DataFrame, body: str, bad: BadReplies) -> DataFrame:
    parsed = _parsed(replies, body)
    if bad == "skip":
        return parsed.where(F.col("_problem").isNull())
    failure = F.raise_error(F.concat(F.lit("malformed reply, "), F.col("_problem"), F.lit(": "), F.substring(F.coalesce(body, F.lit("")), 1, 200)))
    sound = F.when(F.col("_problem").isNotNull(), failure).otherwise(F.lit(True))
    return parsed.where(sound.cast("boolean"))


def bad_replies(replies: DataFrame, body: str = "body") -> DataFrame:
    """The replies that neither reader takes, as they came, with a ``problem``."""
    parsed = _parsed(replies, body).where(F.col("_problem").isNotNull())
    return parsed.select(*replies.columns, F.col("_problem").alias("problem"))


def daily_readings(replies: DataFrame, body: str = "body", bad: BadReplies = "raise") -> DataFrame:
    """One row per reply and day: the reply's other columns, then
    ``observation_date, tavg_c, prcp_mm``.

    A malformed reply fails the job; with ``bad="skip"`` it is left out here and can be
    stored from :func:`bad_replies`.
    """
    keep = [c for c in replies.columns if c != body]
    parsed = _sound(replies, body, bad).select(*keep, "_daily")
    rows = F.arrays_zip(
        F.col("_daily.time").alias("day"),
        F.col("_daily.temperature_2m_mean").alias("tavg_c"),
        F.col("_daily.precipitation_sum").alias("prcp_mm"),
    )
    return parsed.select(*keep, F.explode(rows).alias("_r")).select(
        *keep,
        parse_date(F.col("_r.day")).alias("observation_date"),
        F.col("_r.tavg_c").alias("tavg_c"),
        F.col("_r.prcp_mm").alias("prcp_mm"),
    )


def first_reading(replies: DataFrame, body: str = "body", bad: BadReplies = "raise") -> DataFrame:
    """The one-day form: element 0 of each value array (null when there is none).
    Malformed replies as in :func:`daily_readings`."""
    keep = [c for c in replies.columns if c != body]
    parsed = _sound(replies, body, bad).select(*keep, "_daily")
    return parsed.select(
        *keep,
        F.get(F.col("_daily.temperature_2m_mean"), F.lit(0)).alias("tavg_c"),
        F.get(F.col("_daily.precipitation_sum"), F.lit(0)).alias("prcp_mm"),
    )
