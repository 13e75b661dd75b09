"""Publishing gold days to serving tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, functions as F

from daylake.errors import DataSourceUnavailable
from daylake.functions import month_key
from daylake.functions.dates import month_number
from daylake.operators.contracts import passing_rows
from daylake.operators.days import DayRange
from daylake.operators.shaping import json_records, serving_shape
from daylake.schemas import SERVING, SERVING_BY_MONTH, SERVING_FLOAT32, conform
from daylake.sinks.tables import ensure_table, lay_out, replace_partitions
from daylake.sources.tables import Table


class Sink(Protocol):
    """Where gold rows of a day range are published."""

    def publish(self, gold: DataFrame, days: DayRange) -> None: ...


def serving_by_day(
    name: str | None = None, path: str | None = None, *, float32: bool = False
) -> Table:
    """Serving table partitioned by day, clustered by region; measures as 32-bit floats
    on request."""
    schema = SERVING_FLOAT32 if float32 else SERVING
    return Table(schema, ("observation_date",), name, path, sort_by=("region_id",))


def serving_by_month(name: str | None = None, path: str | None = None) -> Table:
    """Serving table partitioned by month, ordered by region and day."""
    return Table(
        SERVING_BY_MONTH, ("month",), name, path, sort_by=("region_id", "observation_date")
    )


def serving_by_region(name: str, path: str | None = None, buckets: int = 64) -> Table:
    """Serving table kept by month and bucketed by region: windows over a region's days
    need no shuffle, and a region is read from one bucket.  For :class:`MonthSink`.

    One region's rows of all time are one bucket's, so its size grows with the days and
    the regions a bucket, never with the observations.
    """
    return Table(
        SERVING_BY_MONTH,
        ("month",),
        name,
        path,
        sort_by=("region_id", "observation_date"),
        bucket_by=("region_id",),
        buckets=buckets,
    )


@dataclass(frozen=True)
class DaySink:
    """Truncate each published day and load it again."""

    table: Table

    def publish(self, gold: DataFrame, days: DayRange) -> None:
        rows = serving_shape(gold.where(days.contains("observation_date")))
        replace_partitions(rows, self.table)


@dataclass(frozen=True)
class MonthSink:
    """Delete the published days, insert their new rows; files are kept by month.

    The touched months are known from the range, so only they are read.  Days of the
    range without new rows keep their old ones.  Rewriting costs the touched
    months; where single days of very large months are republished often,
    :class:`DaySink` writes only the day.
    """

    table: Table

    def publish(self, gold: DataFrame, days: DayRange) -> None:
        spark = gold.sparkSession
        ensure_table(spark, self.table)
        fresh = serving_shape(gold.where(days.contains("observation_date"))).withColumn(
            "month", month_key("observation_date")
        )
        stored = self.table.read_if_exists(spark)
        if stored is not None:
            touched = F.col("month").between(month_number(days.start), month_number(days.end))
            # Distinct days of a literal range: bounded by the calendar.
            replaced = F.broadcast(fresh.select("observation_date").distinct())
            kept = stored.where(touched).join(replaced, "observation_date", "left_anti")
            fresh = conform(kept, SERVING_BY_MONTH).unionByName(fresh)
        replace_partitions(fresh, self.table)


@dataclass(frozen=True)
class JsonSink:
    """JSON records in one folder a day; published days are replaced, others stay."""

    path: str

    def publish(self, gold: DataFrame, days: DayRange) -> None:
        rows = serving_shape(gold.where(days.contains("observation_date")))
        (
            lay_out(json_records(rows, ["observation_date"]), ["observation_date"])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("observation_date")
            .text(self.path)
        )


def publish(gold: DataFrame, days: DayRange, targets: Mapping[str, Sink], env: str) -> Sink:
    """Publish to the target of ``env``, or to ``targets['default']``."""
    sink = targets.get(env.lower()) or targets["default"]
    sink.publish(gold, days)
    return sink


def publish_table(
    spark,
    gold: Table,
    days: DayRange,
    targets: Mapping[str, Sink],
    env: str,
    *,
    failed: DataFrame | None = None,
) -> bool:
    """Publish a range from the gold table.

    A missing gold table is reported and skipped, as is a range without rows; any
    other error is raised.  Days that ``failed`` (a contract report) are left out, since
    what gold holds of them is old.  Returns whether anything was published.
    """
    try:
        rows = gold.read(spark)
    except DataSourceUnavailable as missing:
        print(f"nothing published: {missing}")
        return False
    window = rows.where(days.contains("ingest_date") & days.contains("observation_date"))
    if failed is not None:
        window = passing_rows(window, failed, by="ingest_date")
    if window.isEmpty():
        return False
    publish(window, days, targets, env)
    return True
