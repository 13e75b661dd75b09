"""The tables of a lake and the set-based steps between them.

A step covers a whole range of days in one Spark job.  Replacing partitions makes
each step idempotent and gives the same tables as running its days one by one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from daylake.naming import table_name
from daylake.errors import UnknownPlaces
from daylake.operators.bronze import bronze_rows, load_report, readings_with_places
from daylake.operators.contracts import (
    GOLD_SUITE,
    SILVER_SUITE,
    Suite,
    contract_report,
    contract_sample,
    enforce,
    failing_rows,
    passing_rows,
)
from daylake.operators.days import BackfillRequest, DayRange, missing_days
from daylake.operators.gold import gold_summary
from daylake.operators.silver import silver_features
from daylake.schemas import BRONZE, GOLD, SILVER
from daylake.session import stage, staged
from daylake.sinks.serving import Sink, publish_table
from daylake.sinks.tables import (
    drop_day_folders,
    drop_days,
    export_parquet,
    persist,
    replace_partitions,
    write_samples,
)
from daylake.sources.locations import read_locations
from daylake.sources.tables import Table

OnFailure = Literal["raise", "quarantine"]

# Stored table names (fixed values).
TABLE_NAMES = {
    "bronze": "openmeteo_daily",
    "silver": "climate_daily_features",
    "gold": "climate_daily_summary",
}
SCHEMAS = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD}


@dataclass(frozen=True)
class Lake:
    """Bronze, silver and gold tables and where side outputs go."""

    bronze: Table
    silver: Table
    gold: Table
    env: str = "dev"
    exports: str | None = None
    samples: str | None = None
    quarantine: str | None = None
    targets: Mapping[str, Sink] = field(default_factory=dict)

    @classmethod
    def at_path(cls, root: str, **options) -> "Lake":
        """Tables as partitioned directories ``{root}/{layer}/{table}``."""
        return cls(**{layer: _table(layer, root=root) for layer in SCHEMAS}, **options)

    @classmethod
    def in_catalog(
        cls,
        env: str = "dev",
        catalog: str | None = None,
        root: str | None = None,
        provider: str = "parquet",
        **options,
    ) -> "Lake":
        """Catalog tables ``[catalog.]{env}_{layer}.{table}``, below ``root`` if given."""
        tables = {
            layer: _table(layer, table_name(env, layer, name, catalog), root, provider)
            for layer, name in TABLE_NAMES.items()
        }
        return cls(**tables, env=env, **options)


def _table(
    layer: str, name: str | None = None, root: str | None = None, provider: str = "parquet"
) -> Table:
    """A layer's table: partitioned by day, clustered by place inside its files."""
    return Table(
        SCHEMAS[layer],
        ("ingest_date",),
        name=name,
        path=f"{root.rstrip('/')}/{layer}/{TABLE_NAMES[layer]}" if root else None,
        sort_by=("region_id" if layer == "gold" else "location_id",),
        provider=provider,
    )


@dataclass(frozen=True)
class RunReports:
    """What a run checked: both contract reports, and the load report if it loaded."""

    silver: DataFrame
    gold: DataFrame
    load: DataFrame | None = None


def in_range(df: DataFrame, days: DayRange) -> DataFrame:
    """Rows of a range.  ``ingest_date`` always equals ``observation_date`` in this
    lake; it is the partition column, so naming it prunes the scan."""
    return df.where(days.contains("ingest_date") & days.contains("observation_date"))


def load_bronze(
    spark: SparkSession,
    lake: Lake,
    readings: DataFrame,
    locations: DataFrame,
    days: DayRange,
    *,
    source: str | Column = "openmeteo",
    ingested_at: datetime | Column | None = None,
    on_failure: OnFailure = "raise",
) -> DataFrame:
    """Parsed readings of the range, with coordinates, as bronze days.

    The readings are read once: rows of known and of unknown places come from one staged
    join, and so does the load report, which is written before bronze is.  Readings of
    places that the dimension lacks raise :class:`UnknownPlaces` before anything is
    written, or, with ``on_failure="quarantine"``, are stored as bronze rows without
    coordinates (:func:`unknown_places_folder`); a day that has none any more leaves it.
    Returns the stored report: also pairs of place and day without a reading.
    """
    _place_for(on_failure, lake)
    wanted = readings.where(days.contains("observation_date"))
    kept = [c for c in wanted.columns if c not in ("latitude", "longitude", "known_place")]
    origin = source if isinstance(source, Column) else F.lit(source)
    placed = readings_with_places(wanted.select(*kept).withColumn("_origin", origin), locations)
    with staged(placed, "readings") as rows:
        report = stage(load_report(rows, locations, days), "load-report")
        unknown = report.where(F.col("problem") == "unknown place")
        some_unknown = not unknown.isEmpty()
        if some_unknown and on_failure == "raise":
            first = unknown.orderBy("location_id", "observation_date").limit(20)
            shown = [(r[0], r[1], r[2]) for r in first.select("location_id", "observation_date", "readings").collect()]
            raise UnknownPlaces(shown, unknown.count(), report)

        def typed(part: DataFrame) -> DataFrame:
            return bronze_rows(part, source=F.col("_origin"), ingested_at=ingested_at)

        if some_unknown:
            aside = typed(rows.where(~F.col("known_place")))
            export_parquet(aside, unknown_places_folder(lake), ["ingest_date"])
        replace_partitions(typed(rows.where("known_place")), lake.bronze)
        if lake.quarantine:
            sound = rows.groupBy(F.to_date("observation_date").alias("ingest_date")).agg(
                F.bool_and("known_place").alias("_sound")
            )
            drop_day_folders(sound.where("_sound"), unknown_places_folder(lake))
    return report


def unknown_places_folder(lake: Lake) -> str:
    """Where readings of unknown places are kept, as bronze rows by day."""
    return f"{lake.quarantine.rstrip('/')}/bronze_unknown_places"


def _rows_of(
    spark: SparkSession, table: Table, days: DayRange, only: DataFrame | None
) -> DataFrame:
    rows = in_range(table.read(spark), days)
    return rows if only is None else rows.join(only, "ingest_date", "left_semi")


def _gate(rows: DataFrame, suite: Suite, lake: Lake) -> tuple[DataFrame, DataFrame]:
    """Sample, check and split; returns the passing rows and the report.

    The report is a few rows per day; it is staged so that splitting, quarantine
    and the error message all read it instead of checking again.  When every day
    passes, the rows are neither split nor read once more.
    """
    if lake.samples:
        # Ordered by all that tells rows apart, so that a rerun stores the same sample.
        order = [c for c in rows.columns if c not in ("ingest_date", "ingested_at")]
        write_samples(contract_sample(rows, suite, order, by="ingest_date"), lake.samples)
    report = stage(contract_report(rows, suite, by="ingest_date"), "contract-report")
    if report.where(~F.col("passed")).isEmpty():
        return rows, report
    if lake.quarantine:
        bad = failing_rows(rows, report, by="ingest_date")
        export_parquet(bad, _quarantine(lake, suite), ["ingest_date"])
    return passing_rows(rows, report, by="ingest_date"), report


def _quarantine(lake: Lake, suite: Suite) -> str:
    return f"{lake.quarantine.rstrip('/')}/{suite.name}"


def release(report: DataFrame, lake: Lake, suite: Suite) -> None:
    """Days that pass now leave the quarantine."""
    if lake.quarantine:
        drop_day_folders(passing_rows(report, report, by="ingest_date"), _quarantine(lake, suite))


def _place_for(on_failure: OnFailure, lake: Lake) -> None:
    if on_failure == "quarantine" and not lake.quarantine:
        raise ValueError("failing days need a quarantine folder, or they would be lost")


def build_silver(
    spark: SparkSession,
    lake: Lake,
    days: DayRange,
    *,
    only: DataFrame | None = None,
    on_failure: OnFailure = "raise",
) -> DataFrame:
    """Silver days of the range from bronze; days without bronze rows are left alone.

    Passing days are written, then failing ones raise (or stay in quarantine).
    The contract pass reads four bronze columns; the write is map-only, as bronze is
    already laid out by day.  ``only`` (a short frame of ``ingest_date``) narrows the
    range to some of its days.  Returns the contract report.
    """
    _place_for(on_failure, lake)
    silver = silver_features(_rows_of(spark, lake.bronze, days, only))
    passing, report = _gate(silver, SILVER_SUITE, lake)
    persist(
        passing,
        lake.silver,
        export_path=_export(lake, "silver"),
        export_partition_by=("ingest_date",),
        keep_layout=True,
    )
    release(report, lake, SILVER_SUITE)
    if on_failure == "raise":
        enforce(report)
    return report


def build_gold(
    spark: SparkSession,
    lake: Lake,
    days: DayRange,
    *,
    only: DataFrame | None = None,
    on_failure: OnFailure = "raise",
    failed: DataFrame | None = None,
    sources: Sequence[str] | None = None,
) -> DataFrame:
    """Gold days of the range from silver.

    The aggregate is staged once; contract, table and export read the staged rows.
    Days that ``failed`` (silver's report) are left alone: their silver is that of an
    earlier run.  ``sources`` as in :func:`gold_summary`.
    """
    _place_for(on_failure, lake)
    silver = _rows_of(spark, lake.silver, days, only)
    if failed is not None:
        silver = passing_rows(silver, failed, by="ingest_date")
    with staged(gold_summary(silver, sources), "gold") as gold:
        passing, report = _gate(gold, GOLD_SUITE, lake)
        persist(
            passing,
            lake.gold,
            export_path=_export(lake, "gold"),
            export_partition_by=("ingest_date",),
        )
    release(report, lake, GOLD_SUITE)
    if on_failure == "raise":
        enforce(report)
    return report


def remove_emptied(spark: SparkSession, lake: Lake, days: DayRange) -> None:
    """Remove silver days of the range that bronze has no rows of, and then gold days that
    silver has none of.  Only partition columns are read.  Exports keep their copies."""
    for source, target in ((lake.bronze, lake.silver), (lake.silver, lake.gold)):
        present, derived = source.read_if_exists(spark), target.read_if_exists(spark)
        if present is None or derived is None:
            continue
        kept = present.where(days.contains("ingest_date")).select("ingest_date").distinct()
        stored = derived.where(days.contains("ingest_date")).select("ingest_date").distinct()
        # Distinct dates: bounded by the calendar.
        drop_days(stored.join(F.broadcast(kept), "ingest_date", "left_anti"), target)


def _export(lake: Lake, layer: str) -> str | None:
    return f"{lake.exports.rstrip('/')}/{TABLE_NAMES[layer]}" if lake.exports else None


def run_window(
    spark: SparkSession,
    lake: Lake,
    days: DayRange,
    *,
    readings: DataFrame | None = None,
    locations: DataFrame | None = None,
    source: str | Column = "openmeteo",
    ingested_at: datetime | Column | None = None,
    on_failure: OnFailure = "raise",
    drop_emptied: bool = False,
) -> RunReports:
    """Bronze (when readings are given), silver, gold and publishing of a range.

    Days that fail a contract go no further: neither is their gold built nor anything
    of theirs published.  ``drop_emptied`` also removes silver and gold of days that have
    no source rows any more (:func:`remove_emptied`); they stay otherwise.  Returns what
    was checked.
    """
    loaded = None
    if readings is not None:
        if locations is None:
            raise ValueError("readings need a location dimension")
        loaded = load_bronze(
            spark,
            lake,
            readings,
            locations,
            days,
            source=source,
            ingested_at=ingested_at,
            on_failure=on_failure,
        )
    if drop_emptied:
        remove_emptied(spark, lake, days)
    silver = build_silver(spark, lake, days, on_failure=on_failure)
    gold = build_gold(spark, lake, days, on_failure=on_failure, failed=silver)
    if lake.targets:
        publish_table(
            spark, lake.gold, days, lake.targets, lake.env, failed=silver.unionByName(gold)
        )
    return RunReports(silver, gold, loaded)


def run_missing(spark: SparkSession, lake: Lake, days: DayRange, **options) -> RunReports | None:
    """Run the days of a range that bronze lacks, all in one job; None if there are none.

    ``readings`` (with ``locations``) must be given; those of other days are left out.
    """
    todo = stage(days_to_run(spark, lake, days), "missing-days")
    first, last = todo.agg(F.min("observation_date"), F.max("observation_date")).first()
    if first is None:
        return None
    # Distinct days of a range: bounded by the calendar.
    wanted = options.pop("readings").join(F.broadcast(todo), "observation_date", "left_semi")
    return run_window(spark, lake, DayRange(first, last), readings=wanted, **options)


def run_day(spark: SparkSession, lake: Lake, day: date, **options) -> RunReports:
    """One day through the lake."""
    return run_window(spark, lake, DayRange(day, day), **options)


def run_lookback(
    spark: SparkSession, lake: Lake, days: int, *, as_of: date | None = None, **options
) -> RunReports:
    """``as_of`` (default today) and the ``days`` days before it."""
    return run_window(spark, lake, DayRange.lookback(days, as_of), **options)


def run_backfill(
    spark: SparkSession, lake: Lake, request: BackfillRequest, **options
) -> RunReports:
    """A checked request; with readings, its location set is read as well."""
    if options.get("readings") is not None and options.get("locations") is None:
        options["locations"] = read_locations(spark, request.location_set)
    return run_window(spark, lake, request.days, **options)


def days_to_run(spark: SparkSession, lake: Lake, days: DayRange) -> DataFrame:
    """Days of the range without bronze rows (all of them when there is no table)."""
    bronze = lake.bronze.read_if_exists(spark)
    if bronze is None:
        bronze = spark.createDataFrame([], BRONZE)
    return missing_days(bronze, days.start, days.end, "ingest_date").withColumnRenamed(
        "ingest_date", "observation_date"
    )
