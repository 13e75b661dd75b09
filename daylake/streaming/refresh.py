"""Continuous lake: new bronze files refresh the silver and gold days they touch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from daylake.operators.days import DayRange
from daylake.operators.partials import failing_days, gold_partials, merged_gold
from daylake.operators.silver import silver_features
from daylake.plans.lake import Lake, OnFailure, build_gold, build_silver
from daylake.schemas import BRONZE
from daylake.session import stage
from daylake.sinks.tables import replace_partitions
from daylake.sources.tables import Table


def refresh_days(
    spark: SparkSession, lake: Lake, touched: DataFrame, on_failure: OnFailure = "raise"
) -> None:
    """Rebuild silver and gold for the days in ``touched.ingest_date``.

    Whole days are recomputed from the bronze table, not from the batch, so late
    files for an old day and replays of a batch give the same result.
    """
    first, last = touched.agg(F.min("ingest_date"), F.max("ingest_date")).first()
    if first is None:
        return
    span = DayRange(first, last)
    # Distinct dates: bounded by the calendar, not by the data.
    only = F.broadcast(touched.select("ingest_date").distinct())
    silver = build_silver(spark, lake, span, only=only, on_failure=on_failure)
    build_gold(spark, lake, span, only=only, on_failure=on_failure, failed=silver)


def merge_load(
    spark: SparkSession, lake: Lake, partials: Table, bronze_rows: DataFrame, load: str
) -> DataFrame:
    """Add a load of new bronze rows: its partials are stored, and gold of the days it
    touches is merged from the partials of all loads.

    Only the new rows are read, once.  A load that runs again replaces its own partials.
    Days that break the silver contract, all loads together, keep their old gold; they
    are returned as ``ingest_date, violations``.  For bronze that grows: where a day is
    loaded anew as a whole, drop its partials first.
    """
    replace_partitions(gold_partials(silver_features(bronze_rows), load), partials)
    stored = partials.read(spark)
    # Distinct dates: bounded by the calendar, not by the data.
    touched = F.broadcast(stored.where(F.col("load") == load).select("ingest_date").distinct())
    rows = stored.join(touched, "ingest_date", "left_semi")
    failing = stage(failing_days(rows), "failing-days")
    replace_partitions(
        merged_gold(rows.join(F.broadcast(failing), "ingest_date", "left_anti")), lake.gold
    )
    return failing


def start_partial_refresh(
    spark: SparkSession,
    lake: Lake,
    partials: Table,
    checkpoint: str,
    *,
    trigger: dict | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Gold kept up to date from new bronze files alone, each micro-batch a load (see
    :func:`merge_load`); its number names the load, so a batch that runs again changes
    nothing.  Unlike :func:`start_refresh` no old file of a day is read again."""
    arrivals = _arrivals(spark, lake, max_files_per_trigger)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        merge_load(batch.sparkSession, lake, partials, batch, f"batch-{batch_id:012d}")

    return _started(arrivals, on_batch, checkpoint, trigger)


def _arrivals(spark: SparkSession, lake: Lake, max_files_per_trigger: int | None) -> DataFrame:
    if not lake.bronze.path:
        raise ValueError("the bronze table needs a location to be watched")
    reader = spark.readStream.schema(BRONZE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(lake.bronze.path)


def _started(arrivals: DataFrame, on_batch, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        arrivals.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_refresh(
    spark: SparkSession,
    lake: Lake,
    checkpoint: str,
    *,
    trigger: dict | None = None,
    max_files_per_trigger: int | None = None,
    on_failure: OnFailure = "raise",
) -> StreamingQuery:
    """Watch the bronze location; by default process what is there and stop.

    Only the day of the new rows is read (the partition column).  A fixed
    ``checkpoint`` lets a later run go on where this one ended.
    """
    arrivals = _arrivals(spark, lake, max_files_per_trigger).select("ingest_date")

    def on_batch(batch: DataFrame, _batch_id: int) -> None:
        refresh_days(batch.sparkSession, lake, batch, on_failure)

    return _started(arrivals, on_batch, checkpoint, trigger)
