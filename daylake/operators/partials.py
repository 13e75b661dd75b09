"""Aggregates that can be merged: partial gold rows by load, and sketches of regions.

Sums and counts of disjoint sets of rows add up, so gold of a day follows from the
partial rows of all loads that brought readings of that day.  A load that arrives late
adds its own partials; nobody reads the observations of earlier loads again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from daylake.operators.contracts import SILVER_SUITE, InRange
from daylake.schemas import GOLD, PARTIALS, conform
from daylake.sources.tables import Table

KEYS = ("location_id", "observation_date", "ingest_date")
_AVERAGED = {"avg_temp_c": "tavg_c", "avg_hdd18": "hdd18", "avg_cdd18": "cdd18"}


def gold_partials(silver: DataFrame, load: Column | str) -> DataFrame:
    """Silver rows of one load, combined by region, day and source."""
    sums = []
    for column in ("tavg_c", "hdd18", "cdd18", "prcp_mm"):
        sums += [F.sum(column).alias(f"sum_{column}"), F.count(column).alias(f"n_{column}")]
    limits = [r for r in SILVER_SUITE.rules if isinstance(r, InRange)]
    outside = F.lit(False)
    for rule in limits:
        c = F.col(rule.column)
        for test in ([] if rule.low is None else [c < rule.low]) + ([] if rule.high is None else [c > rule.high]):
            outside = outside | F.coalesce(test, F.lit(False))
    missing = F.col("location_id").isNull() | F.col("observation_date").isNull()
    grouped = silver.groupBy(*KEYS, "source").agg(
        *sums,
        F.bool_or(F.col("prcp_flag") == "Y").alias("wet"),
        F.count_if(outside | missing).alias("broken"),
    )
    label = load if isinstance(load, Column) else F.lit(load)
    return conform(grouped.withColumn("load", label.cast("string")), PARTIALS)


def failing_days(partials: DataFrame) -> DataFrame:
    """``ingest_date, violations`` of the days that break the silver contract, all loads
    together: rows outside a limit, or no measure at all."""
    days = partials.groupBy("ingest_date").agg(
        F.sum("broken").alias("violations"),
        (F.sum("n_tavg_c") + F.sum("n_prcp_mm")).alias("_present"),
    )
    return days.where("violations > 0 OR _present = 0").drop("_present")


def merged_gold(partials: DataFrame) -> DataFrame:
    """Gold rows from the partial rows of any number of loads."""

    def mean(column: str) -> Column:
        return F.try_divide(F.sum(f"sum_{column}"), F.sum(f"n_{column}"))

    rows = partials.groupBy(*KEYS).agg(
        F.min("source").alias("source"),
        F.sum("sum_prcp_mm").alias("total_prcp_mm"),
        F.when(F.bool_or("wet"), "Y").when(~F.bool_or("wet"), "N").alias("had_precip"),
        *[mean(column).alias(name) for name, column in _AVERAGED.items()],
    )
    return rows.withColumnRenamed("location_id", "region_id").select(*GOLD.names)


def partials_at(path: str) -> Table:
    """The stored partials: a folder for each day and load, so that a load that runs again
    replaces its own rows and a day is read alone."""
    return Table(PARTIALS, ("ingest_date", "load"), path=path)


SKETCHES = "ingest_date date, regions binary"


def region_sketches(gold: DataFrame, log_buckets: int = 12) -> DataFrame:
    """A sketch of each day's regions: a few kilobytes, whatever their number.

    The relative standard error of an estimate is about 0.83 / sqrt(2 ** log_buckets).
    """
    return gold.groupBy("ingest_date").agg(
        F.hll_sketch_agg("region_id", F.lit(log_buckets)).alias("regions")
    )


def distinct_regions(sketches: DataFrame, *by: Column | str) -> DataFrame:
    """``<by>, regions``: the estimated number of distinct regions over any days, from
    their sketches alone."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("regions")).alias("regions"))
