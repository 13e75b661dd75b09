"""Gold: one row per region and day.

String minima and maxima force a sort-based aggregate, which sorts every input
row before the map-side combine.  Both string aggregates are therefore restated
so that Spark keeps to hash aggregation:

* ``had_precip`` (the greater of 'Y'/'N') is a boolean OR;
* ``source`` (the least name of the group) is found in a second step over rows
  already combined per (region, day, source); or, where the caller names all sources,
  it is the least code of that list, which saves the second step.

Rows are combined before every shuffle, so a region or day holding a large part
of the input sends at most one row per map task and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from daylake.schemas import GOLD

KEYS = ("location_id", "observation_date", "ingest_date")

def _flag(any_wet: Column) -> Column:
    return F.when(any_wet, F.lit("Y")).when(~any_wet, F.lit("N"))


def _one_step(silver: DataFrame, sources: Sequence[str]) -> DataFrame:
    names = sorted(set(sources), key=lambda s: s.encode("utf-8"))
    listed = F.array(*[F.lit(n) for n in names])
    code = F.array_position(listed, F.col("source"))
    known = F.when(code > 0, code).when(
        F.col("source").isNotNull(),
        F.raise_error(F.concat(F.lit("source not listed: "), F.col("source"))).cast("long"),
    )
    out = silver.groupBy(*KEYS).agg(
        F.min(known).alias("_source"),
        F.avg("tavg_c").alias("avg_temp_c"),
        F.sum("prcp_mm").alias("total_prcp_mm"),
        F.bool_or(F.col("prcp_flag") == "Y").alias("_wet"),
        F.avg("hdd18").alias("avg_hdd18"),
        F.avg("cdd18").alias("avg_cdd18"),
    )
    return out.withColumn("source", F.get(listed, F.col("_source").cast("int") - 1))


def _two_steps(silver: DataFrame) -> DataFrame:
    averaged = {"avg_temp_c": "tavg_c", "avg_hdd18": "hdd18", "avg_cdd18": "cdd18"}
    parts = [F.sum("prcp_mm").alias("_prcp"), F.bool_or(F.col("prcp_flag") == "Y").alias("_wet")]
    for column in averaged.values():
        parts += [F.sum(column).alias(f"_s_{column}"), F.count(column).alias(f"_n_{column}")]
    per_source = silver.groupBy(*KEYS, "source").agg(*parts)

    def mean(column: str) -> Column:
        return F.try_divide(F.sum(f"_s_{column}"), F.sum(f"_n_{column}"))

    return per_source.groupBy(*KEYS).agg(
        F.min("source").alias("source"),
        F.sum("_prcp").alias("total_prcp_mm"),
        F.bool_or("_wet").alias("_wet"),
        *[mean(column).alias(name) for name, column in averaged.items()],
    )


def gold_summary(silver: DataFrame, sources: Sequence[str] | None = None) -> DataFrame:
    """Average temperature and degree days, total precipitation and a rain flag
    per (region, day).  Nulls are skipped; an all-null group gives null.

    ``sources``, if the caller knows them, names every source that can occur; it saves
    the second aggregation step.  A name outside the list fails the job.
    """
    grouped = _one_step(silver, sources) if sources else _two_steps(silver)
    named = grouped.withColumn("had_precip", _flag(F.col("_wet"))).withColumnRenamed(
        "location_id", "region_id"
    )
    return named.select(*GOLD.names)
