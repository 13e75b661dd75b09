"""Data contracts, evaluated as one aggregate over all partitions.

A contract is a list of rules; each rule yields named violation counts.  All
rules of a suite are counted in a single pass, grouped by partition (a day), with
map-side combining, so a day holding much of the data costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType, StructType

from daylake.errors import ContractViolation


def _missing(column: str, schema: StructType) -> Column:
    c = F.col(column)
    if isinstance(schema[column].dataType, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


@dataclass(frozen=True)
class Required:
    """No missing value in any of ``columns``."""

    columns: tuple[str, ...]

    def checks(self, schema: StructType) -> list[tuple[str, str, Column]]:
        return [("required", c, F.count_if(_missing(c, schema))) for c in self.columns]


@dataclass(frozen=True)
class NotAllMissing:
    """At least one present value across all of ``columns`` together."""

    columns: tuple[str, ...]

    def checks(self, schema: StructType) -> list[tuple[str, str, Column]]:
        present = F.lit(0).cast("long")
        for c in self.columns:
            present = present + F.count_if(~_missing(c, schema))
        count = F.when(present == 0, F.count(F.lit(1))).otherwise(F.lit(0).cast("long"))
        return [("not_all_missing", "+".join(self.columns), count)]


@dataclass(frozen=True)
class InRange:
    """Present values within ``[low, high]``; missing values pass."""

    column: str
    low: float | None = None
    high: float | None = None

    def checks(self, schema: StructType) -> list[tuple[str, str, Column]]:
        c, missing = F.col(self.column), _missing(self.column, schema)
        bounds = [("min", self.low, c < self.low), ("max", self.high, c > self.high)]
        # NaN is above every number in Spark, so it has to be excluded here.
        return [
            (rule, self.column, F.count_if(outside & ~missing))
            for rule, bound, outside in bounds
            if bound is not None
        ]


@dataclass(frozen=True)
class Suite:
    """Named rules, in the order in which they are reported."""

    name: str
    rules: tuple

    def checks(self, schema: StructType) -> list[tuple[str, str, Column]]:
        return [check for rule in self.rules for check in rule.checks(schema)]


# Physical limits of a daily mean temperature and of precipitation.
SILVER_SUITE = Suite(
    "silver_climate_daily_features",
    (
        Required(("location_id", "observation_date")),
        NotAllMissing(("tavg_c", "prcp_mm")),
        InRange("tavg_c", -90.0, 60.0),
        InRange("prcp_mm", 0.0),
    ),
)

GOLD_SUITE = Suite(
    "gold_climate_daily_summary",
    (
        Required(("region_id", "observation_date")),
        InRange("total_prcp_mm", 0.0),
        NotAllMissing(("avg_temp_c",)),
    ),
)


def contract_report(df: DataFrame, suite: Suite, by: str = "observation_date") -> DataFrame:
    """``suite, <by>, partition_key, rule_order, rule, column_name, violations, passed``:
    one row per partition and check."""
    checks = suite.checks(df.schema)
    counts = [count.alias(f"_v{i}") for i, (_, _, count) in enumerate(checks)]
    per_partition = df.groupBy(by).agg(*counts)
    lines = F.array(
        *[
            F.struct(
                F.lit(i).alias("rule_order"),
                F.lit(rule).alias("rule"),
                F.lit(column).alias("column_name"),
                F.col(f"_v{i}").alias("violations"),
            )
            for i, (rule, column, _) in enumerate(checks)
        ]
    )
    return per_partition.select(by, F.explode(lines).alias("_c")).select(
        F.lit(suite.name).alias("suite"),
        F.col(by),
        F.col(by).cast("string").alias("partition_key"),
        "_c.rule_order",
        "_c.rule",
        "_c.column_name",
        "_c.violations",
        (F.col("_c.violations") == 0).alias("passed"),
    )


def _failed_keys(report: DataFrame, by: str) -> DataFrame:
    failed = report.where(~F.col("passed")).select(F.col(by).alias("_failed")).distinct()
    # A date column has under four million values whatever the data's size (a few
    # tens of megabytes), so this side is safe to broadcast.  Other partition types
    # have no such bound and are left to the optimizer.
    if isinstance(report.schema[by].dataType, DateType):
        failed = F.broadcast(failed)
    return failed


def passing_rows(df: DataFrame, report: DataFrame, by: str = "observation_date") -> DataFrame:
    """Rows of the partitions that passed every check."""
    failed = _failed_keys(report, by)
    return df.join(failed, df[by].eqNullSafe(failed["_failed"]), "left_anti")


def failing_rows(df: DataFrame, report: DataFrame, by: str = "observation_date") -> DataFrame:
    """Rows of the partitions that failed a check (the quarantine)."""
    failed = _failed_keys(report, by)
    return df.join(failed, df[by].eqNullSafe(failed["_failed"]), "left_semi")


def enforce(report: DataFrame, shown: int = 20) -> None:
    """Raise :class:`ContractViolation` if any check failed.

    The message names the first ``shown`` failing checks by day and rule order,
    and counts the rest; the error's ``report`` is the whole report.
    """
    failed = report.where(~F.col("passed"))
    first = failed.orderBy("partition_key", "rule_order").limit(shown).collect()
    if not first:
        return
    total = len(first) if len(first) < shown else failed.count()
    raise ContractViolation(
        first[0]["suite"],
        [(r["partition_key"], r["rule"], r["column_name"], r["violations"]) for r in first],
        total,
        report,
    )


def contract_sample(
    df: DataFrame,
    suite: Suite | str,
    order_by: Sequence[str] = (),
    by: str = "observation_date",
    n: int = 5,
) -> DataFrame:
    """The first ``n`` rows of each partition, with ``suite`` and ``partition_key``.

    The rank filter is applied inside every map task before the shuffle, so a task
    sends at most ``n`` rows per partition.  ``order_by`` makes the choice
    repeatable, at the price of a full sort of each task's rows; without it any
    ``n`` rows are taken, and tasks sort by the partition value alone.
    """
    name = suite if isinstance(suite, str) else suite.name
    in_partition = Window.partitionBy(by).orderBy(*(order_by or [by]))
    ranked = df.withColumn("_rank", F.row_number().over(in_partition))
    return ranked.where(F.col("_rank") <= n).select(
        F.lit(name).alias("suite"), F.col(by).cast("string").alias("partition_key"), *df.columns
    )
