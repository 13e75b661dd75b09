"""Write, audit, publish: days of a catalog table are switched as a whole.

Rows are written once, to a new folder that no reader knows.  What the contract needs is
observed by that very write: for each check the days that break it.  Days that pass are
published by pointing the table's partitions at their new folders, a change of metadata
alone.  So a reader sees a day's old files or its new ones, a run that stops anywhere
leaves whole days, and nothing is computed a second time, whatever fails.

Folders that no partition points at any more are left for readers that still use them;
:func:`daylake.sinks.files.stray_files` finds them once they are old enough.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from daylake.operators.contracts import (
    GOLD_SUITE,
    SILVER_SUITE,
    InRange,
    NotAllMissing,
    Required,
    Suite,
    contract_report,
    enforce,
)
from daylake.operators.days import DayRange
from daylake.operators.gold import gold_summary
from daylake.operators.silver import silver_features
from daylake.plans.lake import Lake, OnFailure, in_range, release
from daylake.schemas import conform
from daylake.session import stage
from daylake.sinks.tables import ensure_table, export_parquet, lay_out, quoted, text_literal
from daylake.sources.tables import Table


def _missing(column: str, schema: StructType) -> Column:
    c = F.col(column)
    floating = isinstance(schema[column].dataType, (DoubleType, FloatType))
    return c.isNull() | F.isnan(c) if floating else c.isNull()


def _observed(suite: Suite, schema: StructType, by: str) -> list[Column]:
    """Sets of days: all, and for each check those with a row that breaks it (or, for
    :class:`NotAllMissing`, with a present value).

    A set does not change when a task runs twice, as a count would, and it is no larger
    than the calendar.
    """
    sets = [F.collect_set(by).alias("days")]
    for rule in suite.rules:
        if isinstance(rule, Required):
            tests = [_missing(c, schema) for c in rule.columns]
        elif isinstance(rule, NotAllMissing):
            tests = [~F.forall(F.array(*[_missing(c, schema) for c in rule.columns]), lambda m: m)]
        elif isinstance(rule, InRange):
            c, present = F.col(rule.column), ~_missing(rule.column, schema)
            bounds = [(rule.low, c < rule.low), (rule.high, c > rule.high)]
            tests = [outside & present for bound, outside in bounds if bound is not None]
        else:
            raise TypeError(f"no observation for rule {rule}")
        for test in tests:
            sets.append(F.collect_set(F.when(test, F.col(by))).alias(f"check_{len(sets) - 1}"))
    return sets


def _failed_days(suite: Suite, seen: dict) -> dict[int, set[date]]:
    """Failing days of each check, from the observed sets."""
    days, failed, i = set(seen["days"]), {}, 0
    for rule in suite.rules:
        width = (
            len(rule.columns) if isinstance(rule, Required)
            else 1 if isinstance(rule, NotAllMissing)
            else (rule.low is not None) + (rule.high is not None)
        )
        for _ in range(width):
            found = set(seen[f"check_{i}"])
            failed[i] = days - found if isinstance(rule, NotAllMissing) else found
            i += 1
    return failed


@dataclass(frozen=True)
class Written:
    """Rows in their new folder, with what the write observed."""

    folder: str
    days: set[date]
    failing: set[date]


def write_aside(df: DataFrame, table: Table, suite: Suite, *, keep_layout: bool = False) -> Written:
    """Write ``df`` to a new folder beside the table's, observing the contract."""
    (by,) = table.partition_by
    rows = conform(df, table.schema)
    if not keep_layout:
        rows = lay_out(rows, table.partition_by, table.sort_by)
    seen = Observation(f"contract-{uuid.uuid4().hex}")
    folder = f"{table.path.rstrip('/')}_loads/{uuid.uuid4().hex}"
    watched = rows.observe(seen, *_observed(suite, rows.schema, by))
    watched.write.mode("error").partitionBy(by).parquet(folder)
    found = seen.get
    failing = set().union(*_failed_days(suite, found).values())
    return Written(folder, set(found["days"]), failing)


def audit(spark: SparkSession, written: Written, table: Table, suite: Suite) -> DataFrame:
    """The contract report of what was written.

    Days that pass have no violation by what was observed; the others are counted in
    their own new files, which are all that is read.
    """
    (by,) = table.partition_by
    stored = spark.read.schema(table.schema).parquet(written.folder)
    checks = suite.checks(table.schema)
    passed = [
        (suite.name, day, str(day), i, rule, column, 0, True)
        for day in sorted(written.days - written.failing)
        for i, (rule, column, _) in enumerate(checks)
    ]
    counted = contract_report(stored.where(F.col(by).isin(sorted(written.failing))), suite, by=by)
    report = spark.createDataFrame(passed, counted.schema).union(counted) if written.failing else (
        spark.createDataFrame(passed, counted.schema)
    )
    return stage(report, "audit")


def publish_days(spark: SparkSession, written: Written, table: Table) -> None:
    """Point the partitions of the days that pass at their new folders.

    One statement adds the days that are new; an old one is switched by one statement of
    its own.  Both change metadata only, by day: running it again changes nothing.
    """
    ensure_table(spark, table)
    (by,) = table.partition_by
    name = quoted(table.name)
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}

    def spec(day: date) -> str:
        return f"PARTITION (`{by}` = DATE '{day}') "

    def folder(day: date) -> str:
        return "LOCATION " + text_literal(f"{written.folder}/{by}={day}")

    good = sorted(written.days - written.failing)
    fresh = [d for d in good if f"{by}={d}" not in known]
    if fresh:
        parts = " ".join(spec(d) + folder(d) for d in fresh)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
    for day in good:
        if day not in fresh:
            spark.sql(f"ALTER TABLE {name} {spec(day)} SET {folder(day)}")
    spark.sql(f"REFRESH TABLE {name}")


def _run(
    df: DataFrame, lake: Lake, table: Table, suite: Suite, on_failure: OnFailure, keep_layout: bool
) -> DataFrame:
    if not (table.name and table.path and table.provider == "parquet"):
        raise ValueError("switching days needs a Parquet catalog table with a path")
    if on_failure == "quarantine" and not lake.quarantine:
        raise ValueError("failing days need a quarantine folder, or they would be lost")
    spark = df.sparkSession
    written = write_aside(df, table, suite, keep_layout=keep_layout)
    report = audit(spark, written, table, suite)
    if written.failing and lake.quarantine:
        (by,) = table.partition_by
        stored = spark.read.schema(table.schema).parquet(written.folder)
        bad = stored.where(F.col(by).isin(sorted(written.failing)))
        export_parquet(bad, f"{lake.quarantine.rstrip('/')}/{suite.name}", [by])
    publish_days(spark, written, table)
    release(report, lake, suite)
    if on_failure == "raise":
        enforce(report)
    return report


def audited_silver(spark: SparkSession, lake: Lake, days: DayRange, *, on_failure: OnFailure = "raise") -> DataFrame:
    """Silver days of the range, written aside, audited and then published: bronze is
    scanned once.  Passing days are published, then failing ones raise (or stay in
    quarantine).  Returns the report.  For a lake in a catalog with paths."""
    silver = silver_features(in_range(lake.bronze.read(spark), days))
    return _run(silver, lake, lake.silver, SILVER_SUITE, on_failure, True)


def audited_gold(spark: SparkSession, lake: Lake, days: DayRange, *, on_failure: OnFailure = "raise") -> DataFrame:
    """Gold days of the range from the published silver, in the same way."""
    gold = gold_summary(in_range(lake.silver.read(spark), days))
    return _run(gold, lake, lake.gold, GOLD_SUITE, on_failure, False)
