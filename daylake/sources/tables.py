"""Day-partitioned tables: addressing, reading and existence tests."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from daylake.errors import DataSourceUnavailable
from daylake.functions.dates import day_literal
from daylake.schemas import conform

_MISSING = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND"}


@dataclass(frozen=True)
class Table:
    """A partitioned table, addressed by catalog name, by path, or both.

    With a name, the table is a catalog table (``path`` is then its location, if
    given).  With only a path it is a partitioned directory of files.
    ``sort_by`` clusters rows inside each file, so that row-group statistics
    let a filter on those columns skip data.  ``bucket_by`` (catalog tables only) deals
    rows to ``buckets`` by the hash of those columns: work by them needs no shuffle, and a
    filter on all of them reads one bucket.
    """

    schema: StructType
    partition_by: tuple[str, ...]
    name: str | None = None
    path: str | None = None
    sort_by: tuple[str, ...] = ()
    provider: str = "parquet"
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0

    def __post_init__(self) -> None:
        if not (self.name or self.path):
            raise ValueError("a table needs a name or a path")
        if self.bucket_by and not (self.name and self.buckets > 0 and self.sort_by):
            raise ValueError("buckets need a catalog table, their number and an order")
        unknown = {*self.partition_by, *self.sort_by, *self.bucket_by} - set(self.schema.names)
        if unknown:
            raise ValueError(f"columns not in the schema: {sorted(unknown)}")

    @property
    def label(self) -> str:
        return self.name or str(self.path)

    def _scan(self, spark: SparkSession) -> DataFrame:
        if self.name:
            return spark.read.table(self.name)
        return spark.read.format(self.provider).schema(self.schema).load(self.path)

    def exists(self, spark: SparkSession) -> bool:
        if self.name:
            return spark.catalog.tableExists(self.name)
        return self.read_if_exists(spark) is not None

    def read_if_exists(self, spark: SparkSession) -> DataFrame | None:
        """The table, or None when it is missing; any other error is raised."""
        try:
            return conform(self._scan(spark), self.schema)
        except AnalysisException as error:
            if error.getCondition() in _MISSING:
                return None
            raise

    def read(self, spark: SparkSession) -> DataFrame:
        found = self.read_if_exists(spark)
        if found is None:
            raise DataSourceUnavailable(f"table {self.label} does not exist; run its load first")
        return found


def day_partition(df: DataFrame, day: date | str, column: str = "observation_date") -> DataFrame:
    """Rows of one day."""
    return df.where(F.col(column) == day_literal(day))


def read_day(
    spark: SparkSession, table: Table, day: date | str, column: str = "observation_date"
) -> DataFrame | None:
    """Rows of one day, or None when there are none (one early-stopping probe)."""
    rows = day_partition(table.read(spark), day, column)
    return None if rows.isEmpty() else rows


def has_day(
    spark: SparkSession, table: Table, day: date | str, column: str = "observation_date"
) -> bool:
    """Whether the table exists and holds at least one row for the day."""
    found = table.read_if_exists(spark)
    return found is not None and not day_partition(found, day, column).isEmpty()


def run_query(
    spark: SparkSession,
    sql: str,
    parameters: Mapping[str, Any] | None = None,
    *,
    requires: Iterable[str] = (),
) -> DataFrame:
    """SQL with typed ``:name`` parameters; missing required tables are reported first."""
    missing = [name for name in requires if not spark.catalog.tableExists(name)]
    if missing:
        raise DataSourceUnavailable(f"required tables do not exist: {missing}")
    return spark.sql(sql, args=dict(parameters or {}))
