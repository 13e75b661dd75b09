"""The location dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daylake.schemas import LOCATIONS


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV of ``location_id, latitude, longitude``.

    Blank lines are skipped and surrounding blanks trimmed.  A coordinate that
    is not a number is an error, not a silent null.
    """
    return (
        spark.read.schema(LOCATIONS)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )
