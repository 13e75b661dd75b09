"""Row shapes of the serving stores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DateType

from daylake.functions import iso_date
from daylake.schemas import SERVING, SERVING_FLOAT32, conform


def serving_shape(gold: DataFrame, *, float32: bool = False) -> DataFrame:
    """Serving columns in serving order; measures as 32-bit floats on request."""
    return conform(gold, SERVING_FLOAT32 if float32 else SERVING)


def dates_as_text(df: DataFrame) -> DataFrame:
    """Every date column as ``YYYY-MM-DD`` text."""
    dates = {f.name for f in df.schema if isinstance(f.dataType, DateType)}
    return df.select([iso_date(c).alias(c) if c in dates else F.col(c) for c in df.columns])


def json_records(df: DataFrame, beside: Sequence[str] = ()) -> DataFrame:
    """One JSON object per row in column ``value``, ready for ``write.text``; columns
    ``beside`` it may serve as partitions.

    Missing values stay in the record as JSON nulls.
    """
    record = F.struct(*dates_as_text(df).columns)
    return dates_as_text(df).select(
        F.to_json(record, {"ignoreNullFields": "false"}).alias("value"), *beside
    )
