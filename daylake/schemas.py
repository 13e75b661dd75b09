"""The four table schemas, in storage order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(*fields: tuple) -> StructType:
    return StructType([StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


_TEXT, _DAY, _NUM = StringType(), DateType(), DoubleType()

LOCATIONS = _schema(("location_id", _TEXT), ("latitude", _NUM), ("longitude", _NUM))

BRONZE = _schema(
    ("source", _TEXT, False),
    ("location_id", _TEXT, False),
    ("observation_date", _DAY, False),
    ("ingest_date", _DAY, False),
    ("tavg_c", _NUM),
    ("prcp_mm", _NUM),
    ("latitude", _NUM),
    ("longitude", _NUM),
    ("ingested_at", TimestampType(), False),
)

SILVER = _schema(
    ("location_id", _TEXT),
    ("source", _TEXT),
    ("observation_date", _DAY),
    ("ingest_date", _DAY),
    ("tavg_c", _NUM),
    ("prcp_mm", _NUM),
    ("latitude", _NUM),
    ("longitude", _NUM),
    ("hdd18", _NUM),
    ("cdd18", _NUM),
    ("gdd10_30", _NUM),
    ("prcp_flag", _TEXT),
    ("ingested_at", TimestampType()),
)

GOLD = _schema(
    ("region_id", _TEXT),
    ("observation_date", _DAY),
    ("ingest_date", _DAY),
    ("source", _TEXT),
    ("avg_temp_c", _NUM),
    ("total_prcp_mm", _NUM),
    ("had_precip", _TEXT),
    ("avg_hdd18", _NUM),
    ("avg_cdd18", _NUM),
)

SERVING = _schema(
    ("region_id", _TEXT),
    ("source", _TEXT),
    ("observation_date", _DAY),
    ("ingest_date", _DAY),
    ("avg_temp_c", _NUM),
    ("total_prcp_mm", _NUM),
    ("had_precip", _TEXT),
    ("avg_hdd18", _NUM),
    ("avg_cdd18", _NUM),
)

# Serving store with 32-bit measures.
SERVING_FLOAT32 = StructType(
    [
        StructField(f.name, FloatType() if isinstance(f.dataType, DoubleType) else f.dataType, True)
        for f in SERVING
    ]
)

# The serving table as stored by month.
SERVING_BY_MONTH = StructType([*SERVING, StructField("month", IntegerType(), True)])

# Sums and counts of a load, by region, day and source: what gold and the silver contract
# of a day follow from.
PARTIALS = StructType(
    [
        *_schema(("location_id", _TEXT), ("observation_date", _DAY), ("source", _TEXT)),
        *[
            StructField(f"{kind}_{measure}", _NUM if kind == "sum" else LongType(), True)
            for measure in ("tavg_c", "hdd18", "cdd18", "prcp_mm")
            for kind in ("sum", "n")
        ],
        *_schema(("wet", BooleanType()), ("broken", LongType()), ("ingest_date", _DAY), ("load", _TEXT)),
    ]
)

# A landed reply of the daily weather service: parallel arrays, one entry a day.
DAILY_REPLY = _schema(
    (
        "daily",
        _schema(
            ("time", ArrayType(_TEXT)),
            ("temperature_2m_mean", ArrayType(_NUM)),
            ("precipitation_sum", ArrayType(_NUM)),
        ),
    ),
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` to the columns of ``schema``, in its order and types."""
    return df.selectExpr(
        *[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema]
    )
