"""Silver: bronze rows with degree days and a precipitation flag."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from daylake.functions import (
    cooling_degree_days,
    growing_degree_days,
    heating_degree_days,
    precipitation_flag,
)
from daylake.schemas import SILVER


def silver_features(
    bronze: DataFrame,
    *,
    base: float = 18.0,
    growing_range: tuple[float, float] = (10.0, 30.0),
    missing_as_zero: bool = True,
) -> DataFrame:
    """The silver columns for every bronze row.

    One projection inside the scan's codegen stage; a partition filter on the
    result reaches the bronze scan.
    """
    features = {
        "hdd18": heating_degree_days("tavg_c", base, missing_as_zero=missing_as_zero),
        "cdd18": cooling_degree_days("tavg_c", base, missing_as_zero=missing_as_zero),
        "gdd10_30": growing_degree_days(
            "tavg_c", *growing_range, missing_as_zero=missing_as_zero
        ),
        "prcp_flag": precipitation_flag("prcp_mm"),
    }
    return bronze.select([features.get(n, F.col(n)).alias(n) for n in SILVER.names])
