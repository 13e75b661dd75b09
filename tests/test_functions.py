from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from daylake import functions as fn
from daylake.naming import namespace, table_name


def _values(spark, temps, *expressions):
    df = spark.createDataFrame([(t,) for t in temps], "t double")
    return [tuple(r) for r in df.select(*expressions).collect()]


@pytest.mark.parametrize("temp, expected", [(10.0, 8.0), (20.0, 0.0)])
def test_heating_degree_days(spark, temp, expected):
    assert _values(spark, [temp], fn.heating_degree_days("t")) == [(expected,)]


@pytest.mark.parametrize("temp, expected", [(25.0, 7.0), (10.0, 0.0)])
def test_cooling_degree_days(spark, temp, expected):
    assert _values(spark, [temp], fn.cooling_degree_days("t")) == [(expected,)]


@pytest.mark.parametrize("temp, expected", [(5.0, 0.0), (35.0, 20.0), (20.0, 10.0)])
def test_growing_degree_days(spark, temp, expected):
    assert _values(spark, [temp], fn.growing_degree_days("t")) == [(expected,)]


def test_missing_temperature_is_zero_or_null(spark):
    makers = [fn.heating_degree_days, fn.cooling_degree_days, fn.growing_degree_days]
    assert _values(spark, [None], *[m("t") for m in makers]) == [(0.0, 0.0, 0.0)]
    as_null = [m("t", missing_as_zero=False) for m in makers]
    assert _values(spark, [None], *as_null) == [(None, None, None)]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-80, 80), min_size=1, max_size=50), st.floats(0, 15), st.floats(16, 40))
def test_features_against_plain_python(spark, temps, low, high):
    got = _values(
        spark,
        temps,
        fn.heating_degree_days("t", low),
        fn.cooling_degree_days("t", low),
        fn.growing_degree_days("t", low, high),
    )
    want = [(max(low - t, 0), max(t - low, 0), max(min(t, high), low) - low) for t in temps]
    assert got == want


def test_precipitation_flag(spark):
    got = _values(spark, [0.0, 0.1, None, -1.0], fn.precipitation_flag("t"))
    assert got == [("N",), ("Y",), ("N",), ("N",)]


def test_nan_as_null(spark):
    assert _values(spark, [float("nan"), 1.0, None], fn.nan_as_null("t")) == [(None,), (1.0,), (None,)]


def test_date_forms(spark):
    row = spark.range(1).select(
        fn.parse_date(F.lit("2024-03-09")).alias("d"),
        fn.try_parse_date(F.lit("soon")).alias("bad"),
    ).select("d", "bad", fn.iso_date("d"), fn.partition_suffix("d"), fn.month_key("d")).first()
    assert tuple(row) == (date(2024, 3, 9), None, "2024-03-09", "20240309", 202403)


def test_table_names():
    assert namespace("pre-prod", "gold") == "pre_prod_gold"
    assert table_name("dev", "silver", "t") == "dev_silver.t"
    assert table_name("dev", "silver", "t", "cat") == "cat.dev_silver.t"
