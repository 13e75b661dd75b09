import pytest

from daylake.errors import ContractViolation
from daylake.operators.contracts import (
    GOLD_SUITE,
    SILVER_SUITE,
    InRange,
    Required,
    Suite,
    contract_report,
    contract_sample,
    enforce,
    failing_rows,
    passing_rows,
)
from daylake.operators.gold import gold_summary
from daylake.operators.silver import silver_features
from fixtures import bronze_frame, day, rows

NAN = float("nan")


def _silver(spark, *readings):
    return silver_features(bronze_frame(spark, readings))


def _failed(report):
    return rows(report.where("NOT passed"), "partition_key", "rule", "column_name", "violations")


@pytest.mark.parametrize(
    "temp, prcp, broken",
    [
        (-90.0, 0.0, None),
        (60.0, 0.0, None),
        (-90.1, 0.0, ("min", "tavg_c")),
        (60.1, 0.0, ("max", "tavg_c")),
        (1.0, -0.1, ("min", "prcp_mm")),
        (None, 1.0, None),
        (1.0, None, None),
        (None, None, ("not_all_missing", "tavg_c+prcp_mm")),
        (NAN, NAN, ("not_all_missing", "tavg_c+prcp_mm")),
        (NAN, 1.0, None),
    ],
)
def test_each_silver_rule_alone(spark, temp, prcp, broken):
    report = contract_report(_silver(spark, ("A", 1, temp, prcp)), SILVER_SUITE)
    want = [("2024-01-01", *broken, 1)] if broken else []
    assert _failed(report) == want


def test_one_bad_row_fails_its_day_only(spark):
    silver = _silver(spark, ("A", 1, 1.0, 0.0), ("B", 1, 99.0, 0.0), ("A", 2, 1.0, 0.0))
    report = contract_report(silver, SILVER_SUITE)
    assert report.count() == 12
    assert rows(passing_rows(silver, report), "observation_date") == [(day(2),)]
    assert rows(failing_rows(silver, report), "location_id") == [("A",), ("B",)]


def test_all_missing_needs_both_columns_on_the_whole_day(spark):
    silver = _silver(spark, ("A", 1, None, None), ("B", 1, None, 0.5), ("A", 2, None, None))
    assert _failed(contract_report(silver, SILVER_SUITE)) == [
        ("2024-01-02", "not_all_missing", "tavg_c+prcp_mm", 1)
    ]


def test_required_lists_every_column_and_keeps_a_null_partition(spark):
    df = spark.createDataFrame(
        [(None, None, 1.0), ("A", day(1), NAN)], "location_id string, observation_date date, x double"
    )
    suite = Suite("s", (Required(("location_id", "observation_date", "x")),))
    report = contract_report(df, suite)
    assert _failed(report) == [
        ("2024-01-01", "required", "x", 1),
        (None, "required", "location_id", 1),
        (None, "required", "observation_date", 1),
    ]
    assert passing_rows(df, report).isEmpty()
    assert failing_rows(df, report).count() == 2


def test_gold_suite(spark):
    gold = gold_summary(_silver(spark, ("A", 1, None, 1.0), ("A", 2, 1.0, -2.0)))
    assert _failed(contract_report(gold, GOLD_SUITE)) == [
        ("2024-01-01", "not_all_missing", "avg_temp_c", 1),
        ("2024-01-02", "min", "total_prcp_mm", 1),
    ]


def test_enforce_names_failures_and_counts_the_rest(spark):
    silver = _silver(spark, *[("A", n, 99.0, -1.0) for n in range(1, 6)])
    report = contract_report(silver, SILVER_SUITE)
    with pytest.raises(ContractViolation) as caught:
        enforce(report, shown=3)
    assert caught.value.total == 10 and len(caught.value.failures) == 3
    assert caught.value.failures[0] == ("2024-01-01", "max", "tavg_c", 1)
    assert "and 7 more" in str(caught.value)
    enforce(contract_report(_silver(spark, ("A", 1, 1.0, 1.0)), SILVER_SUITE))


def test_other_partition_types(spark):
    silver = _silver(spark, ("A", 1, 99.0, 0.0), ("B", 1, 1.0, 0.0))
    suite = Suite("hot", (InRange("tavg_c", high=60.0),))
    report = contract_report(silver, suite, by="location_id")
    assert rows(passing_rows(silver, report, by="location_id"), "location_id") == [("B",)]


def test_sample_takes_the_first_rows_of_each_day(spark):
    silver = _silver(spark, *[(f"L{i}", n, 1.0, 1.0) for n in (1, 2) for i in range(9)])
    sample = contract_sample(silver, SILVER_SUITE, ["location_id"])
    assert sample.columns[:2] == ["suite", "partition_key"]
    want = [(f"2024-01-0{n}", f"L{i}") for n in (1, 2) for i in range(5)]
    assert rows(sample, "partition_key", "location_id") == want
