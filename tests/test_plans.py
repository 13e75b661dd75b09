"""The physical plans we rely on at scale."""

import re

import pytest

from daylake import registry
from daylake.operators import alerts, contracts, serving
from daylake.operators.days import DayRange, location_date_grid, missing_days
from daylake.operators.gold import gold_summary
from daylake.operators.rolling import rolling_windows
from daylake.operators.silver import silver_features
from daylake.plans.lake import Lake, in_range
from daylake.sinks.tables import replace_partitions
from daylake.sources.tables import day_partition
from fixtures import day, two_locations_three_days


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(df, operator: str) -> int:
    return len(re.findall(rf"(?<![A-Za-z]){operator}", plan(df)))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lake.at_path(str(tmp_path_factory.mktemp("plans")))
    bronze = two_locations_three_days(spark)
    replace_partitions(bronze, lake.bronze)
    replace_partitions(silver_features(bronze), lake.silver)
    replace_partitions(gold_summary(silver_features(bronze)), lake.gold)
    return lake


def test_day_filters_prune_partitions(spark, lake):
    one = in_range(lake.bronze.read(spark), DayRange(day(1), day(1)))
    assert "PartitionFilters: [isnotnull(ingest_date" in plan(silver_features(one))
    scan = day_partition(lake.gold.read(spark), day(2), "ingest_date")
    assert "PartitionFilters: [isnotnull(ingest_date" in plan(scan)
    pushed = day_partition(lake.gold.read(spark), day(2))
    assert "EqualTo(observation_date,2024-01-02)" in plan(pushed)


@pytest.mark.parametrize(
    "name", ["partition_scan", "region_snapshot", "region_history", "latest_first"]
)
def test_registered_scans_prune_partitions(spark, sf_dir, name):
    text = plan(registry.all_queries()[name](spark, sf_dir))
    assert "PartitionFilters: [isnotnull(ingest_date" in text


def test_silver_is_map_only(spark, lake):
    assert count(silver_features(lake.bronze.read(spark)), "Exchange") == 0


def test_gold_never_sorts_its_input_rows(spark, lake):
    silver = lake.silver.read(spark)
    listed = gold_summary(silver, ["openmeteo"])
    assert count(listed, "SortAggregate") == 0 and count(listed, "Exchange") == 1
    general = plan(gold_summary(silver))
    # The lowest aggregate, over all rows, is hashed and partial.
    assert re.findall(r"(\w+Aggregate)\(", general)[-1] == "HashAggregate"
    assert "latitude" not in plan(listed) and "gdd10_30" not in plan(listed)


def test_rolling_frames_share_one_exchange_and_sort(spark, lake):
    rolled = rolling_windows(lake.gold.read(spark))
    assert count(rolled, "Exchange") == 1 and count(rolled, "Sort ") == 1
    assert count(rolled, "Window ") == 1
    one = plan(rolling_windows(lake.gold.read(spark), region="LOC1"))
    assert "EqualTo(region_id,LOC1)" in one
    assert "avg_hdd18" not in one


def test_report_is_one_pass_over_four_columns(spark, lake):
    report = contracts.contract_report(
        silver_features(lake.bronze.read(spark)), contracts.SILVER_SUITE, by="ingest_date"
    )
    text = plan(report)
    assert text.count("FileScan") == 1 and count(report, "Exchange") == 1
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "location_id", "observation_date", "tavg_c", "prcp_mm",
    }


def test_gate_broadcasts_only_dates(spark, lake):
    silver = lake.silver.read(spark)
    by_day = contracts.contract_report(silver, contracts.SILVER_SUITE)
    assert "BroadcastHashJoin" in plan(contracts.passing_rows(silver, by_day))
    by_place = contracts.contract_report(silver, contracts.SILVER_SUITE, by="location_id")
    kept = contracts.passing_rows(silver, by_place, by="location_id")
    assert "ResolvedHint" not in kept._jdf.queryExecution().analyzed().toString()


def test_sample_limits_rows_before_the_shuffle(spark, lake):
    sample = contracts.contract_sample(
        lake.silver.read(spark), contracts.SILVER_SUITE, ["location_id"]
    )
    below = plan(sample).split("Exchange hashpartitioning", 1)[1]
    assert "WindowGroupLimit" in below


def test_newest_dates_is_a_top_k(spark, lake):
    newest = serving.available_dates(lake.gold.read(spark), 3)
    assert "TakeOrderedAndProject" in plan(newest)


def test_grid_needs_no_shuffle(spark):
    places = spark.createDataFrame([("A",)], "location_id string")
    grid = location_date_grid(places, day(1), day(9))
    assert "Exchange" not in plan(grid) and "Join" not in plan(grid)


def test_missing_days_reads_no_columns(spark, lake):
    text = plan(missing_days(lake.bronze.read(spark), day(1), day(9), "ingest_date"))
    assert "ReadSchema: struct<>" in text


def test_absence_combines_before_the_window(spark, sf_dir):
    events = registry.table(spark, sf_dir, "events")
    text = plan(alerts.gaps(events, ["user_id"]))
    assert re.findall(r"(\w+)\(keys?=", text)[-1] == "HashAggregate"
    assert text.index("Window ") < text.index("HashAggregate")


def test_tumbling_counts_combine_map_side(spark, sf_dir):
    events = registry.table(spark, sf_dir, "events")
    text = plan(alerts.count_above(events, 5, 60, ["user_id"]))
    assert text.count("HashAggregate") == 2 and "ReadSchema: struct<ts:timestamp_ntz,user_id" in text


@pytest.mark.parametrize("name", ["parse_payload_arrays", "parse_first_reading"])
def test_a_reply_is_parsed_once(spark, sf_dir, name):
    df = registry.all_queries()[name](spark, sf_dir)
    # One more from_json makes the replies out of the events.
    assert len(re.findall(r"from_json\(StructField\(daily", plan(df))) == 1
