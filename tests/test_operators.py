from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from daylake.operators import serving
from daylake.operators.days import (
    BackfillRequest,
    DayRange,
    date_spine,
    location_date_grid,
    missing_days,
    retention_tiers,
    safety_cutoff,
)
from daylake.operators.gold import gold_summary
from daylake.operators.rolling import rolling_windows
from daylake.operators.shaping import json_records, serving_shape
from daylake.operators.silver import silver_features
from daylake.schemas import GOLD, SERVING, SERVING_FLOAT32, SILVER
from fixtures import bronze_frame, day, rows, two_locations_three_days


def _gold(spark):
    return gold_summary(silver_features(two_locations_three_days(spark)))


def test_silver_features(spark):
    silver = silver_features(two_locations_three_days(spark))
    assert silver.columns == SILVER.names
    got = rows(silver, "location_id", "observation_date", "hdd18", "cdd18", "gdd10_30", "prcp_flag")
    assert got == [
        ("LOC1", day(1), 8.0, 0.0, 0.0, "N"),
        ("LOC1", day(2), 0.0, 0.0, 0.0, "Y"),
        ("LOC1", day(3), 0.0, 0.0, 8.0, "N"),
        ("LOC2", day(1), 0.0, 7.0, 15.0, "Y"),
        ("LOC2", day(2), 0.0, 17.0, 20.0, "N"),
        ("LOC2", day(3), 13.0, 0.0, 0.0, "Y"),
    ]


@pytest.mark.parametrize("listed", [False, True])
def test_gold_groups(spark, listed):
    bronze = bronze_frame(
        spark,
        [
            ("A", 1, 10.0, 1.0, "s2"),
            ("A", 1, 20.0, None, "s1"),
            ("A", 1, None, 2.5, "s3"),
            ("B", 1, None, None, "s2"),
            ("B", 2, 30.0, 0.0, "s2"),
        ],
    )
    silver = silver_features(bronze)
    sources = ["s1", "s2", "s3"] if listed else None
    gold = gold_summary(silver, sources)
    assert [(f.name, f.dataType) for f in gold.schema] == [(f.name, f.dataType) for f in GOLD]
    assert rows(gold) == [
        ("A", day(1), day(1), "s1", 15.0, 3.5, "Y", 8.0 / 3, 2.0 / 3),
        ("B", day(1), day(1), "s2", None, None, "N", 0.0, 0.0),
        ("B", day(2), day(2), "s2", 30.0, 0.0, "N", 0.0, 12.0),
    ]


def test_gold_rejects_an_unlisted_source(spark):
    silver = silver_features(bronze_frame(spark, [("A", 1, 1.0, 1.0, "new")]))
    with pytest.raises(Exception, match="source not listed: new"):
        gold_summary(silver, ["old"]).collect()


def test_gold_has_one_plan_whatever_the_number_of_sources(spark):
    plans = set()
    for many in (5, 500):
        rows_ = [("A", 1, 1.0, 1.0, f"s{i:03d}") for i in range(many)]
        gold = gold_summary(silver_features(bronze_frame(spark, rows_)))
        assert rows(gold, "source", "total_prcp_mm") == [("s000", float(many))]
        plan = gold._jdf.queryExecution().executedPlan().toString()
        plans.add((plan.count("Exchange"), plan.count("HashAggregate"), plan.count("Sort")))
    assert len(plans) == 1


def test_rolling_frames_count_rows_not_days(spark):
    daily = spark.createDataFrame(
        [("R", day(n), float(n), float(n)) for n in (1, 2, 5, 6)] + [("S", day(1), 9.0, None)],
        "region_id string, observation_date date, avg_temp_c double, total_prcp_mm double",
    )
    got = rows(rolling_windows(daily, (2, 3)).where("region_id = 'R'"))
    assert got == [
        (day(1), "R", 1.0, 1.0, 1.0),
        (day(2), "R", 1.5, 3.0, 3.0),
        (day(5), "R", 3.5, 7.0, 8.0),
        (day(6), "R", 5.5, 11.0, 13.0),
    ]
    one = rolling_windows(daily, (2, 3), region="S")
    assert one.columns == ["observation_date", "region_id", "avg_temp_2d", "prcp_2d", "prcp_3d"]
    assert rows(one) == [(day(1), "S", 9.0, None, None)]


def test_serving_queries(spark):
    gold = _gold(spark)
    assert [r[0] for r in serving.available_dates(gold, 2).collect()] == [day(3), day(2)]
    assert [r[0] for r in serving.regions(gold).collect()] == ["LOC1", "LOC2"]
    snapshot = serving.region_snapshot(gold, day(1))
    assert [tuple(r) for r in snapshot.collect()] == [
        ("LOC1", 10.0, 0.0, "N", 8.0, 0.0, day(1)),
        ("LOC2", 25.0, 1.5, "Y", 0.0, 7.0, day(1)),
    ]
    assert tuple(serving.snapshot_totals(gold, day(1)).first()) == (2, 1.5, 17.5)
    assert serving.snapshot_totals(snapshot, approximate=True).first().regions == 2
    history = serving.region_history(gold, "LOC2", 1, as_of=day(3))
    assert [r.observation_date for r in history.collect()] == [day(2), day(3)]
    newest = serving.region_history(gold, "LOC2", as_of=day(31), newest_first=True)
    assert [r.observation_date for r in newest.collect()] == [day(3), day(2), day(1)]
    first = serving.head_rows(gold, ["region_id", "observation_date"], 1).first()
    assert (first.region_id, first.observation_date) == ("LOC1", day(1))


def test_history_of_thirty_days_spans_thirty_one(spark):
    daily = spark.range(60).select(
        F.lit("R").alias("region_id"),
        F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")).alias("observation_date"),
        *[F.lit(1.0).alias(c) for c in serving.MEASURES],
    )
    assert serving.region_history(daily, "R", 30, as_of=date(2024, 2, 20)).count() == 31


def test_shapes(spark):
    gold = _gold(spark)
    assert [(f.name, f.dataType) for f in serving_shape(gold).schema] == [
        (f.name, f.dataType) for f in SERVING
    ]
    assert serving_shape(gold, float32=True).dtypes == [
        (f.name, f.dataType.simpleString()) for f in SERVING_FLOAT32
    ]
    texts = [r.value for r in json_records(gold.where("region_id = 'LOC1'")).collect()]
    assert any('"observation_date":"2024-01-02"' in t and '"avg_temp_c":null' in t for t in texts)


def test_days(spark):
    assert DayRange.lookback(7, date(2024, 1, 20)) == DayRange(date(2024, 1, 13), date(2024, 1, 20))
    assert DayRange.lookback(0).start == date.today()
    with pytest.raises(ValueError):
        DayRange(day(2), day(1))
    spine = [r[0] for r in date_spine(spark, "2024-02-27", "2024-03-01").collect()]
    assert spine == [date(2024, 2, 27), date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]


def test_backfill_request():
    one = BackfillRequest.from_mapping({"start": "2024-01-03"})
    assert one.days == DayRange(day(3), day(3)) and one.location_set == "data/locations.csv"
    two = BackfillRequest.from_mapping({"start": "2024-01-03", "end": "2024-01-05", "location_set": "x"})
    assert two.days.end == day(5) and two.location_set == "x"
    with pytest.raises(ValueError, match="end date"):
        BackfillRequest.from_mapping({"start": "2024-01-03", "end": "2024-01-02"})
    with pytest.raises(KeyError):
        BackfillRequest.from_mapping({})


def test_grid_and_missing_days(spark):
    places = spark.createDataFrame([("A",), ("B",)], "location_id string")
    assert location_date_grid(places, day(1), day(3)).count() == 6
    present = two_locations_three_days(spark).where("observation_date <> DATE '2024-01-02'")
    assert rows(missing_days(present, day(1), day(4))) == [(day(2),), (day(4),)]


def test_retention_tiers(spark):
    inventory = spark.createDataFrame(
        [(layer, day(1)) for layer in ("bronze", "silver", "gold", "other")],
        "layer string, observation_date date",
    )
    at = {n: dict(rows(retention_tiers(inventory, day(1) + timedelta(days=n)), "layer", "tier"))
          for n in (59, 60, 120, 365)}
    assert at[59]["bronze"] == "standard" and at[60]["bronze"] == "cold"
    assert at[60]["silver"] == "standard" and at[120]["silver"] == "cold"
    assert at[120]["gold"] == "standard" and at[365]["gold"] == "cold"
    assert at[365]["other"] == "standard"


def test_safety_cutoff():
    assert safety_cutoff(datetime(2024, 1, 8, 5)) == datetime(2024, 1, 1, 5)
