import pytest

from daylake.errors import ContractViolation, DataSourceUnavailable, UnknownPlaces
from daylake.operators.days import BackfillRequest, DayRange
from daylake.plans.lake import (
    Lake,
    build_gold,
    build_silver,
    days_to_run,
    load_bronze,
    run_backfill,
    run_day,
    run_lookback,
    run_window,
    unknown_places_folder,
)
from daylake.schemas import BRONZE
from daylake.sinks.serving import DaySink, MonthSink, serving_by_day, serving_by_month
from daylake.sinks.tables import replace_partitions
from daylake.streaming.refresh import start_refresh
from fixtures import LOADED, bronze_frame, day, rows, two_locations_three_days

WEEK = DayRange(day(1), day(7))


def _lake(tmp_path, name="lake", **options):
    return Lake.at_path(str(tmp_path / name), **options)


def _tables(spark, lake):
    return rows(lake.silver.read(spark)), rows(lake.gold.read(spark))


def test_range_run_equals_days_one_by_one(spark, tmp_path):
    ranged, daily = _lake(tmp_path, "a"), _lake(tmp_path, "b")
    for lake in (ranged, daily):
        replace_partitions(two_locations_three_days(spark), lake.bronze)
    run_window(spark, ranged, WEEK)
    for n in (1, 2, 3, 4):
        run_day(spark, daily, day(n))
    assert _tables(spark, ranged) == _tables(spark, daily)
    run_window(spark, ranged, WEEK)  # a second run changes nothing
    assert _tables(spark, ranged) == _tables(spark, daily)
    assert len(_tables(spark, ranged)[1]) == 6


def test_rerun_of_one_day_leaves_the_others(spark, tmp_path):
    lake = _lake(tmp_path)
    replace_partitions(two_locations_three_days(spark), lake.bronze)
    run_window(spark, lake, WEEK)
    before = rows(lake.gold.read(spark).where("ingest_date <> DATE '2024-01-02'"))
    replace_partitions(bronze_frame(spark, [("LOC5", 2, 30.0, 9.0)]), lake.bronze)
    run_day(spark, lake, day(2))
    gold = lake.gold.read(spark)
    assert rows(gold.where("ingest_date <> DATE '2024-01-02'")) == before
    assert rows(gold.where("ingest_date = DATE '2024-01-02'"), "region_id") == [("LOC5",)]


def test_a_day_without_bronze_keeps_its_old_gold(spark, tmp_path):
    lake = _lake(tmp_path)
    replace_partitions(two_locations_three_days(spark), lake.bronze)
    run_window(spark, lake, WEEK)
    other = _lake(tmp_path, "other")
    replace_partitions(bronze_frame(spark, [("LOC1", 1, 1.0, 1.0)]), other.bronze)
    emptied = Lake(other.bronze, lake.silver, lake.gold)
    build_silver(spark, emptied, WEEK)
    assert lake.silver.read(spark).where("ingest_date = DATE '2024-01-03'").count() == 2


def test_lookback_runs_n_plus_one_days(spark, tmp_path):
    lake = _lake(tmp_path)
    replace_partitions(bronze_frame(spark, [("A", n, 1.0, 1.0) for n in range(1, 8)]), lake.bronze)
    run_lookback(spark, lake, 2, as_of=day(6))
    assert rows(lake.gold.read(spark), "observation_date") == [(day(4),), (day(5),), (day(6),)]


def test_failing_day_is_not_written_and_raises(spark, tmp_path):
    lake = _lake(tmp_path, samples=str(tmp_path / "samples"))
    replace_partitions(
        bronze_frame(spark, [("A", 1, 1.0, 1.0), ("A", 2, 99.0, 1.0), ("B", 2, 1.0, 1.0)]),
        lake.bronze,
    )
    with pytest.raises(ContractViolation, match="2024-01-02: max\\(tavg_c\\)"):
        run_window(spark, lake, WEEK)
    assert rows(lake.silver.read(spark), "location_id", "observation_date") == [("A", day(1))]
    assert not lake.gold.exists(spark)
    # The sample is written before the checks, so it shows the failing day too.
    sampled = spark.read.parquet(str(tmp_path / "samples")).where("tavg_c = 99")
    assert sampled.count() == 1


def test_quarantine_keeps_the_failing_rows_and_goes_on(spark, tmp_path):
    lake = _lake(tmp_path, quarantine=str(tmp_path / "bad"))
    replace_partitions(
        bronze_frame(spark, [("A", 1, 1.0, 1.0), ("A", 2, 99.0, 1.0), ("B", 2, 1.0, 1.0)]),
        lake.bronze,
    )
    run_window(spark, lake, WEEK, on_failure="quarantine")
    assert rows(lake.gold.read(spark), "observation_date") == [(day(1),)]
    bad = spark.read.parquet(str(tmp_path / "bad" / "silver_climate_daily_features"))
    assert rows(bad, "location_id") == [("A",), ("B",)]


def test_quarantine_needs_a_folder(spark, tmp_path):
    lake = _lake(tmp_path)
    replace_partitions(bronze_frame(spark, [("A", 1, 99.0, 1.0)]), lake.bronze)
    with pytest.raises(ValueError, match="quarantine folder"):
        run_window(spark, lake, WEEK, on_failure="quarantine")


def test_failing_and_repaired_days(spark, tmp_path):
    """A failing day keeps its old rows, goes no further, and leaves when repaired."""
    sink = DaySink(serving_by_day(path=str(tmp_path / "by-day")))
    lake = _lake(tmp_path, quarantine=str(tmp_path / "bad"), targets={"default": sink})
    folder = tmp_path / "bad" / "silver_climate_daily_features" / "ingest_date=2024-01-02"
    seen = []
    for warm in (5.0, 99.0, 6.0):
        days = [("A", 1, warm if warm < 50 else 1.0, 1.0), ("A", 2, warm, 1.0)]
        replace_partitions(bronze_frame(spark, days), lake.bronze)
        reports = run_window(spark, lake, WEEK, on_failure="quarantine")
        failed = rows(reports.silver.where("not passed").select("partition_key").distinct())
        shown = {r["observation_date"]: r["avg_temp_c"] for r in sink.table.read(spark).collect()}
        seen.append((failed, shown[day(1)], shown[day(2)], folder.exists()))
    assert seen == [
        ([], 5.0, 5.0, False),
        ([("2024-01-02",)], 1.0, 5.0, True),
        ([], 6.0, 6.0, False),
    ]


def test_gold_contract_gates_gold(spark, tmp_path):
    lake = _lake(tmp_path)
    replace_partitions(
        bronze_frame(spark, [("A", 1, None, 1.0), ("A", 2, 1.0, 1.0)]), lake.bronze
    )
    build_silver(spark, lake, WEEK)
    with pytest.raises(ContractViolation, match="avg_temp_c"):
        build_gold(spark, lake, WEEK)
    assert rows(lake.gold.read(spark), "observation_date") == [(day(2),)]


READINGS = "location_id string, observation_date date, tavg_c double, prcp_mm double"


def test_backfill_from_readings_to_serving(spark, tmp_path):
    (tmp_path / "places.csv").write_text("location_id,latitude,longitude\nA,1.5,2.5\nB,3.5,4.5\n")
    lake = _lake(
        tmp_path,
        env="prod",
        exports=str(tmp_path / "exports"),
        quarantine=str(tmp_path / "bad"),
        targets={
            "prod": DaySink(serving_by_day(path=str(tmp_path / "by-day"))),
            "default": MonthSink(serving_by_month(path=str(tmp_path / "by-month"))),
        },
    )
    readings = spark.createDataFrame(
        [(p, day(n), float(n), 0.5) for p in ("A", "B", "nowhere") for n in range(1, 6)], READINGS
    )
    request = BackfillRequest.from_mapping(
        {"start": "2024-01-02", "end": "2024-01-04", "location_set": str(tmp_path / "places.csv")}
    )
    with pytest.raises(UnknownPlaces, match="nowhere"):
        run_backfill(spark, lake, request, readings=readings, ingested_at=LOADED)
    options = {"ingested_at": LOADED, "on_failure": "quarantine"}
    run_backfill(spark, lake, request, readings=readings, **options)
    assert spark.read.parquet(unknown_places_folder(lake)).count() == 3
    want = [(p, day(n)) for p in ("A", "B") for n in (2, 3, 4)]
    assert rows(lake.bronze.read(spark), "location_id", "observation_date") == want
    served = lake.targets["prod"].table.read(spark)
    assert rows(served, "region_id", "observation_date") == want
    assert not lake.targets["default"].table.exists(spark)
    exported = spark.read.parquet(str(tmp_path / "exports" / "climate_daily_summary"))
    assert exported.count() == 6
    assert rows(days_to_run(spark, lake, WEEK)) == [(day(1),), (day(5),), (day(6),), (day(7),)]


def test_days_to_run_without_a_table(spark, tmp_path):
    assert days_to_run(spark, _lake(tmp_path), WEEK).count() == 7


def test_catalog_lake(spark, tmp_path):
    lake = Lake.in_catalog(env=f"t-{abs(hash(str(tmp_path)))}", root=str(tmp_path / "wh"))
    assert lake.gold.name.endswith("_gold.climate_daily_summary") and "-" not in lake.gold.name
    with pytest.raises(DataSourceUnavailable):
        build_silver(spark, lake, WEEK)
    replace_partitions(two_locations_three_days(spark), lake.bronze)
    run_window(spark, lake, WEEK)
    run_day(spark, lake, day(2))
    assert lake.gold.read(spark).count() == 6


def test_stream_refresh_equals_batch(spark, tmp_path):
    streamed, batch = _lake(tmp_path, "s"), _lake(tmp_path, "b")
    state = str(tmp_path / "state")
    everything = bronze_frame(
        spark,
        [("A", 2, 2.0, 1.0), ("B", 2, 4.0, 1.0), ("A", 1, 1.0, 0.0), ("A", 3, 8.0, 0.0)],
    )

    def refresh():
        start_refresh(spark, streamed, state, max_files_per_trigger=1).awaitTermination()

    replace_partitions(everything.where("ingest_date >= DATE '2024-01-02'"), streamed.bronze)
    refresh()
    assert streamed.gold.read(spark).count() == 3
    # A file for an older day arrives late, and one more for a known day.
    late = everything.where("ingest_date = DATE '2024-01-01'")
    replace_partitions(late, streamed.bronze)
    extra = bronze_frame(spark, [("A", 2, 6.0, 1.0)])
    extra.write.mode("append").partitionBy("ingest_date").parquet(streamed.bronze.path)
    refresh()
    refresh()  # nothing new
    replace_partitions(everything.unionByName(extra), batch.bronze)
    run_window(spark, batch, WEEK)
    assert _tables(spark, streamed) == _tables(spark, batch)
    row = streamed.gold.read(spark).where("region_id = 'A' AND ingest_date = DATE '2024-01-02'").first()
    assert row.avg_temp_c == 4.0


def test_stream_needs_a_location():
    lake = Lake.in_catalog()
    with pytest.raises(ValueError, match="location"):
        start_refresh(None, lake, "unused")


def _places(spark, *names):
    return spark.createDataFrame([(n, 1.0, 2.0) for n in names], "location_id string, latitude double, longitude double")


def _readings(spark, *found):
    return spark.createDataFrame(
        [(p, day(n), 1.0, 0.5) for p, n in found],
        "location_id string, observation_date date, tavg_c double, prcp_mm double",
    )


def test_unknown_places_fail_a_load_before_anything_is_written(spark, tmp_path):
    lake = _lake(tmp_path)
    found = _readings(spark, ("A", 1), ("X", 1), ("X", 1), ("A", 2))
    with pytest.raises(UnknownPlaces, match="X on 2024-01-01: 2 reading") as raised:
        load_bronze(spark, lake, found, _places(spark, "A"), WEEK)
    assert not lake.bronze.exists(spark)
    assert raised.value.total == 1
    assert rows(raised.value.report.where("problem = 'unknown place'")) == [("X", day(1), "unknown place", 2)]


def test_unknown_places_are_stored_and_leave_when_known(spark, tmp_path):
    lake = _lake(tmp_path, quarantine=str(tmp_path / "bad"))
    found = _readings(spark, ("A", 1), ("X", 1), ("X", 2), ("Y", 3))
    report = load_bronze(spark, lake, found, _places(spark, "A"), WEEK, on_failure="quarantine")
    aside = lambda: spark.read.schema(BRONZE).parquet(unknown_places_folder(lake))
    assert rows(lake.bronze.read(spark), "location_id") == [("A",)]
    assert rows(aside(), "location_id", "observation_date", "latitude") == [("X", day(1), None), ("X", day(2), None), ("Y", day(3), None)]
    assert report.where("problem = 'missing'").count() == 6
    load_bronze(spark, lake, found, _places(spark, "A", "X"), WEEK, on_failure="quarantine")
    assert rows(lake.bronze.read(spark), "location_id") == [("A",), ("X",), ("X",)]
    assert rows(aside(), "location_id") == [("Y",)]


def test_the_load_report_stays_when_the_landing_folder_changes(spark, tmp_path):
    lake, landing = _lake(tmp_path), str(tmp_path / "landing")
    _readings(spark, ("A", 1)).write.parquet(landing)
    report = load_bronze(spark, lake, spark.read.parquet(landing), _places(spark, "A"), WEEK)
    _readings(spark, ("B", 5)).write.mode("overwrite").parquet(landing)
    assert report.where("observation_date = DATE '2024-01-01'").isEmpty()
    assert report.where("problem = 'missing'").count() == 6
