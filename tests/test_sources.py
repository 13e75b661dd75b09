import json
from datetime import date

import pytest

from daylake.errors import DataSourceUnavailable
from daylake.operators.bronze import bronze_rows, readings_with_places
from daylake.schemas import BRONZE
from daylake.sinks.tables import replace_partitions
from daylake.sources.locations import read_locations
from daylake.sources.replies import daily_readings, first_reading, read_replies
from daylake.sources.tables import Table, has_day, read_day, run_query
from fixtures import LOADED, day, rows, two_locations_three_days

LOCATIONS_CSV = "location_id,latitude,longitude\nLOC1,37.7749,-122.4194\n\n LOC2 , 34.0522,-118.2437\n"


def test_locations_skip_header_and_blank_lines(spark, tmp_path):
    (tmp_path / "l.csv").write_text(LOCATIONS_CSV)
    got = rows(read_locations(spark, str(tmp_path / "l.csv")))
    assert got == [("LOC1", 37.7749, -122.4194), ("LOC2", 34.0522, -118.2437)]


def test_locations_reject_text_coordinates(spark, tmp_path):
    (tmp_path / "l.csv").write_text("location_id,latitude,longitude\nLOC1,north,2\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_locations(spark, str(tmp_path / "l.csv")).collect()


def _reply(days, temps, prcps):
    return json.dumps(
        {"daily": {"time": days, "temperature_2m_mean": temps, "precipitation_sum": prcps}}
    )


@pytest.fixture
def replies(spark, tmp_path):
    bodies = [
        ("LOC1", _reply(["2024-01-01", "2024-01-02"], [1.5, None], [0.0, 2.5])),
        ("LOC2", _reply(["2024-01-01"], [7.0], [])),
        ("LOC3", _reply([], [], [])),
    ]
    lines = [json.dumps({"location_id": k, "body": b}) for k, b in bodies]
    (tmp_path / "r.json").write_text("\n".join(lines))
    return read_replies(spark, str(tmp_path / "r.json"))


def test_daily_readings_zip_the_arrays(replies):
    assert rows(daily_readings(replies)) == [
        ("LOC1", day(1), 1.5, 0.0),
        ("LOC1", day(2), None, 2.5),
        ("LOC2", day(1), 7.0, None),
    ]


def test_first_reading_takes_element_zero(replies):
    assert rows(first_reading(replies)) == [
        ("LOC1", 1.5, 0.0),
        ("LOC2", 7.0, None),
        ("LOC3", None, None),
    ]


def test_bronze_rows_type_and_lineage(spark, replies):
    places = spark.createDataFrame([("LOC1", 1.0, 2.0), ("LOC2", 3.0, 4.0)],
                                   "location_id string, latitude double, longitude double")
    got = bronze_rows(readings_with_places(daily_readings(replies), places), ingested_at=LOADED)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in BRONZE]
    assert rows(got)[0] == ("openmeteo", "LOC1", day(1), day(1), 1.5, 0.0, 1.0, 2.0, LOADED)
    assert got.where("ingest_date <> observation_date").isEmpty()


def test_bronze_turns_nan_to_null_and_refuses_missing_keys(spark):
    schema = "location_id string, observation_date date, tavg_c double, prcp_mm double, latitude double, longitude double"
    ok = spark.createDataFrame([("A", day(1), float("nan"), float("nan"), 1.0, 2.0)], schema)
    assert rows(bronze_rows(ok, ingested_at=LOADED), "tavg_c", "prcp_mm") == [(None, None)]
    bad = spark.createDataFrame([(None, day(1), 1.0, 1.0, 1.0, 2.0)], schema)
    with pytest.raises(Exception, match="location_id must not be null"):
        bronze_rows(bad, ingested_at=LOADED).collect()


def test_missing_tables(spark, tmp_path):
    by_path = Table(BRONZE, ("ingest_date",), path=str(tmp_path / "none"))
    by_name = Table(BRONZE, ("ingest_date",), name="nowhere.none")
    for missing in (by_path, by_name):
        assert not missing.exists(spark)
        assert missing.read_if_exists(spark) is None
        assert not has_day(spark, missing, day(1))
        with pytest.raises(DataSourceUnavailable, match="none"):
            missing.read(spark)


def test_read_day(spark, tmp_path):
    table = Table(BRONZE, ("ingest_date",), path=str(tmp_path / "b"))
    replace_partitions(two_locations_three_days(spark), table)
    assert read_day(spark, table, day(2)).count() == 2
    assert read_day(spark, table, "2024-01-09") is None
    assert has_day(spark, table, day(3)) and not has_day(spark, table, date(2023, 1, 3))


def test_run_query_with_typed_parameters(spark):
    two_locations_three_days(spark).createOrReplaceTempView("obs_view")
    sql = "SELECT count(*) AS n FROM obs_view WHERE observation_date = :d AND tavg_c > :t"
    got = run_query(spark, sql, {"d": day(1), "t": 12.5}, requires=["obs_view"])
    assert got.first().n == 1
    with pytest.raises(DataSourceUnavailable, match="absent_table"):
        run_query(spark, "SELECT 1", requires=["absent_table"])


def test_table_checks_its_columns():
    with pytest.raises(ValueError):
        Table(BRONZE, ("month",), path="x")
    with pytest.raises(ValueError):
        Table(BRONZE, ("ingest_date",))


def test_broken_replies_are_reported_and_stop_the_readers(spark):
    from daylake.sources.replies import bad_replies, daily_readings, first_reading

    sound = '{"daily":{"time":["2024-01-01"],"temperature_2m_mean":[1.5],"precipitation_sum":[null]}}'
    bodies = [
        sound,
        "<html>",
        '{"error":true}',
        None,
        sound.replace("1.5", '"n/a"'),
        sound.replace("[1.5]", "[1.5,2]"),
        sound.replace("2024-01-01", "someday"),
    ]
    replies = spark.createDataFrame(list(enumerate(bodies)), "location_id int, body string")
    bad = {r["location_id"]: (r["body"], r["problem"]) for r in bad_replies(replies).collect()}
    assert sorted(bad) == [1, 2, 3, 4, 5, 6] and bad[1] == ("<html>", "not readable")
    for reader in (daily_readings, first_reading):
        assert reader(replies, bad="skip").count() == 1
        with pytest.raises(Exception, match="malformed reply"):
            reader(replies).collect()
