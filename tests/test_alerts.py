from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from daylake.operators import alerts
from daylake.streaming.alerts import stream_absence, stream_count_above, stream_error_rate
from fixtures import rows

T0 = datetime(2024, 1, 1)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def _events(spark, *events):
    data = [(at(s), key, severity) for s, key, severity in events]
    return spark.createDataFrame(data, "ts timestamp_ntz, key string, severity string")


def test_error_rate(spark):
    log = _events(spark, (1, "a", "ERROR"), (2, "b", "CRITICAL"), (3, "a", "INFO"),
                  (299, "a", "ERROR"), (300, "a", "ALERT"), (900, "a", "WARNING"))
    got = alerts.error_rate(log, alerts.severity_at_least("severity", "ERROR"), at_least=2)
    assert rows(got) == [
        (at(0), at(300), 3, 0.01, True),
        (at(300), at(600), 1, 1 / 300.0, False),
    ]


def test_unknown_severity_does_not_count(spark):
    log = _events(spark, (1, "a", "error"), (2, "a", None))
    assert log.where(alerts.severity_at_least("severity", "ERROR")).isEmpty()
    with pytest.raises(ValueError):
        alerts.severity_at_least("severity", "LOUD")


def test_count_above_per_key_and_overall(spark):
    log = _events(spark, *[(i, "a", "x") for i in range(6)], *[(i, "b", "x") for i in range(5)],
                  (60, "a", "x"))
    assert rows(alerts.count_above(log, 5, 60, ["key"])) == [(at(0), at(60), "a", 6)]
    assert rows(alerts.count_above(log, 0, 300)) == [(at(0), at(300), 12)]


def test_stale_keys_at_the_limit(spark):
    log = _events(spark, (0, "a", "x"), (100, "b", "x"), (50, "b", "x"))
    got = rows(alerts.stale_keys(log, ["key"], at(86_400)))
    assert got == [("a", at(0), 86_400.0, False), ("b", at(100), 86_300.0, False)]
    assert [r[3] for r in rows(alerts.stale_keys(log, ["key"], at(86_401)))] == [True, False]


def test_gaps_at_the_limit(spark):
    log = _events(spark, (5, "a", "x"), (15, "a", "x"), (26, "a", "x"), (5, "b", "x"))
    assert rows(alerts.gaps(log, ["key"], 10)) == [("a", at(15), at(26), 11.0)]


def _sessions_by_window(log, seconds):
    return log.groupBy("key", F.session_window("ts", f"{seconds} seconds").alias("w")).agg(
        F.count(F.lit(1)).alias("events")
    ).select("key", "w.start", "w.end", "events")


@pytest.mark.parametrize("seconds", [1, 7, 60, 3600])
def test_sessions_equal_session_window(spark, seconds):
    # One key holds two thirds of the events; spacings hit the limit exactly.
    data = spark.range(3000).select(
        (F.lit(T0) + F.make_dt_interval(secs=(F.col("id") * F.col("id") % 20011).cast("double")))
        .cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("key"),
    )
    assert rows(alerts.activity_sessions(data, ["key"], seconds)) == rows(
        _sessions_by_window(data, seconds)
    )


def test_sessions_before_the_epoch(spark):
    old = [datetime(1969, 12, 31, 23, 59, s) for s in (50, 58)] + [datetime(1970, 1, 1, 0, 0, 5)]
    log = spark.createDataFrame([(t, "a") for t in old], "ts timestamp_ntz, key string")
    assert rows(alerts.activity_sessions(log, ["key"], 8)) == rows(_sessions_by_window(log, 8))
    assert rows(alerts.activity_sessions(log, ["key"], 7)) == rows(_sessions_by_window(log, 7))


@pytest.fixture
def event_files(spark, tmp_path):
    def write(*events):
        _events(spark, *events).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def drain(build):
        schema = "ts timestamp_ntz, key string, severity string"
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        (
            build(stream).writeStream.format("parquet")
            .option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "state"))
            .trigger(availableNow=True).start().awaitTermination()
        )
        return rows(spark.read.parquet(str(tmp_path / "out")))

    return write, drain


def test_stream_emits_closed_windows_once(event_files):
    write, drain = event_files
    build = lambda s: stream_error_rate(s, alerts.severity_at_least("severity", "ERROR"))
    write((1, "a", "ERROR"), (2, "a", "ERROR"))
    assert drain(build) == []
    write((1000, "a", "ERROR"))
    assert drain(build) == [(at(0), at(300), 2, 2 / 300.0, True)]
    write((3, "a", "ERROR"), (2000, "a", "ERROR"))  # the first is too late
    assert [r[2] for r in drain(build)] == [2, 1]


def test_stream_threshold_and_absence(event_files):
    write, drain = event_files
    write(*[(i, "a", "x") for i in range(6)], (3, "b", "x"), (5000, "c", "x"))
    assert drain(lambda s: stream_count_above(s, 5, 60, ["key"])) == [(at(0), at(60), "a", 6)]


def test_stream_absence(event_files):
    write, drain = event_files
    write((0, "a", "x"), (50, "a", "x"), (0, "b", "x"), (5000, "c", "x"))
    got = drain(lambda s: stream_absence(s, ["key"], 60))
    assert got == [("a", at(0), at(110), 2), ("b", at(0), at(60), 1)]
