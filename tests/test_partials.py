"""Merged partial gold, sketches, buckets, and streams that keep everything."""

from __future__ import annotations

import re
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from daylake.operators.alerts import stale_keys
from daylake.operators.gold import gold_summary
from daylake.operators.partials import (
    distinct_regions,
    failing_days,
    gold_partials,
    merged_gold,
    partials_at,
    region_sketches,
)
from daylake.operators.rolling import rolling_windows
from daylake.operators.silver import silver_features
from daylake.plans.lake import Lake
from daylake.sinks.serving import MonthSink, serving_by_region
from daylake.sinks.tables import drop_day_folders, replace_partitions
from daylake.operators.days import DayRange
from daylake.streaming.late import split_events, start_late_split
from daylake.streaming.refresh import merge_load, start_partial_refresh
from daylake.streaming.silence import compact_last_seen, last_seen, open_silences, start_last_seen
from fixtures import bronze_frame, day, rows, two_locations_three_days


def _lake(tmp_path):
    return Lake.at_path(str(tmp_path / "lake")), partials_at(str(tmp_path / "partials"))


def test_late_loads_are_merged_without_the_old_ones(spark, tmp_path):
    lake, stored = _lake(tmp_path)
    first = two_locations_three_days(spark)
    late = bronze_frame(spark, [("LOC1", 1, 40.0, 9.0, "a"), ("LOC3", 2, None, 0.0, "z")])
    assert merge_load(spark, lake, stored, first, "one").isEmpty()
    for _ in range(2):  # a load that runs again changes nothing
        merge_load(spark, lake, stored, late, "two")
        assert rows(lake.gold.read(spark)) == rows(gold_summary(silver_features(first.union(late))))


def test_a_day_that_fails_keeps_its_gold(spark, tmp_path):
    lake, stored = _lake(tmp_path)
    merge_load(spark, lake, stored, two_locations_three_days(spark), "one")
    before = rows(lake.gold.read(spark))
    failing = merge_load(spark, lake, stored, bronze_frame(spark, [("LOC1", 1, 99.0, 1.0), ("LOC9", 4, None, None)]), "two")
    assert rows(failing) == [(day(1), 1), (day(4), 0)]
    assert rows(lake.gold.read(spark)) == before
    # The load is withdrawn and comes again without the fault.
    drop_day_folders(failing, f"{stored.path}", "ingest_date")
    assert rows(failing_days(stored.read(spark))) == []


def test_the_plan_of_a_load_reads_no_bronze(spark, tmp_path):
    lake, stored = _lake(tmp_path)
    merge_load(spark, lake, stored, two_locations_three_days(spark), "one")
    read = merged_gold(stored.read(spark)).inputFiles()
    assert read and all(stored.path in f for f in read)
    one = merged_gold(stored.read(spark).where("ingest_date = DATE '2024-01-02'"))
    assert "PartitionFilters: [isnotnull(ingest_date" in one._jdf.queryExecution().executedPlan().toString()


def test_a_stream_of_loads_equals_a_batch(spark, tmp_path):
    lake, stored = _lake(tmp_path)
    parts = [[("A", 1, 1.0, 0.0)], [("B", 2, 2.0, 1.0), ("A", 1, 5.0, 2.0, "b")], [("A", 1, None, None)]]
    for k, part in enumerate(parts):
        frame = bronze_frame(spark, part)
        frame.coalesce(1).write.mode("append").partitionBy("ingest_date").parquet(lake.bronze.path)
        start_partial_refresh(spark, lake, stored, str(tmp_path / "state")).awaitTermination()
        if k == 0:
            assert lake.gold.read(spark).count() == 1
    everything = bronze_frame(spark, [r for part in parts for r in part])
    assert rows(lake.gold.read(spark)) == rows(gold_summary(silver_features(everything)))
    assert stored.read(spark).select("load").distinct().count() == 3


def test_partials_of_an_empty_load(spark):
    none = gold_partials(silver_features(two_locations_three_days(spark).limit(0)), "none")
    assert none.isEmpty() and merged_gold(none).isEmpty() and failing_days(none).isEmpty()


def test_sketches_estimate_many_regions_over_days(spark):
    gold = spark.range(60_000).select(
        (F.col("id") % 20_000).cast("string").alias("region_id"),
        F.date_add(F.lit(day(1)), (F.col("id") % 7).cast("int")).alias("ingest_date"),
    )
    sketches = region_sketches(gold)
    assert sketches.count() == 7
    (row,) = distinct_regions(sketches).collect()
    assert abs(row["regions"] - 20_000) <= 3 * 0.83 / 64 * 20_000


@pytest.fixture
def bucketed(spark, tmp_path):
    table = serving_by_region(f"b_{uuid.uuid4().hex}.serving", str(tmp_path / "serving"), 8)
    gold = gold_summary(silver_features(two_locations_three_days(spark)))
    for _ in range(2):
        MonthSink(table).publish(gold, DayRange(day(1), day(3)))
    return table


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_over_buckets_need_no_shuffle(spark, bucketed):
    windows = rolling_windows(bucketed.read(spark))
    assert "Exchange" not in _plan(windows) and windows.count() == 6
    one = rolling_windows(bucketed.read(spark), region="LOC1")
    assert re.search(r"SelectedBucketsCount: 1 out of 8", _plan(one)) and one.count() == 3


def test_buckets_need_a_catalog_table(tmp_path):
    with pytest.raises(ValueError, match="buckets need"):
        serving_by_region(None, str(tmp_path / "x"))


EVENTS = "k string, ts timestamp_ntz"


def _land(spark, path, found):
    spark.createDataFrame(found, EVENTS).coalesce(1).write.mode("append").parquet(path)


def test_open_silences_in_any_order_and_compacted(spark, tmp_path):
    landing, path, state = (str(tmp_path / n) for n in ("in", "seen", "state"))
    t = lambda d, h=0: datetime(2024, 1, d, h)
    batches = [[("a", t(9)), ("b", t(1))], [("a", t(2)), (None, t(8))], [("b", t(3)), ("c", t(9, 12))]]
    updates = []
    for found in batches:
        _land(spark, landing, found)
        events = spark.readStream.schema(EVENTS).parquet(landing)
        start_last_seen(events, ["k"], path, state, on_update=lambda df: updates.append(df.count())).awaitTermination()
    want = rows(stale_keys(spark.read.schema(EVENTS).parquet(landing), ["k"], t(10)))
    schema = "k string, last_seen timestamp_ntz"
    assert rows(open_silences(last_seen(spark, path, schema), ["k"], t(10))) == want
    assert updates == [2, 4, 6]
    for _ in range(2):
        compact_last_seen(spark, path, schema, ["k"])
        assert last_seen(spark, path, schema).count() == 4
        assert rows(open_silences(last_seen(spark, path, schema), ["k"], t(10))) == want
    _land(spark, landing, [("b", t(9))])
    start_last_seen(spark.readStream.schema(EVENTS).parquet(landing), ["k"], path, state).awaitTermination()
    compact_last_seen(spark, path, schema, ["k"])
    stale = {r.k: r.stale for r in open_silences(last_seen(spark, path, schema), ["k"], t(10)).collect()}
    assert stale == {"a": False, "b": False, "c": False, None: True}


def test_late_rows_are_kept_beside_the_others(spark, tmp_path):
    landing, path, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    base = datetime(2024, 1, 1, 12)
    at = lambda m: base + timedelta(minutes=m)
    batches = [
        [("first", at(0)), ("old but first", at(-500)), ("no time", None)],
        [("window still open", at(-10)), ("closed", at(-20)), ("new", at(60))],
        [("closed too", at(40)), ("edge open", at(50)), ("no time", None)],
    ]
    for found in batches:
        _land(spark, landing, found)
        events = spark.readStream.schema(EVENTS).parquet(landing)
        start_late_split(events, path, state, seconds=300, delay=timedelta(minutes=10)).awaitTermination()
    got = split_events(spark, path, events.schema)
    assert got.count() == 9
    assert rows(got.where("late"), "k", "batch") == [("closed too", 2), ("closed", 1)]
