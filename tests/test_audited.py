"""Write, audit, publish: days are switched whole, and nothing is computed twice."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from daylake.errors import ContractViolation
from daylake.operators.contracts import SILVER_SUITE, contract_report
from daylake.operators.days import SAFETY_HORIZON, DayRange
from daylake.operators.silver import silver_features
from daylake.plans import audited
from daylake.plans.audited import audited_gold, audited_silver
from daylake.plans.lake import Lake
from daylake.sinks.files import registered_folders, stray_files
from daylake.sinks.tables import drop_days, replace_partitions
from fixtures import bronze_frame, day, rows, two_locations_three_days

WEEK = DayRange(day(1), day(7))


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake.in_catalog(env=f"a-{uuid.uuid4().hex}", root=str(tmp_path / "lake"), quarantine=str(tmp_path / "bad"))
    replace_partitions(two_locations_three_days(spark), lake.bronze)
    return lake


def _warmer(spark, lake, by=1.0):
    rows_ = two_locations_three_days(spark).withColumn("tavg_c", F.col("tavg_c") + by)
    replace_partitions(rows_, lake.bronze)


def test_days_are_published_and_switched(spark, lake):
    audited_silver(spark, lake, WEEK)
    want = rows(silver_features(two_locations_three_days(spark)))
    assert rows(lake.silver.read(spark)) == want
    before = set(registered_folders(spark, lake.silver))
    _warmer(spark, lake)
    audited_silver(spark, lake, DayRange(day(2), day(2)))
    after = set(registered_folders(spark, lake.silver))
    assert len(before & after) == 2 and len(after) == 3  # one day points elsewhere
    got = dict(rows(lake.silver.read(spark).groupBy("ingest_date").agg(F.sum("tavg_c"))))
    assert got == {day(1): 35.0, day(2): 36.0, day(3): 23.0}
    audited_gold(spark, lake, WEEK)
    assert lake.gold.read(spark).count() == 6


@pytest.mark.parametrize("step", ["audit", "publish_days"])
def test_a_run_that_stops_leaves_the_old_days(spark, lake, monkeypatch, step):
    audited_silver(spark, lake, WEEK)
    before = rows(lake.silver.read(spark))
    _warmer(spark, lake)

    def stopped(*args, **options):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(audited, step, stopped)
        with pytest.raises(RuntimeError, match="stopped"):
            audited_silver(spark, lake, WEEK)
    assert rows(lake.silver.read(spark)) == before
    audited_silver(spark, lake, WEEK)
    assert rows(lake.silver.read(spark)) != before


def test_a_failing_day_keeps_its_old_rows_and_is_reported(spark, lake):
    audited_silver(spark, lake, WEEK)
    before = rows(lake.silver.read(spark).where("ingest_date = DATE '2024-01-02'"))
    bad = two_locations_three_days(spark).withColumn(
        "tavg_c", F.when(F.col("ingest_date") == F.lit(day(2)), 99.0).otherwise(F.col("tavg_c") + 1)
    )
    replace_partitions(bad, lake.bronze)
    with pytest.raises(ContractViolation, match="2024-01-02: max\\(tavg_c\\) broken by 2 row") as raised:
        audited_silver(spark, lake, WEEK)
    shown = ["partition_key", "rule", "column_name", "violations", "passed"]
    want = contract_report(silver_features(bad), SILVER_SUITE, by="ingest_date")
    assert rows(raised.value.report, *shown) == rows(want, *shown)
    assert rows(lake.silver.read(spark).where("ingest_date = DATE '2024-01-02'")) == before
    assert lake.silver.read(spark).where("ingest_date = DATE '2024-01-01'").agg(F.sum("tavg_c")).first()[0] == 37.0
    aside = spark.read.parquet(f"{lake.quarantine}/{SILVER_SUITE.name}")
    assert aside.count() == 2
    replace_partitions(two_locations_three_days(spark), lake.bronze)
    audited_silver(spark, lake, WEEK)  # repaired: the day leaves the quarantine
    with pytest.raises(Exception):
        assert spark.read.parquet(f"{lake.quarantine}/{SILVER_SUITE.name}").count() == 0


def test_null_measures_and_an_empty_range(spark, lake):
    replace_partitions(bronze_frame(spark, [("A", 5, None, None), ("A", 6, None, 1.0)]), lake.bronze)
    report = audited_silver(spark, lake, DayRange(day(5), day(6)), on_failure="quarantine")
    assert rows(report.where("not passed"), "partition_key", "rule") == [("2024-01-05", "not_all_missing")]
    assert audited_silver(spark, lake, DayRange(day(20), day(21))).isEmpty()


def test_folders_that_were_replaced_become_strays(spark, lake):
    audited_silver(spark, lake, WEEK)
    _warmer(spark, lake)
    audited_silver(spark, lake, DayRange(day(1), day(2)))
    now = datetime.now(timezone.utc)
    assert stray_files(spark, lake.silver, now).isEmpty()  # too young
    found = stray_files(spark, lake.silver, now + SAFETY_HORIZON + timedelta(minutes=1))
    assert rows(found, "day") == [("2024-01-01",), ("2024-01-02",)]
    live = {f.split("lake/", 1)[1] for f in lake.silver.read(spark).inputFiles()}
    assert not live & {r.path.split("lake/", 1)[1] for r in found.collect()}


def test_days_are_dropped_from_catalog_tables(spark, lake):
    audited_silver(spark, lake, WEEK)
    gone = lake.silver.read(spark).where("ingest_date = DATE '2024-01-02'").select("ingest_date")
    drop_days(gone, lake.silver)
    assert rows(lake.silver.read(spark).select("ingest_date").distinct()) == [(day(1),), (day(3),)]
    drop_days(lake.silver.read(spark).limit(0), lake.silver)


def test_only_catalog_tables_with_a_path(spark, tmp_path):
    lake = Lake.at_path(str(tmp_path / "p"))
    replace_partitions(two_locations_three_days(spark), lake.bronze)
    with pytest.raises(ValueError, match="catalog table"):
        audited_silver(spark, lake, WEEK)


def test_silver_reads_bronze_once(spark, lake, monkeypatch):
    scans = []
    plain = audited.silver_features
    monkeypatch.setattr(audited, "silver_features", lambda df: scans.append(df) or plain(df))
    ran = []
    real = audited.audit

    def audit_without_bronze(*args):
        drop_days(lake.bronze.read(spark).select("ingest_date"), lake.bronze)  # nothing left to scan
        ran.append(1)
        return real(*args)

    monkeypatch.setattr(audited, "audit", audit_without_bronze)
    audited_silver(spark, lake, WEEK)
    assert ran and len(scans) == 1 and lake.silver.read(spark).count() == 6
