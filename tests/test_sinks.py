import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from daylake.operators.days import DayRange
from daylake.operators.gold import gold_summary
from daylake.operators.shaping import json_records
from daylake.operators.silver import silver_features
from daylake.schemas import BRONZE, GOLD, conform
from daylake.sinks import files
from daylake.sinks.serving import (
    DaySink,
    MonthSink,
    publish,
    publish_table,
    serving_by_day,
    serving_by_month,
)
from daylake.sinks.tables import (
    ensure_table,
    export_parquet,
    lay_out,
    persist,
    replace_partitions,
    write_samples,
)
from daylake.sources.tables import Table
from fixtures import bronze_frame, day, rows, two_locations_three_days


@pytest.fixture(params=["path", "catalog", "catalog at path"])
def bronze_table(request, tmp_path):
    name = f"db_{abs(hash(str(tmp_path)))}.bronze" if "catalog" in request.param else None
    path = str(tmp_path / "bronze") if "path" in request.param else None
    return Table(BRONZE, ("ingest_date",), name=name, path=path, sort_by=("location_id",))


@pytest.fixture(params=["static", "dynamic"])
def overwrite_mode(request, spark):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, request.param)
    yield request.param
    spark.conf.set(key, before)


def test_replace_keeps_other_days_in_any_session_mode(spark, bronze_table, overwrite_mode):
    assert not bronze_table.exists(spark)
    replace_partitions(two_locations_three_days(spark), bronze_table)
    assert bronze_table.exists(spark)
    assert bronze_table.read(spark).count() == 6
    revised = bronze_frame(spark, [("LOC9", 2, 1.0, 1.0)])
    for _ in range(2):  # replacing again changes nothing
        replace_partitions(revised, bronze_table)
        got = rows(bronze_table.read(spark), "observation_date", "location_id")
        assert got == [(day(1), "LOC1"), (day(1), "LOC2"), (day(2), "LOC9"),
                       (day(3), "LOC1"), (day(3), "LOC2")]
    assert bronze_table.read(spark).columns == BRONZE.names


def test_empty_frame_changes_nothing(spark, bronze_table):
    replace_partitions(two_locations_three_days(spark), bronze_table)
    replace_partitions(two_locations_three_days(spark).limit(0), bronze_table)
    assert bronze_table.read(spark).count() == 6


def test_columns_match_by_name_not_position(spark, bronze_table):
    shuffled = two_locations_three_days(spark).select(*reversed(BRONZE.names))
    replace_partitions(shuffled, bronze_table, keep_layout=True)
    assert rows(bronze_table.read(spark)) == rows(two_locations_three_days(spark))


def test_foreign_static_table_is_refused(spark, tmp_path):
    name = f"db_{abs(hash(str(tmp_path)))}.foreign"
    table = Table(BRONZE, ("ingest_date",), name=name)
    ensure_table(spark, table)
    spark.sql(f"DROP TABLE {name}")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BRONZE)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (ingest_date)")
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "static")
    try:
        with pytest.raises(ValueError, match="overwritten as a whole"):
            replace_partitions(two_locations_three_days(spark), table)
    finally:
        spark.conf.set(key, before)


def test_ensure_table_repeats_without_harm(spark, bronze_table):
    ensure_table(spark, bronze_table)
    replace_partitions(two_locations_three_days(spark), bronze_table)
    ensure_table(spark, bronze_table)
    assert bronze_table.read(spark).count() == 6


def test_hot_day_is_split_over_write_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        hot = spark.range(200_000).select(
            F.when(F.col("id") % 3 > 0, F.lit(day(1)))
            .otherwise(F.date_add(F.lit(day(2)), (F.col("id") % 5).cast("int"))).alias("d"),
            F.xxhash64("id").alias("v"),
        )
        path = str(tmp_path / "hot")
        lay_out(hot, ["d"]).write.partitionBy("d").parquet(path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    per_day = dict(
        rows(spark.read.parquet(path).groupBy("d").agg(F.count_distinct("_metadata.file_path")))
    )
    assert per_day[day(1)] > 3
    assert spark.read.parquet(path).count() == 200_000


def test_persist_with_export(spark, tmp_path):
    table = Table(BRONZE, ("ingest_date",), path=str(tmp_path / "t"))
    out = str(tmp_path / "x")
    frame = two_locations_three_days(spark)
    persist(frame, table, export_path=out, export_partition_by=["ingest_date"])
    persist(frame.where("ingest_date = DATE '2024-01-01'"), table,
            export_path=out, export_partition_by=["ingest_date"])
    assert rows(conform(spark.read.parquet(out), BRONZE)) == rows(frame)
    export_parquet(frame, str(tmp_path / "plain"))
    assert spark.read.parquet(str(tmp_path / "plain")).count() == 6


def _gold(spark, *extra):
    base = [("A", 1, 1.0, 1.0), ("B", 1, 2.0, 2.0), ("A", 2, 3.0, 3.0)]
    return gold_summary(silver_features(bronze_frame(spark, [*base, *extra])))


@pytest.mark.parametrize("make, of", [(DaySink, serving_by_day), (MonthSink, serving_by_month)])
@pytest.mark.parametrize("addressing", ["path", "catalog"])
def test_publishing_replaces_only_published_days(
    spark, tmp_path, make, of, addressing, overwrite_mode
):
    if addressing == "path":
        table = of(path=str(tmp_path / "s"))
    else:
        table = of(name=f"db_{abs(hash(str(tmp_path)))}.serving")
    sink = make(table)
    may = spark.range(1).select(F.lit("C").alias("region_id"), *[
        F.lit(None).cast(f.dataType).alias(f.name) for f in GOLD if f.name != "region_id"
    ]).withColumn("observation_date", F.lit("2024-05-01").cast("date"))
    sink.publish(conform(may, GOLD), DayRange(day(1).replace(month=5), day(1).replace(month=5)))
    sink.publish(_gold(spark), DayRange(day(1), day(5)))
    again = _gold(spark, ("A", 2, 5.0, 3.0)).where("region_id = 'A'")
    sink.publish(again, DayRange(day(2), day(2)))
    sink.publish(again, DayRange(day(2), day(3)))
    got = rows(table.read(spark), "region_id", "observation_date", "avg_temp_c")
    assert got == [("A", day(1), 1.0), ("A", day(2), 4.0), ("B", day(1), 2.0),
                   ("C", day(1).replace(month=5), None)]


def test_publish_routes_by_environment(spark):
    seen = []

    class Recorder:
        def __init__(self, name):
            self.name = name

        def publish(self, gold, days):
            seen.append(self.name)

    targets = {"prod": Recorder("warehouse"), "default": Recorder("local")}
    gold = _gold(spark)
    for env in ("prod", "PROD", "dev", "staging"):
        publish(gold, DayRange(day(1), day(1)), targets, env)
    assert seen == ["warehouse", "warehouse", "local", "local"]


def test_publish_table_skips_missing_and_empty(spark, tmp_path, capsys):
    gold = Table(GOLD, ("ingest_date",), path=str(tmp_path / "gold"))
    sink = DaySink(serving_by_day(path=str(tmp_path / "s")))
    days = DayRange(day(1), day(2))
    assert not publish_table(spark, gold, days, {"default": sink}, "dev")
    assert "does not exist" in capsys.readouterr().out
    replace_partitions(_gold(spark), gold)
    assert not publish_table(spark, gold, DayRange(day(9), day(9)), {"default": sink}, "dev")
    assert publish_table(spark, gold, days, {"default": sink}, "dev")
    assert sink.table.read(spark).count() == 3


def test_json_records_write(spark, tmp_path):
    json_records(_gold(spark)).write.text(str(tmp_path / "j"))
    texts = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "j")).collect()]
    assert {t["observation_date"] for t in texts} == {"2024-01-01", "2024-01-02"}


def test_write_samples(spark, tmp_path):
    frame = two_locations_three_days(spark).withColumn("suite", F.lit("s")).withColumn(
        "partition_key", F.col("observation_date").cast("string"))
    write_samples(frame, str(tmp_path / "samples"))
    write_samples(frame.where("partition_key = '2024-01-01'"), str(tmp_path / "samples"))
    assert spark.read.parquet(str(tmp_path / "samples")).count() == 6


def test_orphan_files(spark, tmp_path):
    root = str(tmp_path / "t")
    table = Table(BRONZE, ("ingest_date",), name=f"db_{abs(hash(root))}.b", path=root)
    frame = two_locations_three_days(spark)
    replace_partitions(frame.where("ingest_date < DATE '2024-01-03'"), table)
    replace_partitions(frame.where("ingest_date = DATE '2024-01-03'"),
                       Table(BRONZE, ("ingest_date",), path=root))
    listed, live = files.list_files(spark, root), files.live_files(spark.read.table(table.name))
    later = datetime(2100, 1, 1)
    found = [r.path for r in files.orphan_files(listed, live, later).collect()]
    assert found and all("ingest_date=2024-01-03" in p for p in found)
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    assert files.orphan_files(listed, live, now).isEmpty()  # too young to be touched
    assert files.delete_files(files.orphan_files(listed, live, later)) == len(found)
    assert files.orphan_files(files.list_files(spark, root), live, later).isEmpty()
    assert spark.read.table(table.name).count() == 4


def test_orphan_files_with_awkward_names(spark, tmp_path):
    root = str(tmp_path / "a b%20c+d")
    odd = spark.range(4).withColumn("k", F.concat(F.lit("x y:%+"), F.col("id") % 2))
    odd.write.partitionBy("k").parquet(root)
    live = files.live_files(spark.read.parquet(root))
    later = datetime(2100, 1, 1)
    assert files.orphan_files(files.list_files(spark, root), live, later).isEmpty()
    none_live = live.limit(0)
    found = files.orphan_files(files.list_files(spark, root), none_live, later)
    assert files.delete_files(found) == 4
    assert files.list_files(spark, root).isEmpty()
