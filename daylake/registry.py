"""Every operator as a named query over the given tables.

The weather tables are derived from ``events``: a user is a location, an event is
one reading, and its type decides which measures the reading carries.  All queries
run over whole tables; a day, region or range appears only where it is the
operator's own argument.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from daylake.errors import DataSourceUnavailable
from daylake.functions import (
    cooling_degree_days,
    growing_degree_days,
    heating_degree_days,
    partition_suffix,
    precipitation_flag,
)
from daylake.operators import alerts, contracts, serving
from daylake.operators.bronze import bronze_rows, load_report
from daylake.operators.days import (
    BackfillRequest,
    SAFETY_HORIZON,
    DayRange,
    date_spine,
    location_date_grid,
    missing_days,
    retention_tiers,
)
from daylake.operators.gold import gold_summary
from daylake.operators.rolling import rolling_windows
from daylake.operators.shaping import dates_as_text, json_records, serving_shape
from daylake.operators.silver import silver_features
from daylake.operators.partials import (
    SKETCHES,
    distinct_regions,
    failing_days,
    merged_gold,
    partials_at,
    region_sketches,
)
from daylake.plans.audited import audited_gold, audited_silver
from daylake.plans.lake import (
    TABLE_NAMES,
    Lake,
    build_silver,
    days_to_run,
    in_range,
    load_bronze,
    run_backfill,
    run_lookback,
    run_missing,
    run_window,
    unknown_places_folder,
)
from daylake.schemas import BRONZE, GOLD, SILVER
from daylake.session import stage, working_dir
from daylake.sinks import files
from daylake.sinks.serving import (
    DaySink,
    JsonSink,
    MonthSink,
    serving_by_day,
    serving_by_month,
    serving_by_region,
)
from daylake.sinks.tables import drop_days, export_parquet, quoted, replace_partitions
from daylake.sources.locations import read_locations
from daylake.sources.replies import bad_replies, daily_readings, first_reading
from daylake.sources.tables import Table, has_day, read_day, run_query
from daylake.streaming.alerts import stream_absence, stream_count_above, stream_error_rate
from daylake.streaming.late import split_events, start_late_split
from daylake.streaming.refresh import merge_load, start_partial_refresh, start_refresh
from daylake.streaming.silence import compact_last_seen, last_seen, open_silences, start_last_seen

Query = Callable[[SparkSession, str], DataFrame]

FIRST, LAST = date(2024, 1, 1), date(2024, 1, 30)
DAY = date(2024, 1, 5)
LOADED_AT = "2024-02-01 00:00:00"
REGION = "LOC7"

_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# ---------------------------------------------------------------- inputs


# Given schemas spare every query the job that infers them.
_INPUTS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_INPUTS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _location() -> Column:
    return F.concat(F.lit("LOC"), F.col("user_id").cast("string"))


def readings(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    """Events as weather readings.

    An 'error' carries no measure, a 'signup' no precipitation, a 'view' is dry.
    Temperatures stay within the contract, except on Sundays, when readings come in
    on another scale: so some days break the contract at every data size.
    """
    kind, value = F.col("event_type"), F.col("value")
    usual = F.least(value / 6.0 - 15.0, F.lit(60.0))
    temperature = F.when(F.weekday("ts") == 6, value / 2.0 - 15.0).otherwise(usual)
    return table(spark, sf_dir, "events").select(
        "event_id",
        _location().alias("location_id"),
        F.to_date("ts").alias("observation_date"),
        kind.alias("source"),
        F.when(kind != "error", temperature).alias("tavg_c"),
        F.when(kind == "view", 0.0).when(~kind.isin("error", "signup"), value).alias("prcp_mm"),
        (F.col("user_id") % 181 - 90).cast("double").alias("latitude"),
        (F.col("user_id") * 7 % 361 - 180).cast("double").alias("longitude"),
        *extra,
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).select("location_id", "latitude", "longitude").distinct()


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_rows(
        readings(spark, sf_dir), source=F.col("source"), ingested_at=F.lit(LOADED_AT).cast("timestamp")
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_features(bronze(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_summary(silver(spark, sf_dir))


def whole_range(spark: SparkSession, sf_dir: str) -> DayRange:
    """From the first to the last day that has a reading."""
    days = readings(spark, sf_dir).agg(F.min("observation_date"), F.max("observation_date"))
    first, last = days.first()
    return DayRange(first or FIRST, last or first or FIRST)


def stored_gold(spark: SparkSession, sf_dir: str, days: DayRange | None = None) -> DataFrame:
    """Gold as a stored table, by day; with ``days`` only their partitions are read."""
    target = Lake.at_path(working_dir(spark, "lake")).gold
    replace_partitions(gold(spark, sf_dir), target)
    return target.read(spark) if days is None else in_range(target.read(spark), days)


def _comparable(df: DataFrame, digits: int = 7) -> DataFrame:
    """Computed doubles rounded once, and instants as plain timestamps."""
    exact = {"tavg_c", "prcp_mm", "latitude", "longitude", "hdd18", "cdd18", "gdd10_30"}

    def shown(name: str, kind: str) -> Column:
        if kind == "double" and name not in exact:
            return F.round(name, digits).alias(name)
        if kind == "timestamp":
            return F.col(name).cast("timestamp_ntz").alias(name)
        return F.col(name)

    return df.select([shown(name, kind) for name, kind in df.dtypes])


def _table_at(spark: SparkSession, label: str, schema, **options) -> Table:
    return Table(schema, ("ingest_date",), path=working_dir(spark, label), **options)


# ---------------------------------------------------------------- sources


@_query
def partition_scan(spark, sf_dir):
    stored = _loaded_lake(spark, sf_dir).bronze
    rows = read_day(spark, stored, DAY, "ingest_date")
    return _comparable(stored.read(spark).limit(0) if rows is None else rows)


@_query
def partition_exists(spark, sf_dir):
    present = bronze(spark, sf_dir).select("observation_date").distinct()
    spine = date_spine(spark, FIRST, date(2024, 2, 5))
    return spine.join(present.withColumn("_seen", F.lit(True)), "observation_date", "left").select(
        "observation_date", F.coalesce("_seen", F.lit(False)).alias("has_rows")
    )


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-day replies: the reading, then the event's ``k`` for the day after."""
    later = F.from_json("props", "k int").getField("k").cast("double")
    source = readings(spark, sf_dir, later.alias("k"))
    day = F.col("observation_date")
    daily = F.struct(
        F.array(day.cast("string"), F.date_add(day, 1).cast("string")).alias("time"),
        F.array("tavg_c", "k").alias("temperature_2m_mean"),
        F.array("prcp_mm", F.lit(None).cast("double")).alias("precipitation_sum"),
    )
    return source.select(
        "event_id", "location_id", F.to_json(F.struct(daily.alias("daily"))).alias("body")
    )


@_query
def parse_payload_arrays(spark, sf_dir):
    return daily_readings(_replies(spark, sf_dir))


@_query
def parse_first_reading(spark, sf_dir):
    return first_reading(_replies(spark, sf_dir))


@_query
def parse_bad_replies(spark, sf_dir):
    """Every reply with its problem; three in ten are broken."""
    share = F.pmod("event_id", F.lit(10))
    broken = (
        F.when(share == 0, F.lit("<html>busy</html>"))
        .when(share == 1, F.lit('{"error":true}'))
        .when(share == 2, F.lit('{"daily":{"time":["2024-01-01"],"temperature_2m_mean":["n/a"],"precipitation_sum":[1.0]}}'))
    )
    replies = _replies(spark, sf_dir).withColumn("body", F.coalesce(broken, F.col("body")))
    sound = first_reading(replies, bad="skip").select("event_id", F.lit("none").alias("problem"))
    return bad_replies(replies).select("event_id", "problem").union(sound)


@_query
def bronze_load_report(spark, sf_dir):
    """Readings against a dimension that lacks some places, on every day of a range."""
    known = locations(spark, sf_dir).where("latitude >= -80")
    return load_report(readings(spark, sf_dir), known, DayRange(FIRST, LAST))


@_query
def load_places_aside(spark, sf_dir):
    """Rows by day and place after a load whose dimension lacks places: those of known
    ones in bronze, the others aside, none lost."""
    root = working_dir(spark, "lake")
    lake = Lake.at_path(root, quarantine=f"{root}/quarantine")
    load_bronze(
        spark,
        lake,
        readings(spark, sf_dir).drop("latitude", "longitude"),
        locations(spark, sf_dir).where("latitude >= -80"),
        whole_range(spark, sf_dir),
        source=F.col("source"),
        on_failure="quarantine",
    )
    aside = spark.read.schema(BRONZE).parquet(unknown_places_folder(lake))
    both = lake.bronze.read(spark).withColumn("stored_in", F.lit("bronze")).unionByName(
        aside.withColumn("stored_in", F.lit("aside"))
    )
    return both.groupBy("ingest_date", "location_id", "stored_in").agg(
        F.count("*").alias("n_rows"), F.count("latitude").alias("n_placed")
    )


@_query
def bronze_loaded_now(spark, sf_dir):
    """Bronze rows of a load that is given no time, and whether they carry the run's."""
    root = working_dir(spark, "lake")
    lake = Lake.at_path(root)
    started = F.lit(datetime.now(timezone.utc) - timedelta(minutes=1))
    load_bronze(
        spark,
        lake,
        readings(spark, sf_dir).drop("latitude", "longitude"),
        locations(spark, sf_dir),
        whole_range(spark, sf_dir),
        source=F.col("source"),
    )
    recent = F.col("ingested_at").between(started, F.current_timestamp())
    return lake.bronze.read(spark).select(
        "location_id", "observation_date", "source", recent.alias("loaded_in_this_run")
    )


@_query
def day_probes(spark, sf_dir):
    """Whether days have rows: one within the readings, one before them, one in a table
    that does not exist."""
    days, stored = whole_range(spark, sf_dir), _loaded_lake(spark, sf_dir).bronze
    missing = Lake.at_path(working_dir(spark, "no-lake")).bronze
    found = [
        ("first day", has_day(spark, stored, days.start, "ingest_date")),
        ("day before", has_day(spark, stored, days.start - timedelta(days=1), "ingest_date")),
        ("no table", has_day(spark, missing, days.start, "ingest_date")),
    ]
    return spark.createDataFrame(found, "probe string, has_rows boolean")


@_query
def required_tables(spark, sf_dir):
    """The rows of tables that must exist, or the error's name where one does not."""

    def outcome(name: str, read: Callable[[], DataFrame]) -> DataFrame:
        try:
            rows = read()
        except DataSourceUnavailable as missing:
            error = type(missing).__name__
            return spark.range(1).select(F.lit(name).alias("table_name"), F.lit(0).cast("long").alias("n_rows"), F.lit(error).alias("error"))
        return rows.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows", F.lit("none").alias("error"))

    there, missing = _loaded_lake(spark, sf_dir), Lake.at_path(working_dir(spark, "no-lake"))
    absent = f"no_database_{uuid.uuid4().hex}.bronze"
    return (
        outcome("stored", lambda: there.bronze.read(spark))
        .union(outcome("missing", lambda: missing.bronze.read(spark)))
        .union(outcome("required by SQL", lambda: run_query(spark, f"SELECT * FROM {absent}", requires=[absent])))
    )


@_query
def run_samples(spark, sf_dir):
    """The samples that a run stores: the same rows each time."""
    root = working_dir(spark, "side")
    lake = _loaded_lake(spark, sf_dir, samples=f"{root}/samples")
    build_silver(spark, lake, whole_range(spark, sf_dir), on_failure="quarantine")
    stored = spark.read.parquet(f"{lake.samples}/suite={contracts.SILVER_SUITE.name}")
    return stored.select(
        F.col("partition_key").cast("string").alias("partition_key"), "location_id", "source", "tavg_c", "prcp_mm"
    )


@_query
def publish_routed(spark, sf_dir):
    """A run of the ``prod`` environment, which has a target of its own."""
    root = working_dir(spark, "lake")
    prod = DaySink(serving_by_day(path=f"{root}/prod"))
    other = DaySink(serving_by_day(path=f"{root}/other"))
    lake = _loaded_lake(spark, sf_dir, env="PROD", targets={"prod": prod, "default": other})
    run_window(spark, lake, whole_range(spark, sf_dir), on_failure="quarantine")
    rows = _comparable(prod.table.read(spark))
    return rows.withColumn("in_default", F.lit(other.table.exists(spark)))


@_query
def quarantined_and_kept(spark, sf_dir):
    """Rows by day after a run that puts failing days aside: none is lost."""
    lake = _loaded_lake(spark, sf_dir)
    run_window(spark, lake, whole_range(spark, sf_dir), on_failure="quarantine")
    aside = spark.read.schema(SILVER).parquet(f"{lake.quarantine}/silver_climate_daily_features")
    both = lake.silver.read(spark).unionByName(aside)
    return both.groupBy("ingest_date").agg(F.count("*").alias("n_rows"))


@_query
def missing_days_run(spark, sf_dir):
    """Bronze after its missing days have been run, all in one job."""
    root = working_dir(spark, "lake")
    lake = Lake.at_path(root, quarantine=f"{root}/quarantine")
    replace_partitions(bronze(spark, sf_dir).where("day(observation_date) % 3 <> 0"), lake.bronze)
    run_missing(
        spark,
        lake,
        whole_range(spark, sf_dir),
        readings=readings(spark, sf_dir).drop("latitude", "longitude"),
        locations=locations(spark, sf_dir),
        source=F.col("source"),
        on_failure="quarantine",
    )
    return lake.bronze.read(spark).groupBy("ingest_date").agg(F.count("*").alias("n_rows"))


@_query
def parse_props(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k int").getField("k").alias("k"))


@_query
def locations_csv(spark, sf_dir):
    path = working_dir(spark, "locations")
    locations(spark, sf_dir).write.option("header", True).csv(path)
    return read_locations(spark, path)


@_query
def bronze_observations(spark, sf_dir):
    return _comparable(bronze(spark, sf_dir))


@_query
def location_date_grid_counts(spark, sf_dir):
    days = whole_range(spark, sf_dir)
    grid = location_date_grid(locations(spark, sf_dir), days.start, days.end)
    counts = (
        bronze(spark, sf_dir)
        .groupBy("location_id", "observation_date")
        .agg(F.count(F.lit(1)).alias("readings"))
    )
    return grid.join(counts, ["location_id", "observation_date"], "left").select(
        "location_id",
        "observation_date",
        "latitude",
        "longitude",
        F.coalesce("readings", F.lit(0).cast("long")).alias("readings"),
    )


@_query
def parametrised_query(spark, sf_dir):
    view = "gold_days"
    gold(spark, sf_dir).createOrReplaceTempView(view)
    rows = run_query(
        spark,
        f"""SELECT region_id, observation_date, total_prcp_mm, had_precip FROM {view}
            WHERE observation_date BETWEEN to_date(:first, 'yyyy-MM-dd') AND :last""",
        {"first": "2024-01-05", "last": date(2024, 1, 9)},
        requires=[view],
    )
    return _comparable(rows)


# ---------------------------------------------------------------- features



def _with_feature(spark: SparkSession, sf_dir: str, feature: Column) -> DataFrame:
    return readings(spark, sf_dir).select("event_id", "tavg_c", "prcp_mm", feature)


@_query
def hdd18(spark, sf_dir):
    return _with_feature(spark, sf_dir, heating_degree_days("tavg_c").alias("hdd18"))


@_query
def cdd18(spark, sf_dir):
    return _with_feature(spark, sf_dir, cooling_degree_days("tavg_c").alias("cdd18"))


@_query
def gdd10_30(spark, sf_dir):
    return _with_feature(spark, sf_dir, growing_degree_days("tavg_c").alias("gdd10_30"))


@_query
def prcp_flag(spark, sf_dir):
    return _with_feature(spark, sf_dir, precipitation_flag("prcp_mm").alias("prcp_flag"))


@_query
def missing_as_null_features(spark, sf_dir):
    rows = silver_features(bronze(spark, sf_dir), missing_as_zero=False)
    return rows.select("location_id", "observation_date", "source", "hdd18", "cdd18", "gdd10_30")


@_query
def silver_climate_features(spark, sf_dir):
    return _comparable(silver(spark, sf_dir))


# ---------------------------------------------------------------- aggregates, windows


@_query
def gold_climate_summary(spark, sf_dir):
    return _comparable(gold(spark, sf_dir))


@_query
def gold_from_listed_sources(spark, sf_dir):
    names = ["view", "click", "error", "purchase", "signup"]
    return _comparable(gold_summary(silver(spark, sf_dir), names))


@_query
def rolling_region_windows(spark, sf_dir):
    return _comparable(rolling_windows(gold(spark, sf_dir)))


@_query
def rolling_windows_one_region(spark, sf_dir):
    rows = rolling_windows(gold(spark, sf_dir), (3, 14), region=REGION)
    return _comparable(rows.orderBy("observation_date"))


def _daily_orders(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy(key, F.to_date("o_orderdate").alias("order_day"))
        .agg(F.sum("o_totalprice").alias("revenue"))
    )


def _rolling_revenue(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    rows = rolling_windows(
        _daily_orders(spark, sf_dir, key),
        key=key,
        order="order_day",
        mean_of="revenue",
        sum_of="revenue",
        mean_name="avg_revenue",
        sum_name="revenue",
    )
    return _comparable(rows, 4)


@_query
def rolling_revenue_by_priority(spark, sf_dir):
    return _rolling_revenue(spark, sf_dir, "o_orderpriority")


@_query
def rolling_revenue_by_customer(spark, sf_dir):
    return _rolling_revenue(spark, sf_dir, "o_custkey")


# ---------------------------------------------------------------- serving


@_query
def region_snapshot(spark, sf_dir):
    return _comparable(serving.region_snapshot(stored_gold(spark, sf_dir, DayRange(DAY, DAY)), DAY))


@_query
def snapshot_totals(spark, sf_dir):
    return _comparable(serving.snapshot_totals(stored_gold(spark, sf_dir, DayRange(DAY, DAY)), DAY))


@_query
def all_days_totals(spark, sf_dir):
    return _comparable(serving.snapshot_totals(gold(spark, sf_dir)), 4)


@_query
def region_history(spark, sf_dir):
    stored = stored_gold(spark, sf_dir, DayRange.lookback(30, LAST))
    return _comparable(serving.region_history(stored, REGION, as_of=LAST))


@_query
def latest_first(spark, sf_dir):
    as_of = date(2024, 1, 20)
    stored = stored_gold(spark, sf_dir, DayRange.lookback(10, as_of))
    rows = serving.region_history(stored, REGION, 10, as_of=as_of, newest_first=True)
    return _comparable(rows)


@_query
def available_dates(spark, sf_dir):
    return serving.available_dates(stored_gold(spark, sf_dir), 10)


@_query
def region_list(spark, sf_dir):
    return serving.regions(stored_gold(spark, sf_dir))


@_query
def head_rows(spark, sf_dir):
    return _comparable(
        serving.head_rows(gold(spark, sf_dir), [F.desc("observation_date"), "region_id"])
    )


@_query
def serving_rows(spark, sf_dir):
    return _comparable(serving_shape(gold(spark, sf_dir)))


@_query
def serving_rows_float32(spark, sf_dir):
    return _shown_floats(serving_shape(gold(spark, sf_dir), float32=True))


def _shown_floats(rows: DataFrame) -> DataFrame:
    """Floats as doubles, to a thousandth: a sum's last digits depend on its order."""
    return rows.select(
        [
            F.round(F.col(name).cast("double"), 3).alias(name) if kind == "float" else F.col(name)
            for name, kind in rows.dtypes
        ]
    )


_RECORD = (
    "region_id string, observation_date string, ingest_date string, source string, "
    "avg_temp_c double, total_prcp_mm double, had_precip string, avg_hdd18 double, "
    "avg_cdd18 double"
)


@_query
def json_record_rows(spark, sf_dir):
    records = json_records(gold(spark, sf_dir))
    return _comparable(records.select(F.from_json("value", _RECORD).alias("r")).select("r.*"))


@_query
def dates_as_text_rows(spark, sf_dir):
    rows = dates_as_text(gold(spark, sf_dir))
    return _comparable(rows.select("region_id", "observation_date", "ingest_date", "avg_temp_c"))


# ---------------------------------------------------------------- contracts


def _shown_report(report: DataFrame) -> DataFrame:
    return report.select("suite", "partition_key", "rule", "column_name", "violations", "passed")


@_query
def contract_silver(spark, sf_dir):
    return _shown_report(
        contracts.contract_report(silver(spark, sf_dir), contracts.SILVER_SUITE)
    )


@_query
def contract_gold(spark, sf_dir):
    return _shown_report(contracts.contract_report(gold(spark, sf_dir), contracts.GOLD_SUITE))


@_query
def contract_by_location(spark, sf_dir):
    report = contracts.contract_report(
        silver(spark, sf_dir), contracts.SILVER_SUITE, by="location_id"
    )
    return _shown_report(report)


@_query
def contract_gate(spark, sf_dir):
    rows = silver(spark, sf_dir)
    report = contracts.contract_report(rows, contracts.SILVER_SUITE)
    return _comparable(contracts.passing_rows(rows, report))


@_query
def contract_quarantine(spark, sf_dir):
    rows = silver(spark, sf_dir)
    report = contracts.contract_report(rows, contracts.SILVER_SUITE)
    return _comparable(contracts.failing_rows(rows, report))


@_query
def contract_sample(spark, sf_dir):
    keys = ["location_id", "source", "tavg_c", "prcp_mm"]
    rows = contracts.contract_sample(silver(spark, sf_dir), contracts.SILVER_SUITE, keys)
    return rows.select("suite", "partition_key", *keys)


# ---------------------------------------------------------------- table writes


def _revised_day(rows: DataFrame, measure: str) -> DataFrame:
    """One day again, with changed values and one source fewer."""
    day = rows.where((F.col("observation_date") == F.lit(DAY)) & (F.col("source") != "click"))
    return day.withColumn(measure, F.col(measure) + F.lit(1.0))


def _catalog_lake(spark: SparkSession, label: str, **options) -> Lake:
    """An empty lake in the catalog at a new place; the tables that an earlier run of the
    query left under these names are dropped."""
    root = working_dir(spark, f"catalog-{label}")
    lake = Lake.in_catalog(env=f"query-{label}", root=root, quarantine=f"{root}/quarantine", **options)
    for stored in (lake.bronze, lake.silver, lake.gold):
        _dropped(spark, stored.name)
    return lake


def _dropped(spark: SparkSession, name: str) -> str:
    spark.sql(f"DROP DATABASE IF EXISTS {quoted(name.rsplit('.', 1)[0])} CASCADE")
    return name


@_query
def upsert_partitions(spark, sf_dir):
    target = _table_at(spark, "silver", SILVER, sort_by=("location_id",))
    rows = silver(spark, sf_dir)
    replace_partitions(rows, target)
    replace_partitions(_revised_day(rows, "prcp_mm"), target)
    return _comparable(target.read(spark))


@_query
def upsert_catalog_table(spark, sf_dir):
    target = _catalog_lake(spark, "upsert").silver
    rows = silver(spark, sf_dir)
    replace_partitions(rows, target)
    replace_partitions(_revised_day(rows, "prcp_mm"), target)
    return _comparable(target.read(spark))


@_query
def export_partitioned_parquet(spark, sf_dir):
    path = working_dir(spark, "export")
    rows = gold(spark, sf_dir)
    export_parquet(rows, path, ["ingest_date"])
    return _comparable(Table(GOLD, ("ingest_date",), path=path).read(spark))


@_query
def silver_export(spark, sf_dir):
    """The exported copy of silver, from a run that also writes samples."""
    root = working_dir(spark, "side")
    lake = _loaded_lake(spark, sf_dir, exports=f"{root}/exports", samples=f"{root}/samples")
    build_silver(spark, lake, whole_range(spark, sf_dir), on_failure="quarantine")
    return _comparable(
        spark.read.schema(SILVER).parquet(f"{lake.exports}/{TABLE_NAMES['silver']}")
    )


def _publish_both(spark: SparkSession, sf_dir: str, sink) -> None:
    rows = stage(gold(spark, sf_dir), "gold")
    sink.publish(rows, whole_range(spark, sf_dir))
    sink.publish(_revised_day(rows, "total_prcp_mm"), DayRange(DAY, DAY))


def _publish_twice(spark: SparkSession, sf_dir: str, sink) -> DataFrame:
    _publish_both(spark, sf_dir, sink)
    return sink.table.read(spark)


@_query
def publish_month_catalog(spark, sf_dir):
    """Days replaced in a catalog table kept by month."""
    name = _dropped(spark, "query_month.serving")
    sink = MonthSink(serving_by_month(name, working_dir(spark, "serving-catalog")))
    return _comparable(_publish_twice(spark, sf_dir, sink))


@_query
def publish_float32(spark, sf_dir):
    sink = DaySink(serving_by_day(path=working_dir(spark, "serving-float"), float32=True))
    return _shown_floats(_publish_twice(spark, sf_dir, sink))


@_query
def publish_json_records(spark, sf_dir):
    """Published JSON files, all fields read back."""
    sink = JsonSink(working_dir(spark, "serving-json"))
    _publish_both(spark, sf_dir, sink)
    lines = spark.read.schema("value string, observation_date date").text(sink.path)
    return _comparable(lines.select(F.from_json("value", _RECORD).alias("r")).select("r.*"))


@_query
def publish_truncate_day(spark, sf_dir):
    sink = DaySink(serving_by_day(path=working_dir(spark, "serving-day")))
    rows = _publish_twice(spark, sf_dir, sink)
    suffix = partition_suffix("observation_date").alias("partition_suffix")
    return _comparable(rows.select("*", suffix))


@_query
def publish_delete_insert(spark, sf_dir):
    sink = MonthSink(serving_by_month(path=working_dir(spark, "serving-month")))
    return _comparable(_publish_twice(spark, sf_dir, sink))


# ---------------------------------------------------------------- days and runs


@_query
def missing_partitions(spark, sf_dir):
    return missing_days(bronze(spark, sf_dir), FIRST, date(2024, 2, 5))


@_query
def days_without_a_table(spark, sf_dir):
    """All days of the readings are still to run when bronze does not exist."""
    lake = Lake.at_path(working_dir(spark, "no-lake"))
    return days_to_run(spark, lake, whole_range(spark, sf_dir))


def _loaded_lake(spark: SparkSession, sf_dir: str, **options) -> Lake:
    root = working_dir(spark, "lake")
    lake = Lake.at_path(root, quarantine=f"{root}/quarantine", **options)
    replace_partitions(bronze(spark, sf_dir), lake.bronze)
    return lake


@_query
def range_run(spark, sf_dir):
    """Landed readings to the serving table, all days in one run."""
    root = working_dir(spark, "lake")
    sink = DaySink(serving_by_day(path=f"{root}/serving"))
    lake = Lake.at_path(root, targets={"default": sink}, quarantine=f"{root}/quarantine")
    rows = readings(spark, sf_dir)
    run_window(
        spark,
        lake,
        whole_range(spark, sf_dir),
        readings=rows.drop("latitude", "longitude"),
        locations=locations(spark, sf_dir),
        source=F.col("source"),
        ingested_at=F.lit(LOADED_AT).cast("timestamp"),
        on_failure="quarantine",
    )
    return _comparable(sink.table.read(spark))


@_query
def backfill_run(spark, sf_dir):
    lake = _loaded_lake(spark, sf_dir)
    request = BackfillRequest.from_mapping({"start": "2024-01-03", "end": "2024-01-12"})
    run_backfill(spark, lake, request, on_failure="quarantine")
    return _comparable(lake.gold.read(spark))


@_query
def incremental_lookback(spark, sf_dir):
    lake = _loaded_lake(spark, sf_dir)
    run_lookback(spark, lake, 7, as_of=date(2024, 1, 20), on_failure="quarantine")
    return _comparable(lake.gold.read(spark))


@_query
def retention_tier(spark, sf_dir):
    days = bronze(spark, sf_dir).select("observation_date").distinct()
    layers = F.explode(F.array(F.lit("bronze"), F.lit("silver"), F.lit("gold")))
    return retention_tiers(days.select(layers.alias("layer"), "observation_date"), "2024-05-20")


@_query
def retention_inventory(spark, sf_dir):
    """Tier of every stored day of each layer, from its files."""
    lake = _loaded_lake(spark, sf_dir)
    run_window(spark, lake, whole_range(spark, sf_dir), on_failure="quarantine")
    stored = files.partition_inventory(
        spark, {"bronze": lake.bronze, "silver": lake.silver, "gold": lake.gold}
    )
    tiers = retention_tiers(stored, "2024-05-20")
    return tiers.select(
        "layer", "observation_date", "age_days", "tier", (F.least("files", "bytes") > 0).alias("has_files")
    )


@_query
def emptied_days_removed(spark, sf_dir):
    """Gold by day after a day's readings were withdrawn and its lake run again."""
    lake, days = _loaded_lake(spark, sf_dir), whole_range(spark, sf_dir)
    run_window(spark, lake, days, on_failure="quarantine")
    withdrawn = lake.bronze.read(spark).where(F.col("ingest_date") == F.lit(DAY)).select("ingest_date")
    drop_days(withdrawn, lake.bronze)
    run_window(spark, lake, days, on_failure="quarantine", drop_emptied=True)
    layers = [lake.silver.read(spark).select(F.lit("silver").alias("layer"), "ingest_date")]
    layers.append(lake.gold.read(spark).select(F.lit("gold").alias("layer"), "ingest_date"))
    return layers[0].union(layers[1]).groupBy("layer", "ingest_date").agg(F.count("*").alias("n_rows"))


# ---------------------------------------------------------------- write, audit, publish


def _audited_lake(spark: SparkSession, sf_dir: str, label: str) -> Lake:
    lake = _catalog_lake(spark, label)
    replace_partitions(bronze(spark, sf_dir), lake.bronze)
    return lake


@_query
def audited_silver_rows(spark, sf_dir):
    """Silver written aside, audited and published, twice: the second run switches days."""
    lake = _audited_lake(spark, sf_dir, "audited-silver")
    for _ in range(2):
        audited_silver(spark, lake, whole_range(spark, sf_dir), on_failure="quarantine")
    return _comparable(lake.silver.read(spark))


@_query
def audited_report(spark, sf_dir):
    """What the write of silver observed, as a contract report."""
    lake = _audited_lake(spark, sf_dir, "audited-report")
    return _shown_report(audited_silver(spark, lake, whole_range(spark, sf_dir), on_failure="quarantine"))


@_query
def audited_gold_rows(spark, sf_dir):
    lake, days = _audited_lake(spark, sf_dir, "audited-gold"), whole_range(spark, sf_dir)
    audited_silver(spark, lake, days, on_failure="quarantine")
    audited_gold(spark, lake, days, on_failure="quarantine")
    return _comparable(lake.gold.read(spark))


# ---------------------------------------------------------------- merged aggregates


def _arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Bronze in three loads, each with readings of all days."""
    rows = bronze(spark, sf_dir)
    share = F.pmod(F.xxhash64("location_id", "source"), F.lit(3))
    return [rows.where(share == k) for k in range(3)]


@_query
def gold_from_partials(spark, sf_dir):
    """Gold merged from the partials of three loads, one of which came twice."""
    lake = Lake.at_path(working_dir(spark, "lake"))
    stored = partials_at(working_dir(spark, "partials"))
    arrivals = _arrivals(spark, sf_dir)
    for k in (0, 1, 1, 2):
        merge_load(spark, lake, stored, arrivals[k], f"load-{k}")
    rows = stored.read(spark)
    return _comparable(merged_gold(rows.join(failing_days(rows), "ingest_date", "left_anti")))


@_query
def stream_gold_partials(spark, sf_dir):
    """Gold kept by a stream that reads each bronze file once; days that fail are left out."""
    lake = Lake.at_path(working_dir(spark, "lake"))
    stored, state = partials_at(working_dir(spark, "partials")), working_dir(spark, "partials-state")
    for rows in _arrivals(spark, sf_dir):
        rows.write.mode("append").partitionBy("ingest_date").parquet(lake.bronze.path)
        start_partial_refresh(spark, lake, stored, state).awaitTermination()
    failing = failing_days(stored.read(spark))
    return _comparable(lake.gold.read(spark).join(failing, "ingest_date", "left_anti"))


@_query
def distinct_regions_sketch(spark, sf_dir):
    """Regions by week and over all days, estimated from sketches of days; with the exact
    number, counted for comparison."""
    path = working_dir(spark, "sketches")
    region_sketches(gold(spark, sf_dir)).write.parquet(path)
    sketches = spark.read.schema(SKETCHES).parquet(path)
    week = F.date_trunc("week", "ingest_date").cast("date").alias("week")
    whole = F.lit(None).cast("date").alias("week")
    estimated = distinct_regions(sketches, week).union(distinct_regions(sketches, whole))
    rows = gold(spark, sf_dir)
    exact = [rows.groupBy(by).agg(F.count_distinct("region_id").alias("exact_regions")) for by in (week, whole)]
    both = estimated.join(exact[0].union(exact[1]).withColumnRenamed("week", "_week"), F.col("week").eqNullSafe(F.col("_week")))
    close = F.abs(F.col("regions") - F.col("exact_regions")) <= 0.05 * F.col("exact_regions")
    return both.select("week", "exact_regions", close.alias("within_bound"))


def _bucketed(spark: SparkSession, sf_dir: str, label: str) -> Table:
    name = _dropped(spark, f"query_{label}.serving")
    sink = MonthSink(serving_by_region(name, working_dir(spark, "serving-region"), 8))
    rows = stage(gold(spark, sf_dir), "gold")
    days = whole_range(spark, sf_dir)
    sink.publish(rows, days)
    sink.publish(rows, DayRange(days.end, days.end))  # a day again
    return sink.table


@_query
def bucketed_rolling_windows(spark, sf_dir):
    """Rolling windows over the table that is bucketed by region: no shuffle."""
    return _comparable(rolling_windows(_bucketed(spark, sf_dir, "buckets").read(spark)))


@_query
def bucketed_region_windows(spark, sf_dir):
    """One region, read from one bucket."""
    rows = rolling_windows(_bucketed(spark, sf_dir, "bucket").read(spark), (3, 14), region=REGION)
    return _comparable(rows)


@_query
def orphan_files(spark, sf_dir):
    """Days written below a catalog table's location without being registered, at a time
    when the later ones are still too young to be reported."""
    registered = _catalog_lake(spark, "orphans").silver
    rows = silver(spark, sf_dir)
    split = F.lit(date(2024, 1, 20))
    replace_partitions(rows.where(F.col("ingest_date") <= split), registered)
    stray = Table(SILVER, ("ingest_date",), path=registered.path)
    later = F.lit(date(2024, 1, 25))
    unregistered = rows.where(F.col("ingest_date") > split)
    replace_partitions(unregistered.where(F.col("ingest_date") <= later), stray)
    listed = files.files_of(spark, [("silver", f) for f in files.day_folders(spark, registered)])
    newest = listed.agg(F.max("modificationTime")).first()[0] or datetime(2024, 1, 1)
    replace_partitions(unregistered.where(F.col("ingest_date") > later), stray)
    found = files.stray_files(
        spark, registered, newest + SAFETY_HORIZON + timedelta(milliseconds=1)
    )
    day = F.regexp_extract("path", "ingest_date=([0-9-]+)/", 1)
    return found.select(F.to_date(day).alias("orphan_day")).distinct()


# ---------------------------------------------------------------- alerts and streams


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log lines: their type decides the severity."""
    kind = F.col("event_type")
    severity = F.when(kind == "error", "ERROR").when(kind == "purchase", "NOTICE")
    return table(spark, sf_dir, "events").withColumn("severity", severity.otherwise("INFO"))


@_query
def alert_error_rate(spark, sf_dir):
    return alerts.error_rate(_log(spark, sf_dir), alerts.severity_at_least("severity", "ERROR"))


@_query
def alert_threshold(spark, sf_dir):
    return alerts.count_above(
        table(spark, sf_dir, "events"), threshold=5, seconds=3600, key=["event_type"]
    )


@_query
def alert_any_failure(spark, sf_dir):
    failures = table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    return alerts.count_above(failures, threshold=0, seconds=300)


@_query
def alert_absence(spark, sf_dir):
    return alerts.gaps(table(spark, sf_dir, "events"), ["user_id"])


@_query
def alert_stale_keys(spark, sf_dir):
    return alerts.stale_keys(table(spark, sf_dir, "events"), ["user_id"], datetime(2024, 1, 31))


@_query
def absence_sessions(spark, sf_dir):
    return alerts.activity_sessions(table(spark, sf_dir, "events"), ["user_id"], 43_200)


@_query
def stream_gold(spark, sf_dir):
    """Gold kept up to date by the stream of bronze files."""
    lake = _loaded_lake(spark, sf_dir)
    state = working_dir(spark, "refresh")
    start_refresh(spark, lake, state, on_failure="quarantine").awaitTermination()
    return _comparable(lake.gold.read(spark))


def _run_stream(spark: SparkSession, result: DataFrame, label: str) -> DataFrame:
    """Drain a streaming result into files and read them."""
    path = working_dir(spark, label)
    (
        result.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", working_dir(spark, f"{label}-state"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(result.schema).parquet(path)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    # A pattern, since a file and a folder of files are both found by it.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.[p]arquet")


@_query
def stream_alert_error_rate(spark, sf_dir):
    """Windows closed when the stream has been drained."""
    events = _event_stream(spark, sf_dir)
    result = stream_error_rate(events, F.col("event_type") == "error")
    rows = _run_stream(spark, result, "error-rate")
    return _comparable(rows)


@_query
def stream_alert_threshold(spark, sf_dir):
    """Hours closed when the stream has been drained."""
    events = _event_stream(spark, sf_dir)
    result = stream_count_above(events, threshold=2, seconds=3600, key=["event_type"])
    return _comparable(_run_stream(spark, result, "threshold"))


@_query
def stream_alert_absence(spark, sf_dir):
    """Sessions closed when the stream has been drained."""
    result = stream_absence(_event_stream(spark, sf_dir), ["user_id"], 86_400)
    return _comparable(_run_stream(spark, result, "absence"))


@_query
def stream_alert_open_silence(spark, sf_dir):
    """Users that are silent at an instant, from the last event times a stream kept."""
    path, key = working_dir(spark, "last-seen"), ["user_id"]
    start_last_seen(_event_stream(spark, sf_dir), key, path, working_dir(spark, "last-seen-state")).awaitTermination()
    schema = "user_id bigint, last_seen timestamp_ntz"
    compact_last_seen(spark, path, schema, key)
    return open_silences(last_seen(spark, path, schema), key, datetime(2024, 1, 31))


@_query
def stream_late_events(spark, sf_dir):
    """Every event, and whether it came behind the watermark: the events of the first ten
    days, then nine in ten of the others, then the rest, each in a batch."""
    events, landing = table(spark, sf_dir, "events"), working_dir(spark, "arrivals")
    path, state = working_dir(spark, "late"), working_dir(spark, "late-state")
    early, tenth = F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz"), F.col("event_id") % 10 == 9
    for part in (early, ~early & ~tenth, ~early & tenth):
        events.where(part).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(events.schema).parquet(landing)
        start_late_split(stream, path, state).awaitTermination()
    return split_events(spark, path, events.schema).select("event_id", "ts", "late")
