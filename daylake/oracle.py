"""Equivalent SQL (DuckDB dialect) for the queries in :mod:`daylake.registry`."""

from __future__ import annotations

READINGS = """readings AS (
  SELECT event_id, 'LOC' || CAST(user_id AS VARCHAR) AS location_id,
         CAST(ts AS DATE) AS observation_date, event_type AS source,
         CASE WHEN event_type = 'error' THEN NULL
              WHEN isodow(ts) = 7 THEN value / CAST(2 AS DOUBLE) - CAST(15 AS DOUBLE)
              ELSE least(value / CAST(6 AS DOUBLE) - CAST(15 AS DOUBLE), CAST(60 AS DOUBLE))
         END AS tavg_c,
         CASE WHEN event_type = 'view' THEN CAST(0 AS DOUBLE)
              WHEN event_type NOT IN ('error', 'signup') THEN value END AS prcp_mm,
         CAST(user_id % 181 - 90 AS DOUBLE) AS latitude,
         CAST(user_id * 7 % 361 - 180 AS DOUBLE) AS longitude,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k
  FROM events)"""

_D = "CAST({} AS DOUBLE)".format

HDD = f"greatest({_D(0)}, {_D(18)} - tavg_c)"
CDD = f"greatest({_D(0)}, tavg_c - {_D(18)})"
GDD = f"least(greatest(tavg_c, {_D(10)}), {_D(30)}) - {_D(10)}"
FLAG = "CASE WHEN prcp_mm > 0 THEN 'Y' ELSE 'N' END"

SILVER = f"""{READINGS}, silver AS (
  SELECT location_id, source, observation_date, observation_date AS ingest_date,
         tavg_c, prcp_mm, latitude, longitude,
         {HDD} AS hdd18, {CDD} AS cdd18, {GDD} AS gdd10_30, {FLAG} AS prcp_flag,
         TIMESTAMP '2024-02-01 00:00:00' AS ingested_at
  FROM readings)"""


def _gold_from(silver: str) -> str:
    return f"""
  SELECT location_id AS region_id, observation_date, ingest_date, min(source) AS source,
         avg(tavg_c) AS avg_temp_c, sum(prcp_mm) AS total_prcp_mm,
         max(prcp_flag) AS had_precip, avg(hdd18) AS avg_hdd18, avg(cdd18) AS avg_cdd18
  FROM {silver} GROUP BY location_id, observation_date, ingest_date"""


GOLD = f"{SILVER}, gold AS ({_gold_from('silver')})"

PASSING = f"""{SILVER}, failed AS (
  SELECT observation_date FROM silver GROUP BY observation_date
  HAVING count(*) FILTER (tavg_c < -90 OR tavg_c > 60 OR prcp_mm < 0) > 0
      OR count(tavg_c) + count(prcp_mm) = 0
      OR count(*) FILTER (location_id IS NULL) > 0
), passing AS (
  SELECT * FROM silver WHERE observation_date NOT IN (SELECT observation_date FROM failed)
), gold AS ({_gold_from('passing')})"""


def _r(column: str, digits: int = 7) -> str:
    return f"round({column}, {digits}) AS {column}"


MEASURES = f"{_r('avg_temp_c')}, {_r('total_prcp_mm')}, had_precip, {_r('avg_hdd18')}, {_r('avg_cdd18')}"
GOLD_COLUMNS = f"region_id, observation_date, ingest_date, source, {MEASURES}"
BRONZE_COLUMNS = """source, location_id, observation_date, observation_date AS ingest_date,
  tavg_c, prcp_mm, latitude, longitude, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at"""


def _feature(name: str, expression: str) -> str:
    return f"WITH {READINGS} SELECT event_id, tavg_c, prcp_mm, {expression} AS {name} FROM readings"


def _rolling(source: str, key: str, order: str, mean: str, total: str, outputs, widths, digits):
    short, long = widths

    def frame(call: str, width: int, name: str) -> str:
        return (
            f"round({call} OVER (PARTITION BY {key} ORDER BY {order} "
            f"ROWS BETWEEN {width - 1} PRECEDING AND CURRENT ROW), {digits}) AS {name}"
        )

    mean_name, sum_name = outputs
    return f"""SELECT {order}, {key},
      {frame(f'avg({mean})', short, f'{mean_name}_{short}d')},
      {frame(f'sum({total})', short, f'{sum_name}_{short}d')},
      {frame(f'sum({total})', long, f'{sum_name}_{long}d')}
      FROM {source}"""


def _gold_rolling(widths, where: str = "") -> str:
    return f"WITH {GOLD} " + _rolling(
        f"gold {where}", "region_id", "observation_date", "avg_temp_c", "total_prcp_mm",
        ("avg_temp", "prcp"), widths, 7,
    )


def _orders_rolling(key: str) -> str:
    daily = f"""WITH daily AS (
      SELECT {key}, CAST(o_orderdate AS DATE) AS order_day, sum(o_totalprice) AS revenue
      FROM orders GROUP BY ALL) """
    return daily + _rolling(
        "daily", key, "order_day", "revenue", "revenue", ("avg_revenue", "revenue"), (7, 30), 4
    )


def _report(source: str, frame: str, suite: str, by: str, checks: list[tuple[str, str, str]]) -> str:
    lines = [
        f"""SELECT '{suite}' AS suite, CAST({by} AS VARCHAR) AS partition_key, '{rule}' AS rule,
            '{column}' AS column_name, CAST({count} AS BIGINT) AS violations,
            {count} = 0 AS passed FROM {frame} GROUP BY {by}"""
        for rule, column, count in checks
    ]
    return f"WITH {source} " + " UNION ALL ".join(lines)


def _bad(condition: str) -> str:
    return f"count(*) FILTER ({condition})"


def _silver_report(by: str) -> str:
    return _report(SILVER, "silver", "silver_climate_daily_features", by, [
        ("required", "location_id", _bad("location_id IS NULL")),
        ("required", "observation_date", _bad("observation_date IS NULL")),
        ("not_all_missing", "tavg_c+prcp_mm",
         "(CASE WHEN count(tavg_c) + count(prcp_mm) = 0 THEN count(*) ELSE 0 END)"),
        ("min", "tavg_c", _bad("tavg_c < -90")),
        ("max", "tavg_c", _bad("tavg_c > 60")),
        ("min", "prcp_mm", _bad("prcp_mm < 0")),
    ])


SILVER_SHOWN = """location_id, source, observation_date, ingest_date, tavg_c, prcp_mm, latitude,
  longitude, hdd18, cdd18, gdd10_30, prcp_flag, ingested_at"""

# One day again, with a measure raised by one and the 'click' rows gone.
UPSERTED = f"""WITH {SILVER}
  SELECT {SILVER_SHOWN} FROM silver WHERE observation_date <> DATE '2024-01-05'
  UNION ALL
  SELECT {SILVER_SHOWN.replace('prcp_mm', 'prcp_mm + 1 AS prcp_mm')} FROM silver
  WHERE observation_date = DATE '2024-01-05' AND source <> 'click'"""


def _published(extra: str) -> str:
    shown = GOLD_COLUMNS
    revised = shown.replace(_r("total_prcp_mm"), "round(total_prcp_mm + 1, 7) AS total_prcp_mm")
    return f"""WITH {GOLD}
  SELECT {shown}, {extra} FROM gold WHERE observation_date <> DATE '2024-01-05'
  UNION ALL
  SELECT {revised}, {extra} FROM gold
  WHERE observation_date = DATE '2024-01-05' AND source <> 'click'"""


def _buckets(seconds: int, where: str = "TRUE", key: str = "") -> str:
    window = f"time_bucket(INTERVAL {seconds} SECOND, ts, TIMESTAMP '1970-01-01')"
    return f"""SELECT {window} AS window_start,
      {window} + INTERVAL {seconds} SECOND AS window_end, {key} count(*) AS events
      FROM events WHERE {where} GROUP BY ALL"""


ERROR_RATE = f"""SELECT window_start, window_end, events AS errors,
  events / CAST(300 AS DOUBLE) AS rate_per_second, events >= 1 AS alert
  FROM ({_buckets(300, "event_type = 'error'")})"""


def _sessions(seconds: int) -> str:
    return f"""WITH paused AS (
      SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events
    ), numbered AS (
      SELECT user_id, ts, sum(CASE WHEN before IS NULL OR ts - before > INTERVAL {seconds} SECOND
             THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM paused
    ), sessions AS (
      SELECT user_id, min(ts) AS session_start,
             max(ts) + INTERVAL {seconds} SECOND AS session_end, count(*) AS events
      FROM numbered GROUP BY user_id, n)"""




def _watermark(where: str = "TRUE") -> str:
    """A stream emits what its watermark has closed.  It is kept in milliseconds, and
    filters on other columns are applied before event times are observed."""
    return f"""(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE
      FROM events WHERE {where})"""


WHOLE = """whole AS (SELECT CAST(unnest(generate_series(min(observation_date),
  max(observation_date), INTERVAL 1 DAY)) AS DATE) AS observation_date FROM readings)"""

FLOATS = ", ".join(
    f"round(CAST(CAST({c} AS FLOAT) AS DOUBLE), 3) AS {c}"
    for c in ("avg_temp_c", "total_prcp_mm", "avg_hdd18", "avg_cdd18")
)

# All gold after one day has been published again.
REVISED = f"""{GOLD}, revised AS (
  SELECT * FROM gold WHERE observation_date <> DATE '2024-01-05'
  UNION ALL
  SELECT * REPLACE (total_prcp_mm + 1 AS total_prcp_mm) FROM gold
  WHERE observation_date = DATE '2024-01-05' AND source <> 'click')"""

RECORD = f"""region_id, strftime(observation_date, '%Y-%m-%d') AS observation_date,
  strftime(ingest_date, '%Y-%m-%d') AS ingest_date, source, {MEASURES}"""


SPINE = """spine AS (SELECT CAST(d AS DATE) AS observation_date FROM
  range(DATE '2024-01-01', DATE '2024-02-06', INTERVAL 1 DAY) t(d))"""


def all_oracles() -> dict[str, str]:
    gold = f"WITH {GOLD} SELECT"
    quarantined = PASSING.split("), passing AS")[0] + ")"
    return {
        "partition_scan": f"""WITH {READINGS} SELECT {BRONZE_COLUMNS} FROM readings
            WHERE observation_date = DATE '2024-01-05'""",
        "partition_exists": f"""WITH {READINGS}, {SPINE}
            SELECT s.observation_date, count(r.event_id) > 0 AS has_rows
            FROM spine s LEFT JOIN readings r USING (observation_date) GROUP BY ALL""",
        "parse_payload_arrays": f"""WITH {READINGS}
            SELECT event_id, location_id, observation_date, tavg_c, prcp_mm FROM readings
            UNION ALL SELECT event_id, location_id, CAST(observation_date + 1 AS DATE),
            CAST(k AS DOUBLE), NULL FROM readings""",
        "parse_first_reading": f"""WITH {READINGS}
            SELECT event_id, location_id, tavg_c, prcp_mm FROM readings""",
        "parse_bad_replies": """SELECT event_id, CASE event_id % 10 WHEN 0 THEN 'not readable'
            WHEN 1 THEN 'no daily values' WHEN 2 THEN 'not readable' ELSE 'none' END AS problem
            FROM events""",
        "load_places_aside": f"""WITH {READINGS}
            SELECT observation_date AS ingest_date, location_id,
              CASE WHEN latitude >= -80 THEN 'bronze' ELSE 'aside' END AS stored_in,
              count(*) AS n_rows, count(*) FILTER (latitude >= -80) AS n_placed
            FROM readings GROUP BY ALL""",
        "bronze_loaded_now": f"""WITH {READINGS}
            SELECT location_id, observation_date, source, true AS loaded_in_this_run FROM readings""",
        "day_probes": f"""WITH {READINGS}, edge AS (SELECT min(observation_date) AS first FROM readings)
            SELECT 'first day' AS probe,
              EXISTS (SELECT 1 FROM readings, edge WHERE observation_date = first) AS has_rows
            UNION ALL SELECT 'day before',
              EXISTS (SELECT 1 FROM readings, edge WHERE observation_date = first - 1)
            UNION ALL SELECT 'no table', false""",
        "required_tables": f"""WITH {READINGS}
            SELECT 'stored' AS table_name, count(*) AS n_rows, 'none' AS error FROM readings
            UNION ALL SELECT 'missing', 0, 'DataSourceUnavailable'
            UNION ALL SELECT 'required by SQL', 0, 'DataSourceUnavailable'""",
        "run_samples": f"""WITH {SILVER}
            SELECT CAST(ingest_date AS VARCHAR) AS partition_key, location_id, source, tavg_c, prcp_mm
            FROM silver QUALIFY row_number() OVER (PARTITION BY ingest_date
              ORDER BY location_id, source, tavg_c NULLS FIRST, prcp_mm NULLS FIRST) <= 5""",
        "publish_routed": f"""WITH {PASSING}
            SELECT region_id, source, observation_date, ingest_date, {MEASURES}, false AS in_default
            FROM gold""",
        "bronze_load_report": f"""WITH {READINGS}, {SPINE}, places AS (
            SELECT DISTINCT location_id FROM readings WHERE latitude >= -80),
            expected AS (SELECT location_id, observation_date FROM places
              JOIN spine ON observation_date <= DATE '2024-01-30'),
            counts AS (SELECT location_id, observation_date, count(*) AS readings
              FROM readings GROUP BY ALL)
            SELECT location_id, observation_date,
              CASE WHEN c.readings IS NULL THEN 'missing'
                   WHEN location_id NOT IN (SELECT location_id FROM places) THEN 'unknown place'
                   ELSE 'unexpected day' END AS problem, coalesce(c.readings, 0) AS readings
            FROM counts c FULL JOIN (SELECT *, true AS known FROM expected) e
              USING (location_id, observation_date)
            WHERE c.readings IS NULL OR e.known IS NULL""",
        "quarantined_and_kept": f"""WITH {READINGS} SELECT observation_date AS ingest_date,
            count(*) AS n_rows FROM readings GROUP BY ALL""",
        "missing_days_run": f"""WITH {READINGS} SELECT observation_date AS ingest_date,
            count(*) AS n_rows FROM readings GROUP BY ALL""",
        "parse_props": f"WITH {READINGS} SELECT event_id, k FROM readings",
        "locations_csv": f"""WITH {READINGS}
            SELECT DISTINCT location_id, latitude, longitude FROM readings""",
        "bronze_observations": f"WITH {READINGS} SELECT {BRONZE_COLUMNS} FROM readings",
        "location_date_grid_counts": f"""WITH {READINGS}, {WHOLE}, places AS (
            SELECT DISTINCT location_id, latitude, longitude FROM readings)
            SELECT p.location_id, s.observation_date, p.latitude, p.longitude,
                   count(r.event_id) AS readings
            FROM places p CROSS JOIN whole s
            LEFT JOIN readings r ON r.location_id = p.location_id
                 AND r.observation_date = s.observation_date
            GROUP BY ALL""",
        "parametrised_query": f"""{gold} region_id, observation_date, {_r('total_prcp_mm')},
            had_precip FROM gold
            WHERE observation_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'""",
        "hdd18": _feature("hdd18", HDD),
        "cdd18": _feature("cdd18", CDD),
        "gdd10_30": _feature("gdd10_30", GDD),
        "prcp_flag": _feature("prcp_flag", FLAG),
        "missing_as_null_features": f"""WITH {SILVER}
            SELECT location_id, observation_date, source,
                   CASE WHEN tavg_c IS NOT NULL THEN hdd18 END AS hdd18,
                   CASE WHEN tavg_c IS NOT NULL THEN cdd18 END AS cdd18,
                   CASE WHEN tavg_c IS NOT NULL THEN gdd10_30 END AS gdd10_30
            FROM silver""",
        "silver_climate_features": f"WITH {SILVER} SELECT {SILVER_SHOWN} FROM silver",
        "gold_climate_summary": f"{gold} {GOLD_COLUMNS} FROM gold",
        "gold_from_listed_sources": f"{gold} {GOLD_COLUMNS} FROM gold",
        "rolling_region_windows": _gold_rolling((7, 30)),
        "rolling_windows_one_region": _gold_rolling((3, 14), "WHERE region_id = 'LOC7'"),
        "rolling_revenue_by_priority": _orders_rolling("o_orderpriority"),
        "rolling_revenue_by_customer": _orders_rolling("o_custkey"),
        "region_snapshot": f"""{gold} region_id, {MEASURES}, observation_date FROM gold
            WHERE observation_date = DATE '2024-01-05' ORDER BY region_id""",
        "snapshot_totals": f"""{gold} count(DISTINCT region_id) AS regions,
            round(sum(total_prcp_mm), 7) AS total_prcp_mm, round(avg(avg_temp_c), 7) AS avg_temp_c
            FROM gold WHERE observation_date = DATE '2024-01-05'""",
        "all_days_totals": f"""{gold} count(DISTINCT region_id) AS regions,
            round(sum(total_prcp_mm), 4) AS total_prcp_mm, round(avg(avg_temp_c), 4) AS avg_temp_c
            FROM gold""",
        "region_history": f"""{gold} observation_date, {MEASURES} FROM gold
            WHERE region_id = 'LOC7'
              AND observation_date BETWEEN DATE '2023-12-31' AND DATE '2024-01-30'
            ORDER BY observation_date""",
        "latest_first": f"""{gold} observation_date, {MEASURES} FROM gold
            WHERE region_id = 'LOC7'
              AND observation_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
            ORDER BY observation_date DESC""",
        "available_dates": f"""{gold} DISTINCT observation_date FROM gold
            ORDER BY observation_date DESC LIMIT 10""",
        "region_list": f"{gold} DISTINCT region_id FROM gold ORDER BY region_id",
        "head_rows": f"""{gold} {GOLD_COLUMNS} FROM gold
            ORDER BY observation_date DESC, region_id LIMIT 5""",
        "serving_rows": f"""{gold} region_id, source, observation_date, ingest_date, {MEASURES}
            FROM gold""",
        "serving_rows_float32": f"""{gold} region_id, source, observation_date, ingest_date,
            had_precip, {FLOATS} FROM gold""",
        "json_record_rows": f"{gold} {RECORD} FROM gold",
        "dates_as_text_rows": f"""{gold} region_id,
            strftime(observation_date, '%Y-%m-%d') AS observation_date,
            strftime(ingest_date, '%Y-%m-%d') AS ingest_date, {_r('avg_temp_c')} FROM gold""",
        "contract_silver": _silver_report("observation_date"),
        "contract_by_location": _silver_report("location_id"),
        "contract_gold": _report(GOLD, "gold", "gold_climate_daily_summary", "observation_date", [
            ("required", "region_id", _bad("region_id IS NULL")),
            ("required", "observation_date", _bad("observation_date IS NULL")),
            ("min", "total_prcp_mm", _bad("total_prcp_mm < 0")),
            ("not_all_missing", "avg_temp_c",
             "(CASE WHEN count(avg_temp_c) = 0 THEN count(*) ELSE 0 END)"),
        ]),
        "contract_gate": f"WITH {PASSING} SELECT {SILVER_SHOWN} FROM passing",
        "contract_quarantine": f"""WITH {quarantined} SELECT {SILVER_SHOWN} FROM silver
            WHERE observation_date IN (SELECT observation_date FROM failed)""",
        "contract_sample": f"""WITH {SILVER}
            SELECT 'silver_climate_daily_features' AS suite,
                   CAST(observation_date AS VARCHAR) AS partition_key,
                   location_id, source, tavg_c, prcp_mm
            FROM silver QUALIFY row_number() OVER (PARTITION BY observation_date
              ORDER BY location_id, source, tavg_c NULLS FIRST, prcp_mm NULLS FIRST) <= 5""",
        "upsert_partitions": UPSERTED,
        "upsert_catalog_table": UPSERTED,
        "export_partitioned_parquet": f"{gold} {GOLD_COLUMNS} FROM gold",
        "publish_truncate_day": _published(
            "strftime(observation_date, '%Y%m%d') AS partition_suffix"
        ),
        "publish_delete_insert": _published(
            "CAST(year(observation_date) * 100 + month(observation_date) AS INTEGER) AS month"
        ),
        "publish_month_catalog": _published(
            "CAST(year(observation_date) * 100 + month(observation_date) AS INTEGER) AS month"
        ),
        "publish_float32": f"""WITH {REVISED} SELECT region_id, source, observation_date,
            ingest_date, had_precip, {FLOATS} FROM revised""",
        "publish_json_records": f"WITH {REVISED} SELECT {RECORD} FROM revised",
        "silver_export": f"WITH {PASSING} SELECT {SILVER_SHOWN} FROM passing",
        "days_without_a_table": f"WITH {READINGS}, {WHOLE} SELECT observation_date FROM whole",
        "missing_partitions": f"""WITH {READINGS}, {SPINE} SELECT observation_date FROM spine
            WHERE observation_date NOT IN (SELECT observation_date FROM readings)""",
        "range_run": f"""WITH {PASSING}
            SELECT region_id, source, observation_date, ingest_date, {MEASURES} FROM gold""",
        "backfill_run": f"""WITH {PASSING} SELECT {GOLD_COLUMNS} FROM gold
            WHERE observation_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-12'""",
        "incremental_lookback": f"""WITH {PASSING} SELECT {GOLD_COLUMNS} FROM gold
            WHERE observation_date BETWEEN DATE '2024-01-13' AND DATE '2024-01-20'""",
        "retention_tier": f"""WITH {READINGS}, days AS (
            SELECT DISTINCT observation_date FROM readings),
            layers(layer, days_kept) AS (VALUES ('bronze', 60), ('silver', 120), ('gold', 365))
            SELECT layer, observation_date,
              CAST(date_diff('day', observation_date, DATE '2024-05-20') AS INTEGER) AS age_days,
              CASE WHEN date_diff('day', observation_date, DATE '2024-05-20') >= days_kept
                   THEN 'cold' ELSE 'standard' END AS tier
            FROM days, layers""",
        "retention_inventory": f"""WITH {PASSING}, stored(layer, observation_date, days_kept) AS (
              SELECT DISTINCT 'bronze', observation_date, 60 FROM readings
              UNION SELECT 'silver', observation_date, 120 FROM passing
              UNION SELECT 'gold', observation_date, 365 FROM gold)
            SELECT layer, observation_date,
              CAST(date_diff('day', observation_date, DATE '2024-05-20') AS INTEGER) AS age_days,
              CASE WHEN date_diff('day', observation_date, DATE '2024-05-20') >= days_kept
                   THEN 'cold' ELSE 'standard' END AS tier, true AS has_files
            FROM stored""",
        "emptied_days_removed": f"""WITH {PASSING}
            SELECT 'silver' AS layer, ingest_date, count(*) AS n_rows FROM passing
            WHERE ingest_date <> DATE '2024-01-05' GROUP BY ingest_date
            UNION ALL SELECT 'gold', ingest_date, count(*) FROM gold
            WHERE ingest_date <> DATE '2024-01-05' GROUP BY ingest_date""",
        "audited_silver_rows": f"WITH {PASSING} SELECT {SILVER_SHOWN} FROM passing",
        "audited_report": _silver_report("observation_date"),
        "audited_gold_rows": f"WITH {PASSING} SELECT {GOLD_COLUMNS} FROM gold",
        "gold_from_partials": f"WITH {PASSING} SELECT {GOLD_COLUMNS} FROM gold",
        "stream_gold_partials": f"WITH {PASSING} SELECT {GOLD_COLUMNS} FROM gold",
        "distinct_regions_sketch": f"""{gold} CAST(date_trunc('week', ingest_date) AS DATE) AS week,
              count(DISTINCT region_id) AS exact_regions, true AS within_bound FROM gold GROUP BY ALL
            UNION ALL SELECT NULL, count(DISTINCT region_id), true FROM gold""",
        "bucketed_rolling_windows": _gold_rolling((7, 30)),
        "bucketed_region_windows": _gold_rolling((3, 14), "WHERE region_id = 'LOC7'"),
        "stream_alert_open_silence": """WITH seen AS (
            SELECT user_id, max(ts) AS last_seen FROM events GROUP BY user_id)
            SELECT user_id, last_seen,
                   date_diff('microsecond', last_seen, TIMESTAMP '2024-01-31 00:00:00')
                     / CAST(1000000 AS DOUBLE) AS age_seconds,
                   TIMESTAMP '2024-01-31 00:00:00' - last_seen > INTERVAL 86400 SECOND AS stale
            FROM seen""",
        "stream_late_events": """WITH closed AS (
            SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM events
            WHERE ts < TIMESTAMP '2024-01-11 00:00:00' OR event_id % 10 <> 9)
            SELECT event_id, ts, ts >= TIMESTAMP '2024-01-11 00:00:00' AND event_id % 10 = 9
              AND time_bucket(INTERVAL 300 SECOND, ts) + INTERVAL 300 SECOND <= mark AS late
            FROM events, closed""",
        "orphan_files": f"""WITH {READINGS} SELECT DISTINCT observation_date AS orphan_day
            FROM readings WHERE observation_date > DATE '2024-01-20'
              AND observation_date <= DATE '2024-01-25'""",
        "alert_error_rate": ERROR_RATE,
        "alert_threshold": f"""SELECT * FROM ({_buckets(3600, key='event_type,')})
            WHERE events > 5""",
        "alert_any_failure": f"""SELECT * FROM ({_buckets(300, "event_type = 'error'")})
            WHERE events > 0""",
        "alert_absence": """WITH paused AS (
            SELECT user_id, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS last_seen,
                   ts AS next_seen FROM events)
            SELECT user_id, last_seen, next_seen,
                   date_diff('microsecond', last_seen, next_seen) / CAST(1000000 AS DOUBLE)
                     AS gap_seconds
            FROM paused WHERE next_seen - last_seen > INTERVAL 86400 SECOND""",
        "alert_stale_keys": """WITH seen AS (
            SELECT user_id, max(ts) AS last_seen FROM events GROUP BY user_id)
            SELECT user_id, last_seen,
                   date_diff('microsecond', last_seen, TIMESTAMP '2024-01-31 00:00:00')
                     / CAST(1000000 AS DOUBLE) AS age_seconds,
                   TIMESTAMP '2024-01-31 00:00:00' - last_seen > INTERVAL 86400 SECOND AS stale
            FROM seen""",
        "absence_sessions": f"{_sessions(43_200)} SELECT * FROM sessions",
        "stream_gold": f"WITH {PASSING} SELECT {GOLD_COLUMNS} FROM gold",
        "stream_alert_error_rate": f"""SELECT window_start, window_end, errors,
            round(rate_per_second, 7) AS rate_per_second, alert
            FROM ({ERROR_RATE})
            WHERE window_end <= {_watermark("event_type = 'error'")}""",
        "stream_alert_threshold": f"""SELECT * FROM ({_buckets(3600, key='event_type,')})
            WHERE events > 2 AND window_end <= {_watermark()}""",
        "stream_alert_absence": f"""{_sessions(86_400)} SELECT * FROM sessions
            WHERE session_end <= {_watermark()}""",
    }
