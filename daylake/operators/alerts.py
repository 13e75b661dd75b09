"""Windowed alert rules over an event table or stream.

The tumbling rules (error rate, counts) work unchanged on a streaming DataFrame
once it carries a watermark.  The batch absence rules first combine events into
time buckets as wide as the allowed gap; two events in one bucket are closer than
the gap, so gaps and sessions depend only on each bucket's first and last event.
The per-key window then runs over buckets, whose number is bounded by the time
span, and a key with a large part of all events is combined before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

# Log severities in rising order (fixed values).
SEVERITIES = (
    "DEFAULT",
    "DEBUG",
    "INFO",
    "NOTICE",
    "WARNING",
    "ERROR",
    "CRITICAL",
    "ALERT",
    "EMERGENCY",
)


def severity_at_least(column: str, level: str) -> Column:
    """Whether a severity name ranks at or above ``level``; unknown names do not."""
    return F.col(column).isin(*SEVERITIES[SEVERITIES.index(level) :])


def _seconds(interval: Column) -> Column:
    return interval.cast("interval second").cast("decimal(20,6)").cast("double")


def _span(seconds: int) -> str:
    return f"{int(seconds)} seconds"


def tumbling_counts(
    events: DataFrame, seconds: int, key: Sequence[str] = (), ts: str = "ts"
) -> DataFrame:
    """``window_start, window_end, <key>, events`` for every non-empty window."""
    windowed = events.groupBy(F.window(ts, _span(seconds)).alias("_w"), *key)
    return windowed.agg(F.count(F.lit(1)).alias("events")).select(
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        *key,
        "events",
    )


def error_rate(
    events: DataFrame, is_error: Column, seconds: int = 300, ts: str = "ts", at_least: int = 1
) -> DataFrame:
    """Errors per second over all sources in aligned windows; ``alert`` when a window
    holds ``at_least`` errors."""
    counted = tumbling_counts(events.where(is_error), seconds, ts=ts)
    return counted.select(
        "window_start",
        "window_end",
        F.col("events").alias("errors"),
        (F.col("events") / F.lit(float(seconds))).alias("rate_per_second"),
        (F.col("events") >= at_least).alias("alert"),
    )


def count_above(
    events: DataFrame,
    threshold: int = 5,
    seconds: int = 60,
    key: Sequence[str] = (),
    ts: str = "ts",
) -> DataFrame:
    """Windows (per key, or over everything) with more than ``threshold`` events."""
    return tumbling_counts(events, seconds, key, ts).where(F.col("events") > threshold)


def stale_keys(
    events: DataFrame,
    key: Sequence[str],
    as_of: datetime | Column,
    seconds: int = 86_400,
    ts: str = "ts",
) -> DataFrame:
    """Last event of each key and whether it is older than the limit at ``as_of``.

    An ``as_of`` without a zone is read on the same clock as ``ts``.
    """
    kind = events.schema[ts].dataType
    if isinstance(as_of, datetime) and as_of.tzinfo is None:
        as_of = as_of.isoformat(sep=" ")
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    age = _seconds(now.cast(kind) - F.col("last_seen"))
    return (
        events.groupBy(*key)
        .agg(F.max(ts).alias("last_seen"))
        .select(*key, "last_seen", age.alias("age_seconds"), (age > seconds).alias("stale"))
    )


def activity_buckets(
    events: DataFrame, key: Sequence[str], seconds: int, ts: str = "ts"
) -> DataFrame:
    """First event, last event and number of events per key and time bucket."""
    return (
        events.groupBy(*key, F.window(ts, _span(seconds)).getField("start").alias("bucket"))
        .agg(
            F.min(ts).alias("first_seen"),
            F.max(ts).alias("last_seen"),
            F.count(F.lit(1)).alias("events"),
        )
    )


def _with_pause(buckets: DataFrame, key: Sequence[str]) -> DataFrame:
    in_time = Window.partitionBy(*key).orderBy("bucket")
    before = F.lag("last_seen").over(in_time)
    return buckets.withColumn("_before", before).withColumn(
        "_pause", _seconds(F.col("first_seen") - F.col("_before"))
    )


def gaps(
    events: DataFrame, key: Sequence[str], seconds: int = 86_400, ts: str = "ts"
) -> DataFrame:
    """Silences longer than the limit: ``<key>, last_seen, next_seen, gap_seconds``."""
    pauses = _with_pause(activity_buckets(events, key, seconds, ts), key)
    return pauses.where(F.col("_pause") > seconds).select(
        *key,
        F.col("_before").alias("last_seen"),
        F.col("first_seen").alias("next_seen"),
        F.col("_pause").alias("gap_seconds"),
    )


def activity_sessions(
    events: DataFrame, key: Sequence[str], seconds: int = 86_400, ts: str = "ts"
) -> DataFrame:
    """Runs of events with no silence longer than the limit.

    ``<key>, session_start, session_end, events``; the end is the last event plus
    the limit, that is when the silence is noticed.  Same result as a session
    window over the raw events.
    """
    pauses = _with_pause(activity_buckets(events, key, seconds, ts), key)
    in_time = Window.partitionBy(*key).orderBy("bucket")
    begins = F.coalesce(F.col("_pause") > seconds, F.lit(True)).cast("int")
    numbered = pauses.withColumn(
        "_session", F.sum(begins).over(in_time.rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        numbered.groupBy(*key, "_session")
        .agg(
            F.min("first_seen").alias("session_start"),
            F.max("last_seen").alias("_last"),
            F.sum("events").alias("events"),
        )
        .select(
            *key,
            "session_start",
            (F.col("_last") + F.make_dt_interval(secs=F.lit(float(seconds)))).alias("session_end"),
            "events",
        )
    )
