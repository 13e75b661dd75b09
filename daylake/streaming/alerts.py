"""Alert rules on an event stream.

The tumbling rules are the batch operators over a watermarked stream: a window is
emitted once the watermark passes its end, and state is kept per open window only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from daylake.operators.alerts import count_above, error_rate


def with_event_time(events: DataFrame, delay: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """The stream with a watermark on ``ts`` (as an instant, which watermarks need)."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def stream_error_rate(
    events: DataFrame, is_error: Column, seconds: int = 300, delay: str = "10 minutes"
) -> DataFrame:
    return error_rate(with_event_time(events, delay), is_error, seconds)


def stream_count_above(
    events: DataFrame,
    threshold: int = 5,
    seconds: int = 60,
    key: Sequence[str] = (),
    delay: str = "10 minutes",
) -> DataFrame:
    return count_above(with_event_time(events, delay), threshold, seconds, key)


def stream_absence(
    events: DataFrame,
    key: Sequence[str],
    seconds: int = 86_400,
    delay: str = "10 minutes",
) -> DataFrame:
    """One row per key when no event came for ``seconds``: the session that closed.

    ``<key>, session_start, session_end, events``; ``session_end`` is the instant
    at which the silence reached the limit.  With the library's session settings a
    key's sessions are merged in each task before the shuffle, so that a key with a large
    part of the events sends few rows.  Keys that are silent still are not seen here: see
    :mod:`daylake.streaming.silence`.
    """
    session = F.session_window("ts", f"{int(seconds)} seconds").alias("_s")
    return (
        with_event_time(events, delay)
        .groupBy(*key, session)
        .agg(F.count(F.lit(1)).alias("events"))
        .select(
            *key,
            F.col("_s.start").alias("session_start"),
            F.col("_s.end").alias("session_end"),
            "events",
        )
    )
