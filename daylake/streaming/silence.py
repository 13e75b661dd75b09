"""Keys that are silent now, from a stream.

A session window reports a silence only when it has ended.  Here every micro-batch adds
each key's last event time to a stored table, in a folder of its own; the greatest of
them is a key's last sign of life, whatever order events arrive in and however often a
batch runs.  No state is kept in the stream, and the question "who is silent at this
instant" reads that small table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType

from daylake.operators.alerts import stale_keys
from daylake.sinks.tables import drop_day_folders


def _schema(events: DataFrame, key: Sequence[str], ts: str) -> StructType:
    return StructType([events.schema[c] for c in key]).add("last_seen", events.schema[ts].dataType)


def start_last_seen(
    events: DataFrame,
    key: Sequence[str],
    path: str,
    checkpoint: str,
    *,
    ts: str = "ts",
    trigger: dict | None = None,
    on_update: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """Keep the last event time of every key below ``path``.

    A batch is combined in each task before its shuffle, and replaces its own folder when
    it runs again.  ``on_update`` is called with the table after every batch, for instance
    to raise alerts by the clock.
    """
    schema = _schema(events, key, ts)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        seen = batch.groupBy(*key).agg(F.max(ts).alias("last_seen"))
        seen.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if on_update:
            on_update(last_seen(batch.sparkSession, path, schema))

    return (
        events.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def last_seen(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The stored rows: a key may occur once a batch; the greatest time counts."""
    stored = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.read.schema(StructType([*stored.fields]).add("batch", LongType())).parquet(path)


def open_silences(
    seen: DataFrame, key: Sequence[str], as_of: datetime, seconds: int = 86_400
) -> DataFrame:
    """Every key with its last event and whether it has been silent for longer than the
    limit at ``as_of``; equal to :func:`stale_keys` over all events so far."""
    return stale_keys(seen, key, as_of, seconds, ts="last_seen")


def compact_last_seen(spark: SparkSession, path: str, schema: StructType | str, key: Sequence[str]) -> None:
    """Merge the folders of all batches so far into one.

    The merged folder is written first and old ones go after it; as the greatest time
    counts, a run that stops in between changes no answer.
    """
    rows = last_seen(spark, path, schema)
    done = [r[0] for r in rows.select("batch").distinct().collect()]
    if len(done) < 2:
        return
    # Batches count from 0 up, merged folders from -1 down: no name is used twice.
    name = min(-1, min(done) - 1)
    merged = rows.groupBy(*key).agg(F.max("last_seen").alias("last_seen"))
    merged.write.mode("overwrite").parquet(f"{path}/batch={name}")
    drop_day_folders(spark.createDataFrame([(b,) for b in done], "batch long"), path, "batch")
