"""Events that arrive too late for their window, kept instead of dropped.

A streaming aggregate drops rows whose window the watermark has passed, without a trace.
Here each micro-batch is split by the watermark that the batches before it left behind:
on-time rows go on to the rules, late ones are stored beside them.  Both are written to
the batch's own folder, so a batch that runs again replaces what it wrote, and the
watermark of a batch depends on earlier batches only.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def _watermark(spark: SparkSession, path: str, batch_id: int, kind: str, delay: timedelta):
    """The greatest event time of earlier batches, less the delay; None before them."""
    progress = spark.read.schema(f"greatest {kind}, batch long").parquet(f"{path}/progress")
    closed = F.max("greatest") - F.make_dt_interval(secs=F.lit(delay.total_seconds()))
    # As text, so that no clock but the session's is used.
    return progress.where(F.col("batch") < batch_id).agg(closed.cast("string")).first()[0]


def start_late_split(
    events: DataFrame,
    path: str,
    checkpoint: str,
    *,
    seconds: int = 300,
    delay: timedelta = timedelta(minutes=10),
    ts: str = "ts",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Store the stream's rows below ``path`` with a column ``late``: whether the window of
    ``seconds`` that holds a row had closed before its batch began.

    Every row is stored once, late or not; a row without a time is on time.  What the
    driver holds is one instant.
    """
    kind = events.schema[ts].dataType.simpleString()

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        closed = None
        if batch_id > 0:
            closed = _watermark(spark, path, batch_id, kind, delay)
        end = F.window(ts, f"{int(seconds)} seconds").getField("end")
        late = F.lit(False) if closed is None else F.coalesce(end <= F.lit(closed).cast(kind), F.lit(False))
        # window() drops rows without a time, so they are kept apart from it.
        timed = batch.where(F.col(ts).isNotNull()).withColumn("late", late)
        rows = timed.unionByName(batch.where(F.col(ts).isNull()).withColumn("late", F.lit(False)))
        folder = f"{path}/events/batch={batch_id}"
        rows.write.mode("overwrite").parquet(folder)
        stored = spark.read.schema(rows.schema).parquet(folder)
        stored.agg(F.max(ts).alias("greatest")).write.mode("overwrite").parquet(
            f"{path}/progress/batch={batch_id}"
        )

    return (
        events.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def split_events(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All stored rows with ``late`` and ``batch``."""
    stored = StructType([*schema.fields]).add("late", "boolean").add("batch", "long")
    return spark.read.schema(stored).parquet(f"{path}/events")
