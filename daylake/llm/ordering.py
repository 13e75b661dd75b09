"""Positions of rows in the order of a key, and groups of bounded size, without a
task that sees all rows of a key."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from daylake.session import stage


def _runs(key: str):
    """Adds to sorted rows of a task: ``_at`` (row of the task), ``pos`` (row of its run
    of one key) and ``_head`` (whether the run is the task's first)."""

    def number(batches):
        before, at, inside, head = None, 0, 0, True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(batch.schema.get_field_index(key))
            codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy()
            new = np.empty(n, bool)
            new[1:] = codes[1:] != codes[:-1]
            first = keys[0].as_py()
            new[0] = at > 0 and first != before
            starts = np.flatnonzero(new)
            rows = np.arange(n, dtype=np.int64)
            begun = np.searchsorted(starts, rows, side="right")
            pos = np.where(begun > 0, rows - np.append(starts, 0)[begun - 1], inside + rows)
            heads = (begun == 0) & head
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(at + rows), pa.array(pos), pa.array(heads)],
                names=[*batch.schema.names, "_at", "pos", "_head"],
            )
            head = head and not len(starts)
            before, at, inside = keys[n - 1].as_py(), at + n, int(pos[-1]) + 1

    return number


def numbered(rows: DataFrame, key: str, order: Sequence[str], label: str) -> DataFrame:
    """``rows`` with ``pos``: 0, 1, ... within ``key``, ascending by ``order`` (nulls first).

    Rows are dealt by ranges of key and order, sorted and numbered in each task, and
    written; a run that began in an earlier task continues its count.  What the driver
    holds is one row a task.  ``order`` should tell rows apart, or a group of equal rows
    goes to one task; rows equal in key and order are numbered in any order, once.
    """
    dealt = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    schema = StructType([*rows.schema.fields]).add("_at", "long").add("pos", "long").add("_head", "boolean")
    counted = dealt.mapInArrow(_runs(key), schema).withColumn("_task", F.spark_partition_id())
    stored = stage(counted, label)
    ends = (
        stored.groupBy("_task")
        .agg(
            F.count("*").alias("n"),
            F.count_if("_head").alias("n_head"),
            F.min_by(key, "_at").alias("first"),
            F.max_by(key, "_at").alias("last"),
            (F.max_by("pos", "_at") + 1).alias("n_last"),
        )
        .orderBy("_task")
        .collect()
    )
    started: dict[int, int] = {}
    carried, last, seen = 0, None, False
    for e in ends:
        start = carried if seen and e["first"] == last else 0
        if start:
            started[e["_task"]] = start
        carried = e["n_last"] + (start if e["n_head"] == e["n"] else 0)
        last, seen = e["last"], True
    offsets = rows.sparkSession.createDataFrame(list(started.items()), "_task int, _start long")
    # One row a task at most.
    joined = stored.join(F.broadcast(offsets), "_task", "left")
    start = F.when(F.col("_head"), F.coalesce("_start", F.lit(0))).otherwise(0)
    return joined.withColumn("pos", F.col("pos") + start).select(*rows.columns, "pos")


def unit_of(total: int, rows_per_unit: int, *key: str | Column) -> Column:
    """A group number by hash: about ``rows_per_unit`` rows of whole ``key`` values a
    group."""
    return F.pmod(F.xxhash64(*key), F.lit(max(1, -(-total // rows_per_unit)))).cast("long")
