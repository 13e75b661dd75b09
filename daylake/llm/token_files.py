"""Token ids in ORC files, in ascending document order.

ORC keeps the ids as integer runs, and for every ``row_stride`` documents an index
entry with the least and greatest id of a document and a Bloom filter.  A reader
skips files, stripes and row groups by that, and stripes are read in parallel.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from daylake.llm.common import text_blocks
from daylake.llm.tokens import ENCODE_BYTES, loaded

SCHEMA = "doc_id long, part int, before long, n_tokens long, ids array<int>"


def write_token_ids(
    docs: DataFrame,
    path: str,
    *,
    tokenizer: str | None = None,
    end_id: int = 2,
    row_stride: int = 1000,
    stripe_bytes: int = 64 << 20,
) -> None:
    """Encode every text (null: empty), append ``end_id`` and write one file a task.

    Texts are dealt by ranges of doc_id (null ids first; rows of one id are split by
    their texts' hash), sorted, and then encoded, so that ids are never shuffled.
    Each row keeps its task's number, which ascends with doc_id, and the number of ids
    before it in the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(tokenizer)
        part, before = TaskContext.get().partitionId(), 0
        for rows, texts in text_blocks(batches, "text", ENCODE_BYTES):
            ids, counts = encoder.encode(texts)
            ids = np.insert(ids, np.cumsum(counts), end_id)
            counts = counts + 1
            ends = np.cumsum(counts)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.astype(np.int32))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0).cast(pa.int64()),
                    pa.array(np.full(len(counts), part, np.int32)),
                    pa.array(before + ends - counts),
                    pa.array(counts),
                    lists,
                ],
                names=["doc_id", "part", "before", "n_tokens", "ids"],
            )
            before += int(ends[-1]) if len(ends) else 0

    # Among rows of one id, the text's hash decides; equal rows are interchangeable.
    dealt = docs.select("doc_id", "text").repartitionByRange("doc_id", F.xxhash64("text"))
    ordered = dealt.sortWithinPartitions("doc_id", F.xxhash64("text"))
    (
        ordered.mapInArrow(run, SCHEMA)
        .write.mode("error")
        .option("compression", "zstd")
        .option("orc.stripe.size", str(stripe_bytes))
        .option("orc.row.index.stride", str(row_stride))
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """All documents of the files: doc_id, start, n_tokens, ids.

    ``start`` counts the ids of all documents before: the totals of the earlier tasks
    (one row a task, summed in a window over those few rows) plus the stored count.
    """
    rows = spark.read.schema(SCHEMA).orc(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    # One row a written file: as small as the listing of the files.
    return rows.join(F.broadcast(base), "part").select(
        "doc_id", (F.col("_base") + F.col("before")).alias("start"), "n_tokens", "ids"
    )


def read_documents(spark: SparkSession, path: str, doc_ids: Iterable[int]) -> DataFrame:
    """Some documents; file, stripe and Bloom metadata skip the rest of the data."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows.where(F.col("doc_id").isin(*doc_ids)).select("doc_id", "n_tokens", "ids")


def with_crc32(rows: DataFrame) -> DataFrame:
    """``ids`` replaced by ``ids_crc32`` of their little-endian unsigned 32-bit form."""
    kept = [c for c in rows.columns if c != "ids"]
    schema = rows.select(*kept).schema.add("ids_crc32", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            lists = column("ids")
            flat = lists.flatten().to_numpy().astype("<u4", copy=False)
            raw = memoryview(np.ascontiguousarray(flat)).cast("B")
            ends = (np.cumsum(lists.value_lengths().to_numpy()) * 4).tolist()
            sums = [zlib.crc32(raw[a:b]) for a, b in zip([0, *ends], ends)]
            yield pa.RecordBatch.from_arrays(
                [*(column(c) for c in kept), pa.array(sums, pa.int64())], names=[*kept, "ids_crc32"]
            )

    return rows.select(*kept, "ids").mapInArrow(run, schema)
