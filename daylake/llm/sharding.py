"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

The unit is a group of equal texts, so that copies share a shard.  Groups are dealt by
hash into batches of bounded size; each batch fills all shards evenly on its own,
largest groups first, every group going where the dot product of its (bytes, tokens,
rows) with the shard's residual capacity is highest.  As each batch is even to within
its smallest groups, so is the whole, and no step sees more than one batch.  A group
too large for that is first cut into parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from daylake.session import stage

#: Weights of bytes, tokens and rows in the dot product.
WEIGHTS = (1.0, 0.3, 0.3)


def word_count(text: str = "text") -> Column:
    """Blank-separated tokens, as a sum of blanks (0 for null and empty)."""
    blanks = F.length(text) - F.length(F.translate(F.col(text), " ", ""))
    return F.when(F.length(text) > 0, blanks + 1).otherwise(0).cast("long")


def place_groups(sizes: np.ndarray, shards: int, first: int = 0) -> np.ndarray:
    """Shard of each group of one batch; ``sizes`` is (groups, 3), largest first.

    Capacities are equal shares of the batch.  Ties go to the shard after ``first``.
    """
    total = sizes.sum(axis=0).astype(float)
    total[total == 0] = 1.0
    share = sizes / total * shards * np.array(WEIGHTS) ** 0.5
    residual = np.tile(np.array(WEIGHTS) ** 0.5, (shards, 1))
    order = (np.arange(shards) + first) % shards
    out = np.empty(len(sizes), np.int64)
    for i, vector in enumerate(share):
        k = int(np.argmax(residual[order] @ vector))
        out[i] = order[k]
        residual[order[k]] -= vector
    return out


def _place(batches: Iterator[pd.DataFrame], shards: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by batch and falling size: the shard of each group."""

    def work(groups: pd.DataFrame) -> pd.DataFrame:
        sizes = groups[["bytes", "tokens", "rows"]].to_numpy(np.float64)
        shard = place_groups(sizes, shards, int(groups["batch"].iloc[0]))
        return groups[["h", "crc", "size", "cut"]].assign(shard=shard.astype(np.int32))

    held = None
    for frame in batches:
        held = frame if held is None else pd.concat([held, frame], ignore_index=True)
        if held.empty:
            continue
        last = held["batch"].iloc[-1]
        ready = held[held["batch"] != last]
        for _, groups in ready.groupby("batch", sort=False):
            yield work(groups)
        held = held[held["batch"] == last].reset_index(drop=True)
    if held is not None and not held.empty:
        yield work(held)


def shard_documents(
    docs: DataFrame,
    shards: int = 24,
    *,
    tokens: Column | None = None,
    groups_per_batch: int = 40_000,
    rows_per_slot_part: int = 200_000,
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot for every row.

    ``size`` is the text's UTF-8 bytes (null: none) plus 8.  Rows with equal texts
    share a shard, unless their group is larger than a sixteenth of a shard's part of
    one batch; then its rows are dealt by doc_id over several parts.  Null texts are a
    group, as are empty ones.  Slots number a shard's rows without gaps from 0, in an
    order that only depends on the rows (rows equal in id and text are alike).  Null
    and repeated ids are rows like any other.
    """
    light = stage(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
            F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("text_crc32"),
            F.crc32(F.col("text").cast("binary")).alias("crc"),
            F.xxhash64("text", F.col("text").isNull()).alias("h"),
            (word_count() if tokens is None else tokens).alias("tokens"),
        ),
        "shard-rows",
    ).withColumn("crc", F.coalesce("crc", F.lit(-1)))
    key = ["h", "crc", "size"]
    groups = light.groupBy(*key).agg(F.count("*").alias("rows"), F.sum("tokens").alias("tokens"))
    groups = stage(groups, "shard-groups")
    totals = groups.agg(
        F.count("*").alias("groups"),
        F.sum(F.col("size") * F.col("rows")).alias("bytes"),
        F.sum("rows").alias("rows"),
    ).first()
    batches = max(1, -(-totals["groups"] // groups_per_batch))
    part_bytes = max(1, (totals["bytes"] or 0) // (batches * shards * 16))
    part_rows = max(1, (totals["rows"] or 0) // (batches * shards * 16))
    cuts = F.least(
        F.col("rows"),
        F.greatest(
            F.ceil(F.col("size") * F.col("rows") / part_bytes), F.ceil(F.col("rows") / part_rows)
        ),
    ).cast("long")
    # Groups over a share of a batch: their number is bounded by batches * shards * 32.
    large = stage(groups.where((cuts > 1) & (F.col("rows") > 1)).select(*key, cuts.alias("cuts")), "large-groups")
    salt = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("cuts"))
    marked = light.join(large, key, "left").withColumn("cut", F.coalesce(salt, F.lit(0)))
    parts = marked.groupBy(*key, "cut").agg(F.count("*").alias("rows"), F.sum("tokens").alias("tokens"))
    dealt = parts.withColumn("bytes", F.col("size") * F.col("rows")).withColumn(
        "batch", F.pmod(F.xxhash64("h", "crc", "cut", F.lit(2)), F.lit(batches)).cast("int")
    )
    ordered = dealt.repartition("batch").sortWithinPartitions(
        "batch", F.desc("bytes"), F.desc("rows"), "h", "crc", "cut"
    )
    placed = stage(
        ordered.mapInPandas(
            lambda frames: _place(frames, shards), "h long, crc long, size long, cut long, shard int"
        ),
        "shard-places",
    )
    rows = marked.join(placed, [*key, "cut"]).select("doc_id", "size", "text_crc32", "h", "shard")
    slot_parts = max(1, -(-(totals["rows"] or 0) // (rows_per_slot_part * shards)))
    return _numbered(rows, slot_parts).select("doc_id", "size", "text_crc32", "shard", "slot")


def _numbered(rows: DataFrame, parts: int) -> DataFrame:
    """Gapless slots: a shard's rows in ``parts`` parts, each numbered on its own, plus
    the rows of the parts before."""
    split = rows.withColumn("_part", F.pmod(F.xxhash64("doc_id", "h", F.lit(3)), F.lit(parts)).cast("int"))
    within = Window.partitionBy("shard", "_part").orderBy("doc_id", "h")
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = split.groupBy("shard", "_part").agg(F.count("*").alias("_n"))
    offsets = counts.select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    nth = split.withColumn("_nth", F.row_number().over(within) - 1)
    return nth.join(offsets, ["shard", "_part"]).withColumn(
        "slot", (F.col("_nth") + F.col("_before")).cast("long")
    )
