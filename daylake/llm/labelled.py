"""Bounded samples of labelled documents, for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from daylake.llm.common import held_out
from daylake.session import stage


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    *,
    rows: int,
    modulus: int,
    remainder: int,
    rows_per_id: int = 4,
) -> DataFrame:
    """doc_id, text and ``y`` of about ``rows`` labelled documents, none held out.

    Where an id stands for many rows, the ``rows_per_id`` with the least hashes of their
    text are taken, so the sample never has more than ``rows * rows_per_id`` rows; each
    task sends no more than that of an id.

    Labels with a null id or value are skipped, and of several labels of one id the
    least counts.  Where there are more than ``rows`` labels, those with the least
    hashes of the id are taken (a few per cent more or fewer).  The sample of ids is
    small by that parameter, so it is sent to the documents; only texts of the sample are
    shuffled.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .where(~held_out(modulus, remainder))
        .groupBy(F.col("doc_id").cast("long").alias("_id"))
        .agg(F.min(label).cast("int").alias("y"))
    )
    known = stage(known, "labels")
    total = known.count()
    if total > rows:
        # The hash is uniform over 64 bits; this much of its range holds ``rows`` ids.
        known = known.where(F.xxhash64("_id") < int(-(2**63) + 2**64 * (rows / total)))
    ids = F.broadcast(known)
    found = docs.select("doc_id", "text", F.xxhash64("text").alias("_h")).join(ids, F.col("doc_id") == F.col("_id"))
    of_id = Window.partitionBy("_id").orderBy("_h")
    return found.withColumn("_n", F.row_number().over(of_id)).where(F.col("_n") <= rows_per_id).select(
        "doc_id", "text", "y"
    )
