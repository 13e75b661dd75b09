"""A training corpus from raw documents: identify the language, drop near copies, drop
contaminated documents, redact secrets, pack what is left into sequences.

Every stage gets all documents that the one before kept, as a stored table.  All but
the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daylake.llm.common import held_out, read_table, ship_package
from daylake.llm.contamination import drop_contaminated
from daylake.llm.language import fit_language_model, keep_identified
from daylake.llm.queries import packed_pieces
from daylake.llm.secrets import redact_secrets
from daylake.llm.simhash import drop_near_duplicates
from daylake.session import working_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the language that the model finds as their ``lang``; texts that are
    null or have no letter go, no others, also if no document has a label."""
    ship_package(spark)
    return keep_identified(docs, fit_language_model(docs.where(~held_out(5, 0))))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship_package(spark)
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    ship_package(spark)
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets redacted."""
    ship_package(spark)
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in sequences of 2048 ids."""
    ship_package(spark)
    return packed_pieces(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: Tokenizers, fingerprints and fitted models have no SQL form; the stages are tested
#: against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = working_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
