"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from daylake.llm.common import held_out, read_table, ship_package
from daylake.llm.context_tree import score_texts
from daylake.llm.contamination import contamination, contamination_report
from daylake.llm.conversations import repair_conversations
from daylake.llm.embeddings import near_vectors
from daylake.llm.language import fit_language_model, identify_language
from daylake.llm.merkle import merkle_manifest
from daylake.llm.oracle_sql import MERKLE, REPAIR
from daylake.llm.packing import assign_sequences, tokenized_pieces
from daylake.llm.quality import fit_quality_model, score_quality
from daylake.llm.secrets import base_spans, scan_secrets, span_text
from daylake.llm.sharding import shard_documents
from daylake.llm.simhash import near_duplicates
from daylake.llm.token_files import read_token_ids, with_crc32, write_token_ids
from daylake.llm.toxicity import fit_toxicity_model, score_toxicity
from daylake.session import stage, working_dir

CAPACITY = 2048


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(_documents(spark, sf_dir))


def packed_pieces(docs: DataFrame) -> DataFrame:
    """Digest rows of all documents' pieces and their places."""
    pieces = tokenized_pieces(docs, CAPACITY, end_id=0)
    light = pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "part", "nth"
    )
    return assign_sequences(stage(light, "pieces"), CAPACITY)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    model = fit_language_model(docs.where(~held_out(5, 0)))
    named = identify_language(docs.select("doc_id", "text"), model)
    return named.select(
        "doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score"
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
    return contamination_report(found).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = fit_quality_model(docs, read_table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select(
        "doc_id",
        held_out(4, 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = fit_toxicity_model(docs, read_table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select(
        "doc_id",
        held_out(5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_documents(spark, sf_dir))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    path = working_dir(spark, "token-files")
    write_token_ids(docs, path, end_id=2)
    return with_crc32(read_token_ids(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(_documents(spark, sf_dir), 24)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return near_vectors(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(_documents(spark, sf_dir))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(span_text(base_spans()), 256).alias("base_sha256"),
        span_text("spans").alias("spans"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return merkle_manifest(read_table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return repair_conversations(read_table(spark, sf_dir, "conversations"))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_language_id": op2_language_id,
    "op3_decontamination": op3_decontamination,
    "op4_quality": op4_quality,
    "op5_toxicity": op5_toxicity,
    "op6_simhash": op6_simhash,
    "op7_token_files": op7_token_files,
    "op8_sharding": op8_sharding,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_secrets": op10_secrets,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_lm_scoring": op13_lm_scoring,
    "pipeline": pipeline,
}

#: SQL equivalents, where SQL can express the operator.
ORACLES: dict[str, str] = {
    "op11_merkle_manifest": MERKLE,
    "op12_conversation_repair": REPAIR,
    "op3_decontamination": r"""
WITH doc AS (
    SELECT row_number() OVER () AS row, doc_id,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), item AS (
    SELECT item_id,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), sized AS (
    SELECT item_id, words, least(13, len(words)) AS n FROM item WHERE len(words) > 0
), item_start AS (
    SELECT item_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM sized
), test_window AS (
    SELECT DISTINCT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS phrase FROM item_start
), size AS (
    SELECT DISTINCT n FROM test_window
), doc_start AS (
    SELECT row, words, n, unnest(range(1, len(words) - n + 2)) AS i
    FROM doc JOIN size ON len(words) >= n
), doc_window AS (
    SELECT row, n, i, array_to_string(words[i:i + n - 1], ' ') AS phrase FROM doc_start
), found AS (
    SELECT row, item_id, i, n FROM doc_window JOIN test_window USING (n, phrase)
), hit AS (
    SELECT row, count(DISTINCT p) AS n_hit
    FROM (SELECT row, unnest(range(i, i + n)) AS p FROM found) GROUP BY row
), hit_item AS (
    SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL)
    GROUP BY row
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM doc LEFT JOIN hit USING (row) LEFT JOIN hit_item USING (row)
""",
}
