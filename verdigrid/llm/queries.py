"""Registered queries of the numbered operators over the given tables, and their DuckDB texts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from verdigrid.llm import (alignment, bpe, licences, main_text, packing, periodic_runs, rules, secret_scan, sharding, shingle_join, token_files,
                           vector_links, voting)
from verdigrid.llm.common import FOLDS, read_table

#: Bytes of text that a shard holds at most.
SHARD_BYTES = 1 << 20


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _texts(spark, sf_dir)
    model = voting.fit_neighbours(docs, read_table(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(True))
    return voting.score_quality(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links.link_vectors(read_table(spark, sf_dir, "embeddings"))


def op3_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(_texts(spark, sf_dir)).drop("text")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.near_documents(_texts(spark, sf_dir))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract_pages(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(_texts(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(_texts(spark, sf_dir), ranks, public_tokenizers.PATTERN, digests=True)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    return sharding.extendible_shards(sizes, "doc_id", F.col("n_bytes"), SHARD_BYTES)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _texts(spark, sf_dir)
    forest = rules.fit_rules(docs, read_table(spark, sf_dir, "labels"))
    return rules.quality_rules(docs, forest).select("doc_id", *rules.COUNTS, "base_failed", "kept")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _texts(spark, sf_dir)
    return secret_scan.scan_secrets(docs, secret_scan.fit_secrets(docs)).drop("text")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.with_planted_runs(_texts(spark, sf_dir))))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(_texts(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.reread(_texts(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return files.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {f.__name__: f for f in (op1_quality_classifier, op2_embedding_near_dedup, op3_licence_scan, op4_ngram_jaccard_join, op5_html_extraction,
                                   op6_packing, op7_byte_bpe, op8_sharding, op9_quality_rules, op10_secret_scan, op11_periodic_runs,
                                   op12_tokenizer_alignment, op13_token_files)}

ORACLES = {
    "op3_licence_scan": licences.licences_sql(),
    "op8_sharding": f"""
WITH d AS (SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
levels AS (SELECT CAST(range AS INTEGER) AS depth FROM range(0, {sharding.HASH_BITS + 1})),
places AS (SELECT doc_id, n_bytes, depth, h >> ({sharding.HASH_BITS} - depth) AS prefix FROM d CROSS JOIN levels),
sums AS (SELECT *, sum(n_bytes) OVER (PARTITION BY depth, prefix) AS total FROM places),
first AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS nth FROM sums WHERE total <= {SHARD_BYTES} OR depth = {sharding.HASH_BITS})
SELECT doc_id, n_bytes, depth AS shard_depth, prefix AS shard_prefix, CAST(0 AS BIGINT) AS shard_page, CAST(total AS BIGINT) AS shard_bytes
FROM first WHERE nth = 1""",
}
