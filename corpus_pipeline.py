"""From raw documents to packed training sequences: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from verdigrid.llm import packing, rules, secret_scan, shingle_join, voting
from verdigrid.llm.common import read_table, written

#: What stands in a text for a secret.
MASK = "[SECRET]"


def _judged(docs: DataFrame, names: list[str], judge: Callable[[DataFrame], DataFrame], keep: str) -> DataFrame:
    """The rows of ``docs`` that pass ``keep``, with their own columns, also where these bear an operator's names."""
    aside = {c: f"_own_{c}" for c in docs.columns if c in names}
    return judge(docs.withColumnsRenamed(aside)).filter(keep).drop(*names).withColumnsRenamed({v: k for k, v in aside.items()}).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rule or the trees; the trees are fitted on the labelled source documents."""
    forest = rules.fit_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return _judged(docs, [*rules.COUNTS, "base_failed", "tree_score", "kept"], lambda d: rules.quality_rules(d, forest), "kept")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the labelled neighbours vote out; these are source documents, good and bad."""
    model = voting.fit_neighbours(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return _judged(docs, ["score", "predicted"], lambda d: voting.score_quality(d, model), "predicted = 1")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that with the smallest id, and of rows that repeat it the least.

    Rows with a null id link with nothing and stay.
    """
    found = shingle_join.near_documents(docs)
    kept = (found.groupBy("doc_id").agg(F.min("component_id").alias("_component"), F.count(F.lit(1)).alias("_rows"))
            .filter(F.col("doc_id") == F.col("_component")).select("doc_id", "_rows"))
    joined = docs.join(kept, "doc_id")
    once = joined.filter(F.col("_rows") == 1).select(*docs.columns)
    again = (joined.filter(F.col("_rows") > 1).groupBy("doc_id").agg(F.min(F.struct("text", *[c for c in docs.columns if c not in ("doc_id", "text")])).alias("_row"))
             .select("doc_id", "_row.*").select(*docs.columns))
    return once.unionByName(again).unionByName(docs.filter(F.col("doc_id").isNull()))


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by ``MASK``; ``n_chars`` follows the text. No document goes."""
    out = secret_scan.scan_secrets(docs, secret_scan.fit_secrets(docs), masked=MASK)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(kind))
    return out.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of at most 1024 tokens; a row for each piece, with its ids."""
    pieces = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("quality_rules", quality_rules), ("quality_classifier", quality_classifier), ("near_duplicates", near_duplicates),
          ("secret_masking", secret_masking), ("packing", pack)]

#: Trees, votes and tokens cannot be told in SQL; the tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
