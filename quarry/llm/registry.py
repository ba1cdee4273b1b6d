"""The queries of this subpackage, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, embedding_dedup, langid, license_scan, line_dedup, mixing, packing, simhash, topk, toxicity
from .common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the text without later repeated runs, n_lines, n_deleted, deleted_words."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", F.col("_n_lines").alias("n_lines"), F.col("_n_deleted").alias("n_deleted"), F.col("_deleted_words").alias("deleted_words"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted", "n_passages")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link_vectors(table(spark, sf_dir, "embeddings"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat_format.with_probe(table(spark, sf_dir, "conversations"))
    messages = rows.select("conv_id", "turn", "role", chat_format.text_part(F.col("text")).alias("parts"))
    return chat_format.read_back(chat_format.format_conversations(messages).select("conv_id", "formatted", "loss_spans"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_topk_inner_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.train_and_identify(table(spark, sf_dir, "documents"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_toxicity, op3_embedding_dedup, op4_chat_format, op5_license_scan, op6_best_fit_packing,
        op7_topk_inner_product, op8_source_mixing, op9_language_id, op10_simhash_dedup,
    )
}
#: The other queries can't be said in SQL: they learn, tokenise, or hash with functions that DuckDB lacks. tests/llm has them against brute force.
ORACLES = {
    "op1_line_dedup": line_dedup.oracle(),
    "op3_embedding_dedup": embedding_dedup.oracle(),
    "op4_chat_format": chat_format.oracle(),
    "op5_license_scan": license_scan.oracle(),
    "op7_topk_inner_product": topk.oracle(),
    "op8_source_mixing": mixing.oracle(),
}
