"""Registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import (
    alignment,
    bpe,
    chat,
    html_text,
    line_rules,
    mixing,
    prefix_trie,
    projections,
    quality_model,
    secret_scan,
    sharding,
    simhash,
    warc,
)
from claimloom.llm.shared import importable

RANK_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")
# A conversation of control strings, beside those of the table.
CONTROL_CHAT = "</s>[INST] ok [/INST]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", "fingerprint", "component_id")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_order(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=40)


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "quality")
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.line_rules(table(spark, sf_dir, "documents")).drop("host", "text_key", "removed")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(table(spark, sf_dir, "documents"), RANK_FILE, PATTERN).drop("ids")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_CHAT).alias("text"),
    )
    return chat.chat_digests(chat.format_chats(turns.unionByName(extra)))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages")).drop("url")


def op10_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_texts(table(spark, sf_dir, "documents"), BYTE_FILE, PIECE_FILE)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash, op2_mixing, op3_sharding, op4_quality_model, op5_secret_scan, op6_line_rules,
        op7_bpe, op8_chat, op9_warc, op10_projections, op11_alignment, op12_prefix_trie,
        op13_html_text, pipeline,
    )
}
