"""A training corpus from raw documents, in five stages.

Every stage takes (spark, docs, sf_dir), calls one operator with production parameters and returns
its result; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimloom.llm import bpe, line_rules, mixing, queries, secret_scan, simhash
from claimloom.llm.shared import importable, saved


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that are common at their source."""
    importable(spark)
    return secret_scan.with_length(line_rules.apply_line_rules(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group."""
    importable(spark)
    return simhash.keep_one_of_each(docs, shingle=3, radius=2)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by their kind."""
    importable(spark)
    return secret_scan.with_length(secret_scan.mask_secrets(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once at least, those of small sources up to twice."""
    return mixing.mix_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids`` with counts and digests."""
    importable(spark)
    return bpe.encode_texts(docs, queries.RANK_FILE, queries.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("secret scans", secrets),
    ("mixing", mixture),
    ("byte-level BPE", token_ids),
]

#: Fingerprints, permutation keys and token ids are beyond SQL; tests hold a brute-force twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
