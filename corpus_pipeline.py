"""The corpus pipeline: five stages over documents, each one of the llm operators.

language     rejects documents without a language that the evidence supports (7)
dedup        keeps one document of each group of near duplicates (4)
decontaminate  drops documents that hold benchmark items (2)
mix          replicates documents so that all sources have equal shares (9)
tokens       writes token files in the order of the mix and reads them back (6): doc_id, start, n_tokens, ids_crc32

Every stage but the last returns the columns it was given. Null, empty and repeated rows have
the results that the operators' docstrings define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wellscore.llm import op2_decontaminate, op4_minhash, op6_tokens, op7_language, op9_mix
from wellscore.llm.common import fresh, table
from wellscore.llm.queries import vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op7_language.identified_documents(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op4_minhash.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op2_decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op9_mix.replicate(docs).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op6_tokens.encoded(docs, vocabulary(), literal=False, stored_order=True)


STAGES = [("language", language), ("dedup", dedup), ("decontaminate", decontaminate), ("mix", mix), ("tokens", tokens)]

#: Some stages (hash families, tokenizer) can't be expressed in SQL; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
