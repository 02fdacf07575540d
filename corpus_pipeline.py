"""The corpus pipeline: quality, near duplicates, repeated passages, source mix, tokens.

Each stage is written as Parquet and read again as the documents of the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demandloom.llm import bpe, minhash, mixing, quality, queries, substrings
from demandloom.llm.scratch import Scratch


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. Rows with a NULL id can't be judged by id and stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality.classify(docs, labels)
    # an id is rejected with the worst of its rows
    rejected = judged.filter("doc_id IS NOT NULL AND predicted = 0").select("doc_id").distinct()
    return docs.join(rejected, "doc_id", "left_anti").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Rows that repeat an id stay or go together, so copies under one id stay; so do rows with a NULL id. NULL
    and empty texts are in no group.
    """
    dropped = minhash.near_duplicates(docs).filter("NOT kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that repeat a passage of an earlier one.

    A text that loses nothing stays as it is, with its own white space; one that loses words is
    its kept words with single spaces, which may be none. ``n_chars`` follows the text.
    """
    return substrings.strip_repeats(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of the mix.

    Texts without words, NULL ones too, are not taken. Rows with a NULL id are rows like others.
    """
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each document; a NULL text has those of an empty one."""
    return bpe.token_digests(docs, queries.public_tokenizer())


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("substring dedup", substring_stage),
    ("source mixing", mixing_stage),
    ("byte-level BPE", token_stage),
]

#: The classifier's decisions can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.keep(f"stage-{i}", stage(spark, docs, sf_dir))
        if i:
            scratch.drop(f"stage-{i - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
