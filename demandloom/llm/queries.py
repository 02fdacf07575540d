"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm import ann, ball_codes, bpe, imatch, language_id, minhash, mixing, phrases, quality, sharding, substrings, toxicity, url_filter

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, folder, "pages"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def public_tokenizer() -> bpe.Tokenizer:
    """The multilingual byte-level vocabulary; its path is a parameter of the operator only."""
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.Tokenizer(ranks, public_tokenizers.PATTERN)


def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.token_digests(_table(spark, folder, "documents"), public_tokenizer())


def op5_learned_partition_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return ann.search(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


def op6_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents"))


def op7_imatch_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return imatch.compare_with_edits(_table(spark, folder, "documents"))


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.without_repeats(_table(spark, folder, "documents"))


def op9_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op10_histogram_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, folder, "documents"))


def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.mine_phrases(_table(spark, folder, "documents"))


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return ball_codes.vector_codes(_table(spark, folder, "embeddings"))


def op13_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(_table(spark, folder, "documents"))


def registered() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
