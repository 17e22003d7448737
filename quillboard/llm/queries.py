"""The registered queries of this subpackage: one operator, one whole table each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillboard.llm import bpe, divergence, embedding, jaccard, license, media, mixing, oracles, periodic, quality, sharding, suffixdedup, tokenfile, unigram
from quillboard.llm._scratch import Scratch

END_ID = 2


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digest(_read(spark, sf_dir, "documents"))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.shingle_join(_read(spark, sf_dir, "documents"), Scratch(spark, "op2"))


def op3_suffixdedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.remove_repeats(_read(spark, sf_dir, "documents"), Scratch(spark, "op3"))


def op4_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.near_vectors(_read(spark, sf_dir, "embeddings"), Scratch(spark, "op4"))


def op5_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op5")
    manifest = tokenfile.write_token_files(_read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), f"{scratch.path}/ids", END_ID, scratch)
    return tokenfile.read_token_files(manifest)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), Scratch(spark, "op6"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_read(spark, sf_dir, "documents"))


def op8_unigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.count_tokens(_read(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op9_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.license_scan(_read(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digest(_read(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digest(periodic.looped(_read(spark, sf_dir, "documents")))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(_read(spark, sf_dir, "documents"), Scratch(spark, "op12"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_read(spark, sf_dir, "documents"), Scratch(spark, "op13"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_media, op2_jaccard, op3_suffixdedup, op4_embedding, op5_tokenfile, op6_quality, op7_mixing, op8_unigram, op9_license, op10_bpe, op11_periodic, op12_divergence, op13_sharding)
}
ORACLES: dict[str, str] = oracles.ORACLES
