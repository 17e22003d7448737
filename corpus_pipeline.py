"""A training corpus from documents: five stages, each written and read again.

1. quality: documents that the co-trained classifier rejects go.
2. near duplicates: of each group that shingle links hold together, the smallest doc_id stays.
3. repeats: byte strings of 100 or more that also start earlier are cut out.
4. mix: sources are interleaved to their target weights and rows are written in that order;
   ``WEIGHTS`` may name whole parts of a period for each source, else their natural shares
   hold. No row is dropped.
5. tokens: ids of each text.

All stages take null texts as empty, keep rows that share a doc_id or have none, keep columns
of any name, and give an empty table for an empty one; which of equal texts stays follows the
smallest doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillboard.llm import bpe, jaccard, mixing, quality, suffixdedup
from quillboard.llm._scratch import Scratch
from quillboard.llm.queries import tokenizer

WEIGHTS: dict[str, int] | None = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Accepted documents; all of them where the labels do not hold both classes."""
    return quality.quality_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), Scratch(spark, "quality"), keep=True)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a doc_id or without words stay: they link with nothing."""
    groups = jaccard.shingle_join(docs, Scratch(spark, "near-duplicates"))
    gone = groups.where("component_id != doc_id").select("doc_id").distinct()
    return docs.join(gone, docs["doc_id"] == gone["doc_id"], "left_anti")


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left of each text; rows whose whole text repeats stay with an empty one."""
    return suffixdedup.remove_repeats(docs, Scratch(spark, "repeats"), keep=True)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in the order of the mix; a null source is the source ''."""
    return mixing.mixed_documents(docs, WEIGHTS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests and ids of each row."""
    return bpe.bpe_digest(docs, tokenizer("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each),
    ("suffix-array dedup", without_repeats),
    ("mixing sources to target weights", mixed),
    ("BPE encoding and decoding", tokens),
]

#: Neither the classifier nor the merges can be written as SQL; tests/llm holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.table(f"stage-{k}", stage(spark, docs, sf_dir))
    return docs
