"""Contiguous shards of equal size, by global prefix sums of bytes.

Documents are put in order of doc_id by a range shuffle of small rows and written with
their partition's number. The partitions' totals, a row each, give the bytes before each
partition; running sums within partitions give the bytes before each document, and equal
targets cut that line into shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from quillboard.llm._scratch import Scratch

#: Bytes that each document takes besides its text.
HEAD = 16


def cut_shards(documents: DataFrame, scratch: Scratch, shards: int = 40, keep: list[str] | None = None) -> DataFrame:
    """row (the columns to keep), size, text_crc32, before, shard, slot of each document.

    Documents stand in order of doc_id (null first), of their texts' digests where ids are
    the same, equal rows in any order; ``before`` is the size of all that stand before. A document lies in the
    shard of its middle byte on that line, so each cut is at most half a document from its
    target and shards differ by no more than the two documents at their ends; a document
    larger than a shard's target leaves neighbours empty. ``slot`` counts the documents of
    a shard from 0. A null text has no bytes; an empty table gives an empty result.
    """
    text = F.coalesce(documents["text"], F.lit(""))
    row = F.struct(*[documents[f"`{c}`"] for c in (keep if keep is not None else documents.columns)])
    sized = documents.select(
        row.alias("row"), documents["doc_id"].alias("id"), F.md5(text).alias("digest"), F.monotonically_increasing_id().alias("nth"), (F.octet_length(text) + HEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    # nth only spreads rows that are equal in all else; the table is written before anything rests on it.
    ordered = sized.repartitionByRange("id", "digest", "nth").withColumn("part", F.spark_partition_id())
    ordered = scratch.table("ordered", ordered)
    totals = ordered.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    parts = totals.select("part", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"), F.sum("bytes").over(Window.partitionBy()).alias("total"))
    within = Window.partitionBy("part").orderBy("id", "digest", "nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ordered.withColumns({"upto": F.sum("size").over(within), "nth_here": F.row_number().over(Window.partitionBy("part").orderBy("id", "digest", "nth"))}).join(parts, "part")
    before = F.col("bytes_before") + F.col("upto") - F.col("size")
    middle = (2 * before + F.col("size")).cast("decimal(38,0)")
    placed = placed.select(
        "row", "size", "text_crc32", before.alias("before"), (F.col("rows_before") + F.col("nth_here") - 1).alias("place"), F.floor(middle * shards / (2 * F.col("total").cast("decimal(19,0)"))).cast("int").alias("shard")
    )
    placed = scratch.table("placed", placed)
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))  # a row for each shard
    return placed.join(F.broadcast(firsts), "shard").select("row", "size", "text_crc32", "before", "shard", (F.col("place") - F.col("first")).alias("slot"))


def shard_documents(documents: DataFrame, scratch: Scratch, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, before: see cut_shards.

    The law is ``bytes``: sizes are near equal. ``grown_shard`` is null: with one more
    shard all cuts move. Further columns are left out, so their names cannot clash; null and repeated
    doc_ids are documents of their own.
    """
    cuts = cut_shards(documents, scratch, shards, ["doc_id"])
    return cuts.select(F.col("row.doc_id").cast("long").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "before")


def write_shards(documents: DataFrame, path: str, scratch: Scratch, shards: int = 40) -> DataFrame:
    """Write all rows with their own columns, a folder shard=k for each shard, and give shard, documents, bytes, first and last of each.

    Files of a shard hold its rows in order. A column named shard would clash with the folders'
    name, so the rows stand in a column ``row`` beside ``slot``.
    """
    cuts = scratch.table("cuts", cut_shards(documents, scratch, shards))
    cuts.select("shard", "slot", "row").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return cuts.groupBy("shard").agg(F.count("*").alias("documents"), F.sum("size").alias("bytes"), F.min("row.doc_id").alias("first"), F.max("row.doc_id").alias("last"))
