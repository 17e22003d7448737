"""Mixing sources to target weights by Pfair scheduling.

A source of weight w (``part`` of ``period`` slots) owes its block k between the release
floor(k / w) and the deadline ceil((k + 1) / w). In each slot the earliest deadline among
the released blocks goes first. With weights that sum to one, a source's blocks never run
ahead of or fall behind its share by a whole block. The schedule repeats with the period,
so one period is laid out and each block is placed by arithmetic; no step runs through
the documents one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

BUCKETS = 4096


def natural_parts(counts: dict[str, int], period: int = 1000) -> dict[str, int]:
    """Whole parts of a period in proportion to the sources' sizes, one at least for each.

    The period grows where there are many sources; what rounding leaves goes to the
    sources that are furthest below their share.
    """
    total, period = sum(counts.values()), max(period, 4 * len(counts))
    parts = {s: max(1, n * period // total) for s, n in counts.items()}
    for s in sorted(counts, key=lambda s: (parts[s] - counts[s] * period / total, s))[: max(0, period - sum(parts.values()))]:
        parts[s] += 1
    return parts


def edf_period(spark: SparkSession, parts: dict[str, int]) -> DataFrame:
    """source, nth, slot: where a period places the nth block of each source (a row for each slot)."""
    names = sorted(parts)
    period = sum(parts.values())
    weights = F.array(*[F.lit(parts[s]).cast("long") for s in names])
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), len(names)).alias("done"), F.array().cast("array<int>").alias("picks"))

    def step(state, t):
        def due(i):
            done, w = F.get(state["done"], i), F.get("weights", i)
            released = done * period < (t + 1) * w
            return F.when(released, F.struct(F.ceil((done + 1) * period / w).alias("deadline"), i.alias("i")))

        pick = F.array_min(F.transform(F.sequence(F.lit(0), F.lit(len(names) - 1)), due))["i"]
        return F.struct(F.transform(state["done"], lambda d, i: d + (i == pick).cast("long")).alias("done"), F.array_append(state["picks"], pick).alias("picks"))

    one = spark.range(1).select(weights.alias("weights"))
    laid = one.select(F.aggregate(F.sequence(F.lit(0).cast("long"), F.lit(period - 1).cast("long")), start, step)["picks"].alias("picks"))
    slots = laid.select(F.posexplode("picks").alias("slot", "i"))
    name = F.get(F.array(*map(F.lit, names)), F.col("i"))
    return slots.select(name.alias("source"), "slot", (F.row_number().over(Window.partitionBy("i").orderBy("slot")) - 1).alias("nth"))


def placed(documents: DataFrame, keep: list[str], parts: dict[str, int] | None = None, block_docs: int = 8) -> DataFrame:
    """row (the columns to keep of a document), source, block, place, release, deadline and slot: see mix_sources."""
    spark = documents.sparkSession
    whole = F.struct(*[documents[f"`{c}`"] for c in documents.columns])
    # Documents without a doc_id, and those that share one, are told apart by their texts.
    told = F.md5(F.coalesce(documents["text"], F.lit(""))) if "text" in documents.columns else F.md5(F.xxhash64(whole).cast("string"))
    key = F.md5(F.coalesce(documents["doc_id"].cast("string"), told))
    row = F.struct(*[documents[f"`{c}`"] for c in keep])
    docs = documents.select(row.alias("row"), F.coalesce(documents["source"], F.lit("")).alias("source"), F.struct(key.alias("a"), told.alias("b"), F.xxhash64(whole).alias("c")).alias("key"))
    docs = docs.withColumn("bucket", F.conv(F.concat(F.substring("key.a", 1, 2), F.substring("key.b", 1, 1)), 16, 10).cast("int"))
    tally = docs.groupBy("source", "bucket").agg(F.count("*").alias("n"))
    counts = dict(tally.groupBy("source").agg(F.sum("n")).collect())  # a row for each source
    if parts is None:
        parts = natural_parts(counts)
    parts = {s: parts.get(s, 1) for s in counts} or {"": 1}
    period = sum(parts.values())
    part = F.create_map(*[x for s, p in parts.items() for x in (F.lit(s), F.lit(p).cast("long"))])
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tally.select("source", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("source", "bucket").orderBy("key")
    ranked = docs.join(offsets, ["source", "bucket"]).select("row", "source", (F.col("before") + F.row_number().over(within) - 1).alias("rank"))
    blocks = ranked.select("row", "source", F.expr(f"rank div {block_docs}").alias("block"), (F.col("rank") % block_docs).alias("place"), part[F.col("source")].alias("part"))
    blocks = blocks.withColumn("nth", (F.col("block") % F.col("part")).cast("int")).withColumn("turn", F.expr("block div part"))
    found = blocks.join(F.broadcast(edf_period(spark, parts)), ["source", "nth"])  # a row for each slot of the period
    return found.select(
        "row",
        "source",
        "block",
        "place",
        F.expr(f"block * {period} div part").alias("release"),
        F.expr(f"((block + 1) * {period} + part - 1) div part").alias("deadline"),
        (F.col("turn") * period + F.col("slot")).alias("slot"),
    )


def mix_sources(documents: DataFrame, parts: dict[str, int] | None = None, block_docs: int = 8) -> DataFrame:
    """doc_id, source, block, place, release, deadline, slot: the place of every document in the mix.

    ``parts`` gives the target weights as whole parts of a period; without it they are the
    sources' natural shares. ``slot`` is the block's place in the interleaving, ``place``
    the document's place in its block; blocks hold ``block_docs`` documents in the order of
    digests of their doc_ids and texts. A source that is spent leaves its slots empty. All rows are
    returned: weights decide the order and nothing is dropped.

    A null source is the source ''. Rows that share a doc_id, or have none, get places of
    their own; equal rows get theirs in any order. An empty table gives an empty result,
    further columns are left out. The driver sees a row for each source and lays out one
    period, a step for each slot with a look at each source: meant for up to some hundreds
    of sources (a source of many hosts is one source).
    """
    return placed(documents, ["doc_id", "source"], parts, block_docs).select("row.doc_id", "row.source", "block", "place", "release", "deadline", "slot")


def mixed_documents(documents: DataFrame, parts: dict[str, int] | None = None, block_docs: int = 8) -> DataFrame:
    """All documents with their own columns, written in the order of the mix."""
    return placed(documents, documents.columns, parts, block_docs).repartitionByRange("slot", "place").sortWithinPartitions("slot", "place").select("row.*")
