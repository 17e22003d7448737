"""Which terms tell the sources of a language apart, and how far apart sources are.

Every source gives every term of its language's vocabulary a smoothed share p in parts of
10^9; two shares p and q differ by (p - q)^2 / (p + q), rounded down. All arithmetic is in
whole numbers.

Terms of a source are ranked by how far it stands above its language, which grows with
the term's count in the source and falls with its count in the language. So a term that
k others dominate (higher or equal count in the source, lower or equal in the language,
earlier in UTF-8) cannot be among the first k: each partition keeps its skyband only, the
skybands are merged, and what is left is ranked exactly.

Distances of pairs of sources are summed over the vocabulary in groups of some hundred
terms by at most 256 x 256 sources, so no group grows with the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from quillboard.llm._arrow import chunks, utf8
from quillboard.llm._scratch import Scratch
from quillboard.llm._words import NOT_LETTERS, codes, cut

UNIT = 1_000_000_000
#: Rows of counts that a task holds before it adds them up, and that it sends on above.
HELD, SENT = 400_000, 200_000
#: Sources on a side and terms in a group of the pairs' sums; rows of a skyband's step.
SIDE, TERMS, STEP = 256, 256, 2048


def term_counts(documents: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (rows that hold it): terms are stretches of letters, A-Z lower-cased.

    Each task adds up what it has read before anything is shuffled. Null lang, source and
    text are ''.
    """
    columns = documents.select(*[F.coalesce(documents[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])

    def added(tables: list[pa.Table]) -> pa.Table:
        total = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
        return total.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            data, offsets = utf8(b.column("text"))
            groups = pa.StructArray.from_arrays([b.column("lang").cast(pa.string()), b.column("source").cast(pa.string())], names=["lang", "source"])
            of_row, seen = [], {}
            for g in groups.to_pylist():
                of_row.append(seen.setdefault((g["lang"], g["source"]), len(seen)))
            of_row, seen = np.array(of_row, np.int64), list(seen)
            for lo, hi in chunks(offsets, 1 << 21):
                words, bounds = cut(data, offsets[lo : hi + 1], NOT_LETTERS, fold=True)
                word, kinds = codes(words)
                if not len(word):
                    continue
                row = np.repeat(np.arange(hi - lo), np.diff(bounds))
                pair, times = np.unique(row * len(kinds) + word, return_counts=True)
                key, at = np.unique(of_row[lo + pair // len(kinds)] * len(kinds) + pair % len(kinds), return_inverse=True)
                names = [seen[k] for k in (key // len(kinds)).tolist()]
                n = np.bincount(at, weights=times).astype(np.int64)  # of one chunk: far below 2^53
                held.append(pa.table({"lang": pa.array([x[0] for x in names], pa.string()), "source": pa.array([x[1] for x in names], pa.string()), "term": kinds.take(pa.array(key % len(kinds))).cast(pa.string()), "n": n, "docs": np.bincount(at).astype(np.int64)}))
                rows += len(key)
                if rows > HELD:
                    held = [added(held)]
                    rows = len(held[0])
                    if rows > SENT:
                        yield from held[0].to_batches(10_000)
                        held, rows = [], 0
        if held:
            yield from added(held).to_batches(10_000)

    counted = columns.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _band(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows that fewer than k of their group's rows dominate; rows come by group, then n descending, lang_n ascending, term.

    What dominates a row comes before it, and of k rows that do k are in the band
    themselves, so only the band is held.
    """
    group, band = None, None
    for b in batches:
        t = pa.Table.from_batches([b])
        if not len(t):
            continue
        label = t.column("lang").combine_chunks(), t.column("source").combine_chunks()
        new = np.ones(len(t), bool)
        if len(t) > 1:
            new[1:] = np.logical_or(*[pc.not_equal(x.slice(1), x.slice(0, len(x) - 1)).to_numpy(zero_copy_only=False) for x in label])
        edges = [*np.flatnonzero(new).tolist(), len(t)]
        for s, e in zip(edges, edges[1:], strict=False):
            here = (label[0][s].as_py(), label[1][s].as_py())
            if here != group:
                if band is not None:
                    yield from band.to_batches()
                group, band = here, None
            for lo in range(s, e, STEP):
                band = _kept(band, t.slice(lo, min(STEP, e - lo)), k)
    if band is not None:
        yield from band.to_batches()


def _kept(band: pa.Table | None, rows: pa.Table, k: int) -> pa.Table:
    """The band with those of the next rows that fewer than k of the band and of these rows dominate."""
    held = 0 if band is None else len(band)
    both = (rows if band is None else pa.concat_tables([band, rows])).combine_chunks()
    n, lang_n = (both.column(c).to_numpy() for c in ("n", "lang_n"))
    place = np.empty(len(both), np.int64)  # of terms in UTF-8 order
    place[pc.sort_indices(both.column("term").cast(pa.binary())).to_numpy()] = np.arange(len(both))

    def dominated(x: np.ndarray, by: np.ndarray) -> np.ndarray:
        return np.concatenate([((n[by] >= n[p, None]) & (lang_n[by] <= lang_n[p, None]) & (place[by] < place[p, None])).sum(1) for p in np.array_split(x, len(x) // 512 + 1)])

    new, old = np.arange(held, len(both)), np.arange(held)
    times = dominated(new, old)
    new, times = new[times < k], times[times < k]
    new = new[times + dominated(new, new) < k]
    return both.take(pa.array(np.concatenate((old, new))))


def skyband(terms: DataFrame, k: int) -> DataFrame:
    """The rows of lang, source, term, n, lang_n, ... that fewer than k of their (lang, source) dominate: by partition, then merged."""
    order = ["lang", "source", F.desc("n"), "lang_n", "term"]
    run = lambda batches: _band(batches, k)
    parts = terms.sortWithinPartitions(*order).mapInArrow(run, terms.schema)
    return parts.repartition("lang", "source").sortWithinPartitions(*order).mapInArrow(run, terms.schema)


def _sums(rows: pa.Table, side: int) -> pa.Table:
    """Sums over a group's terms of the distance of each two sources, and the number of terms; rows without a term give the share of a count of 0."""
    at, p, left, right = (rows.column(c).to_numpy() for c in ("at", "p", "left", "right"))
    base = pc.is_null(rows.column("term")).to_numpy()
    sources, where = np.unique(at, return_inverse=True)
    term = codes(pc.fill_null(rows.column("term"), "").combine_chunks().cast(pa.large_binary()))[0]
    _, term = np.unique(term[~base], return_inverse=True)
    zero = np.zeros(len(sources), np.int64)
    zero[where[base]] = p[base]
    share = np.tile(zero, (int(term.max(initial=-1)) + 1, 1))
    share[term, where[~base]] = p[~base]
    out: list[list[np.ndarray]] = [[], [], []]
    block = sources // side
    for s in np.flatnonzero(block == left[0]).tolist():
        others = np.flatnonzero((block == right[0]) & (sources > sources[s]))
        apart = share[:, others] - share[:, s, None]
        value = (apart * apart // np.maximum(1, share[:, others] + share[:, s, None])).sum(0)
        for held, x in zip(out, (np.full(len(others), sources[s]), sources[others], value), strict=True):
            held.append(x)
    columns = [np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64) for x in out]
    lang = rows.column("lang")[0].as_py()
    seen = np.full(len(columns[0]), len(share), np.int64)
    return pa.table({"lang": pa.array([lang] * len(seen), pa.string()), "a": columns[0], "b": columns[1], "value": columns[2], "seen": seen})


def source_divergence(documents: DataFrame, scratch: Scratch, least_docs: int = 10, best: int = 10, side: int = SIDE, terms: int = TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: distances of the sources of each language, and the terms that stand out in them.

    Part ``pair``: item is each other source of the language, value their distance summed
    over the language's vocabulary (terms in at least ``least_docs`` of its rows), all ranks.
    Part ``term``: the ``best`` terms of the source by distance from its language, of those
    whose share is above the language's. Ranks go by value, descending, then by item in
    UTF-8. Null lang, source and text are ''; a source without terms has pairs all the
    same, a language of one source has none. ``side`` and ``terms`` bound the groups in which
    distances are summed. Each row is a document, rows that share a
    doc_id too; an empty table gives an empty result, further columns are left out.
    """
    whole = Window.partitionBy("lang", "term")
    counts = term_counts(documents).withColumns({"lang_n": F.sum("n").over(whole), "lang_docs": F.sum("docs").over(whole), "first": F.min("source").over(whole) == F.col("source")})
    counts = scratch.table("counts", counts.where(F.col("lang_docs") >= least_docs).drop("docs", "lang_docs"))
    sources = documents.select(*[F.coalesce(documents[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum(F.col("first").cast("long")).alias("firsts"))
    lang = Window.partitionBy("lang")
    groups = sources.join(totals, ["lang", "source"], "left").na.fill(0, ["total", "firsts"])
    groups = groups.withColumns({"kinds": F.sum("firsts").over(lang), "lang_total": F.sum("total").over(lang), "at": F.row_number().over(lang.orderBy("source")).cast("long") - 1, "blocks": F.ceil(F.count("*").over(lang) / side)})
    groups = scratch.table("groups", groups.drop("firsts"))  # a row for each source of a language

    def share(n: str, total: str):
        return F.expr(f"1 + (cast({UNIT} as decimal(20,0)) * ({n} + 2)) div nullif(cast({total} + 2 * kinds as decimal(20,0)), 0)")

    shared = counts.join(groups, ["lang", "source"]).withColumns({"p": share("n", "total"), "q": share("lang_n", "lang_total")})

    banded = skyband(shared.where("p > q").select("lang", "source", "term", "n", "lang_n", "p", "q"), best)
    ranked = banded.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))

    # Each row goes to the group of its term and of its block with every block of sources.
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    salts = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("kinds") / terms))
    some = shared.select("lang", "term", "at", "p", "blocks", F.pmod(F.xxhash64("term"), salts).alias("salt"))
    zero = groups.select("lang", F.lit(None).cast("string").alias("term"), "at", share("0", "total").alias("p"), "blocks", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"))
    dealt = some.unionByName(zero.na.fill(0, ["p"])).withColumn("other", other).withColumn("block", F.floor(F.col("at") / side))
    dealt = dealt.select("lang", "term", "at", "p", "salt", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"))
    sums = dealt.groupBy("lang", "salt", "left", "right").applyInArrow(lambda t: _sums(t, side), "lang string, a long, b long, value long, seen long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    both = sums.select("lang", F.col("a").alias("at"), F.col("b").alias("to"), "value", "seen").union(sums.select("lang", F.col("b"), F.col("a"), "value", "seen"))
    names = groups.select("lang", "at", "source", "kinds", F.coalesce(share("0", "total"), F.lit(0)).alias("x"))
    pairs = both.join(names, ["lang", "at"]).join(names.select("lang", F.col("at").alias("to"), F.col("source").alias("item"), F.col("x").alias("y")), ["lang", "to"])
    unseen = F.expr("(kinds - seen) * ((x - y) * (x - y) div greatest(x + y, 1))")  # terms that neither source's block holds
    rows = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", (F.col("value") + unseen).alias("value")).unionByName(ranked)
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return rows.withColumn("rank", rank).where((F.col("part") == "pair") | (F.col("rank") <= best))
