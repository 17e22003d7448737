"""Exact removal of repeated byte strings by a sparse, hash-compared suffix sort.

A string of ``LENGTH`` bytes that occurs twice has the same least k-gram at the same place
in both, so only the suffixes at those places (anchors, about one byte in thirty) have to be
sorted. They are dealt to buckets by their k-gram. Anchors with the same whole context are
repeats of the first of them at once: within a task's batch their bytes are compared, across
batches the k-gram's hash and the context's, 96 bits or more, stand for them. Where contexts differ, a bucket's suffixes go through
a mergesort that compares two of them by binary search over prefix polynomial hashes for
their common extension; the extensions of neighbours and the hashes of what stands before
the anchors tell which strings are equal, and the bytes themselves confirm it.

k-grams with more than ``HOT`` contexts (the edges of a passage that very many documents
share) are not sorted in one place: their strings themselves are grouped, which combines on
the way. A batch that holds more than ``LOCAL`` contexts of a k-gram sends them there at once
and tells the k-gram's bucket, so that no bucket gets all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from quillboard.llm._arrow import BYTE, chunks, mix, powers, prefix_hash, utf8
from quillboard.llm._scratch import Scratch

LENGTH = 100
GRAM = 40
SIDE = LENGTH - GRAM  # the most context that a string has on either side of its anchor
HOT = 20_000
LOCAL = 512
NONE = 0xFFFFFFFF  # the tag of a row that only tells that a k-gram is hot
BUCKET = 100_000
SORTED = 15_000
PLANES = ("gram", "context", "doc", "high", "tag", "pos")
KINDS = (np.uint32, np.uint64, np.uint32, np.uint32, np.uint32, np.uint32)


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, place, k-gram hash, context hash and the context's bounds in the bytes of the anchors of some rows."""
    base, data = offsets[0], data[offsets[0] : offsets[-1]]
    ends, none = offsets - base, np.empty(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none.astype(np.uint64), none.astype(np.uint64), none, none
    p, inverse = prefix_hash(data), powers(len(data) + 1)[1]
    gram = mix((p[GRAM:] - p[:-GRAM]) * inverse[: len(data) - GRAM + 1])
    least = gram & np.uint64(0xFFFFFFFF00000000) | np.arange(len(gram), dtype=np.uint64)
    for step in (1, 2, 4, 8, 16):
        least = np.minimum(least[:-step], least[step:])
    least = np.minimum(least[: -(SIDE + 1 - 32)], least[SIDE + 1 - 32 :])
    edge = np.zeros(len(least) + 1, np.int32)
    long = np.diff(ends) >= LENGTH
    edge[ends[:-1][long]] += 1
    np.add.at(edge, ends[1:][long] - LENGTH + 1, -1)
    at = (least[np.cumsum(edge[:-1]) > 0] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    at = at[np.concatenate(([True], at[1:] != at[:-1]))] if len(at) else at
    row = np.searchsorted(ends, at, "right") - 1
    left, right = np.minimum(SIDE, at - ends[row]), np.minimum(SIDE, ends[row + 1] - at - GRAM)
    context = mix((p[at + GRAM + right] - p[at - left]) * inverse[at - left] + (left * (SIDE + 1) + right).astype(np.uint64))
    return row, at - ends[row], mix(gram[at]), context, at - left, at + GRAM + right  # mixed again: the least hashes are all small


def _rows(bucket: np.ndarray, planes: list[np.ndarray]) -> pa.RecordBatch:
    """A row for each run of equal bucket numbers."""
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
    blobs = [pa.array([x[a:b].astype(k).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()) for x, k in zip(planes, KINDS, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]]), *blobs], names=["bucket", *PLANES])


def _deal(held: list[tuple[np.ndarray, ...]], texts: list[np.ndarray], bits: int, batch: int) -> Iterator[pa.RecordBatch]:
    """The first anchor of each context by buckets; repeats and hot k-grams' contexts in a bucket of this batch."""
    gram, context, doc, tag, pos, lo, hi = (np.concatenate(c) for c in zip(*held, strict=True))
    order = np.argsort(context, kind="stable")
    same = context[order][1:] == context[order][:-1]
    twice = order[np.concatenate(([False], same)) | np.concatenate((same, [False]))]
    twice = twice[np.lexsort((pos[twice], tag[twice], doc[twice], context[twice]))]
    new = np.concatenate(([True], context[twice][1:] != context[twice][:-1])) if len(twice) else np.empty(0, bool)
    again, of = twice[~new], twice[np.maximum.accumulate(np.where(new, np.arange(len(twice)), 0))[~new]] if len(twice) else twice
    again = again[_same_bytes(np.concatenate(texts), lo, hi, again, of)]  # others have met by a collision of hashes
    first = np.ones(len(gram), bool)
    first[again] = False
    keep = np.flatnonzero(first)
    keep = keep[np.argsort(gram[keep], kind="stable")]
    _, at, times = np.unique(gram[keep], return_inverse=True, return_counts=True)
    hot = times[at] > LOCAL
    told, hot, keep = keep[hot & np.concatenate(([True], at[1:] != at[:-1]))] if len(keep) else keep, keep[hot], keep[~hot]
    bucket = (gram >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(gram), np.int64)
    planes = [gram >> np.uint64(32 - bits) & np.uint64(0xFFFFFFFF), context, doc & 0xFFFFFFFF, doc >> 32 & 0xFFFFFFFF, tag, pos]
    yield _rows(bucket[keep], [x[keep] for x in planes])
    if len(told):
        yield _rows(bucket[told], [*(x[told] for x in planes[:4]), np.full(len(told), NONE), planes[5][told]])
    for kind, some in ((0, again), (1, hot)):
        if len(some):
            yield _rows(np.full(len(some), -1 - 2 * batch - kind), [x[some] for x in planes])


def _same_bytes(data: np.ndarray, lo: np.ndarray, hi: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the contexts i and j are the same bytes, a block of pairs at a time."""
    out = hi[i] - lo[i] == hi[j] - lo[j]
    for k in range(0, len(i), 20_000):
        s = np.flatnonzero(out[k : k + 20_000]) + k
        at = np.arange(SIDE + LENGTH)
        inside = at < (hi[i[s]] - lo[i[s]])[:, None]
        a, b = (data[np.minimum(lo[x[s]][:, None] + at, len(data) - 1)] for x in (i, j))
        out[s] = ((a == b) | ~inside).all(axis=1)
    return out


def _meet(table: pa.Table) -> pa.Table:
    """kind 0: a repeat of a whole context; 1: first of its context, others exist; 2: the same, of a hot k-gram."""
    bucket = table.column("bucket")[0].as_py()
    gram, context, doc, high, tag, pos = (np.frombuffer(b"".join(table.column(n).to_pylist()), k) for n, k in zip(PLANES, KINDS, strict=True))
    doc = doc.astype(np.int64) | high.astype(np.int64) << 32
    if bucket < 0:
        kind = np.full(len(doc), 0 if bucket % 2 else 2, np.int32)
    else:
        told = np.unique(gram[tag == NONE])
        gram, context, doc, pos, tag = (x[tag != NONE] for x in (gram, context, doc, pos, tag))
        order = np.argsort(gram, kind="stable")
        same = gram[order][1:] == gram[order][:-1]
        alone = ~(np.concatenate(([False], same)) | np.concatenate((same, [False]))) if len(order) else np.empty(0, bool)
        order = order[~alone | np.isin(gram[order], told)]
        order = order[np.lexsort((pos[order], tag[order], doc[order], context[order], gram[order]))]
        gram, context, doc, tag, pos = (x[order] for x in (gram, context, doc, tag, pos))
        new = np.concatenate(([True], gram[1:] != gram[:-1])) if len(gram) else np.empty(0, bool)
        first = new | np.concatenate(([True], context[1:] != context[:-1])) if len(gram) else new
        _, group = np.unique(np.cumsum(new), return_inverse=True)
        contexts = np.bincount(group, first)[group] if len(gram) else np.empty(0)
        hot = (contexts > HOT) | np.isin(gram, told)
        kind = np.where(first, np.where(hot, 2, 1), 0).astype(np.int32)
        used = ~first | (contexts > 1) | hot
        kind, gram, doc, tag, pos = (x[used] for x in (kind, gram, doc, tag, pos))
    return pa.table({"kind": kind, "gram": gram.astype(np.int64) | max(bucket, 0) << 32, "doc_id": doc, "tag": tag.astype(np.int32), "pos": pos.astype(np.int64)})


def _contexts(docs: DataFrame, found: DataFrame) -> DataFrame:
    """gram, doc_id, tag, pos, left, right, bytes: the anchors' contexts, cut from the texts."""
    wanted = found.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("gram", "pos", "kind")).alias("anchors"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = utf8(b.column("text"))
            lists = b.column("anchors")
            row = np.repeat(np.arange(len(b)), np.diff(lists.offsets.to_numpy()))
            flat = lists.flatten()
            gram, pos, kind = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            lo, hi = np.maximum(offsets[row], offsets[row] + pos - SIDE), np.minimum(offsets[row + 1], offsets[row] + pos + LENGTH)
            for k in range(0, len(row), 20_000):
                s = slice(k, k + 20_000)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram[s]), b.column("doc_id").take(pa.array(row[s])), b.column("tag").take(pa.array(row[s])), pa.array(pos[s]), pa.array(kind[s]),
                        pa.array((offsets[row] + pos - lo)[s].astype(np.int32)), pa.array([data[x:y].tobytes() for x, y in zip(lo[s].tolist(), hi[s].tolist(), strict=True)], pa.binary()),
                    ],
                    names=["gram", "doc_id", "tag", "pos", "kind", "left", "bytes"],
                )

    return docs.join(wanted, ["doc_id", "tag"]).select("doc_id", "tag", "text", "anchors").mapInArrow(run, "gram long, doc_id long, tag int, pos long, kind int, left int, bytes binary")


class Suffixes:
    """Anchors' contexts with the anchors below each other: bytes, and prefix hashes of the rows."""

    def __init__(self, contexts: list[bytes], left: np.ndarray):
        size = np.array([len(c) for c in contexts], np.int64)
        self.left, self.right = left.astype(np.int64), size - left - GRAM
        self.bytes = np.zeros((len(contexts), SIDE + LENGTH), np.uint8)
        flat = np.frombuffer(b"".join(contexts), np.uint8)
        row = np.repeat(np.arange(len(contexts)), size)
        column = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(SIDE - self.left, size)
        self.bytes[row, column] = flat
        self.hash = np.zeros((len(contexts), SIDE + LENGTH + 1), np.uint64)
        np.cumsum(BYTE[self.bytes] * powers(SIDE + LENGTH)[0], axis=1, out=self.hash[:, 1:])

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many bytes after the k-grams are the same: a binary search over prefix hashes."""
        at, lo, hi = SIDE + GRAM, np.zeros(len(i), np.int64), np.minimum(self.right[i], self.right[j])
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            same = self.hash[i, at + mid] - self.hash[i, at] == self.hash[j, at + mid] - self.hash[j, at]
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    def before(self, i: np.ndarray, j: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether suffix i sorts before suffix j; ``ties`` decides between equal ones."""
        n = self.common(i, j)
        ended = n == np.minimum(self.right[i], self.right[j])
        at = np.minimum(SIDE + GRAM + n, SIDE + LENGTH - 1)
        return np.where(ended, (self.right[i] < self.right[j]) | (self.right[i] == self.right[j]) & ties, self.bytes[i, at] < self.bytes[j, at])

    def mergesort(self, group: np.ndarray) -> np.ndarray:
        """The rows of each group (groups stand together) in the order of their suffixes."""
        order, n = np.arange(len(group)), len(group)
        starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        sizes = np.diff(np.append(starts, n))
        start, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
        width = 1
        while width < sizes.max():
            moved = np.flatnonzero(size > width)  # smaller groups are in order
            local = moved - start[moved]
            block, mine = local // (2 * width) * (2 * width), local % (2 * width) >= width
            other = start[moved] + block + np.where(mine, 0, width)
            there = np.clip(start[moved] + size[moved] - other, 0, width)
            lo, hi = np.zeros(len(moved), np.int64), there.copy()
            while (open_ := np.flatnonzero(lo < hi)).size:  # how many of the other run go before
                mid = (lo[open_] + hi[open_]) // 2
                less = self.before(order[other[open_] + mid], order[moved[open_]], mine[open_])
                lo[open_], hi[open_] = np.where(less, mid + 1, lo[open_]), np.where(less, hi[open_], mid)
            target = start[moved] + block + local % width + lo
            fresh = order.copy()
            fresh[target] = order[moved]
            order, width = fresh, 2 * width
        return order


def repeated_strings(gram: np.ndarray, rank: np.ndarray, contexts: list[bytes], left: np.ndarray) -> np.ndarray:
    """For each anchor, bit o is set if the string that starts o bytes before it also starts earlier.

    ``rank`` orders the anchors: smaller is earlier, equal ones are not earlier than each other.
    """
    by = np.argsort(gram, kind="stable")
    s = Suffixes([contexts[k] for k in by], left[by])
    order = s.mergesort(gram[by])
    group = gram[by][order]
    lcp = np.zeros(len(order), np.int64)
    lcp[1:] = s.common(order[:-1], order[1:])
    lcp[np.concatenate(([True], group[1:] != group[:-1]))] = -1
    place, mask = rank[by][order], np.zeros(len(order), np.uint64)
    for o in range(SIDE + 1):
        v = np.flatnonzero((s.left[order] >= o) & (s.right[order] >= SIDE - o))
        run = np.cumsum(lcp < SIDE - o)[v]
        rows = order[v]
        before = s.hash[rows, SIDE] - s.hash[rows, SIDE - o]
        k = np.lexsort((place[v], before, run))
        new = np.concatenate(([True], (run[k][1:] != run[k][:-1]) | (before[k][1:] != before[k][:-1]))) if len(k) else np.empty(0, bool)
        first = k[np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))] if len(k) else k
        later = np.flatnonzero(place[v[k]] > place[v[first]])
        mine, theirs = s.bytes[rows[k[later]], SIDE - o : SIDE - o + LENGTH], s.bytes[rows[first[later]], SIDE - o : SIDE - o + LENGTH]
        sure = (mine == theirs).all(axis=1)
        mask[v[k[later[sure]]]] |= np.uint64(1) << np.uint64(o)
        if not sure.all():  # a collision of hashes: the bytes decide
            least: dict[bytes, int] = {}
            strings = [s.bytes[r, SIDE - o : SIDE - o + LENGTH].tobytes() for r in rows]
            for text, x in zip(strings, place[v].tolist(), strict=True):
                least[text] = min(x, least.get(text, x))
            for text, x, at in zip(strings, place[v].tolist(), v.tolist(), strict=True):
                if x > least[text]:
                    mask[at] |= np.uint64(1) << np.uint64(o)
    out = np.zeros(len(order), np.uint64)
    out[by[order]] = mask
    return out


def _sorted(table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    doc, tag, pos = (table.column(c).to_numpy() for c in ("doc_id", "tag", "pos"))
    order = np.lexsort((pos, tag, doc))
    step = np.concatenate(([0], (doc[order][1:] != doc[order][:-1]) | (tag[order][1:] != tag[order][:-1]) | (pos[order][1:] != pos[order][:-1]))) if len(doc) else np.empty(0)
    rank = np.empty(len(doc), np.int64)
    rank[order] = np.cumsum(step)
    mask = repeated_strings(table.column("gram").to_numpy(), rank, table.column("bytes").to_pylist(), table.column("left").to_numpy())
    hit = np.flatnonzero(mask)
    return pa.table({"doc_id": doc[hit], "tag": tag[hit], "pos": pos[hit], "mask": mask[hit].view(np.int64)})


def _hot_strings(hot: DataFrame) -> DataFrame:
    """doc_id, tag, pos, mask of strings around hot k-grams, grouped by their bytes."""
    one = F.explode(F.sequence(F.greatest(F.lit(0), F.lit(LENGTH) - (F.length("bytes") - F.col("left"))), F.col("left"))).alias("o")
    strings = hot.select("doc_id", "tag", "pos", "left", "bytes", one)
    strings = strings.select(F.struct("doc_id", "tag", (F.col("pos") - F.col("o")).alias("start")).alias("at"), "pos", "o", F.expr(f"substring(bytes, left - o + 1, {LENGTH})").alias("string"))
    least = strings.groupBy("string").agg(F.min("at").alias("least"), F.count("*").alias("n")).where("n > 1")
    later = strings.join(least, "string").where("at > least")
    return later.select("at.doc_id", "at.tag", "pos", F.expr("shiftleft(1L, o)").alias("mask"))


def _covered(n: int, marks: list[tuple[int, int]]) -> np.ndarray:
    """Which of n bytes belong to a marked string; mask -1 stands for all strings around the anchor."""
    edge = np.zeros(n + 1, np.int32)
    pos, mask = np.array([m[0] for m in marks], np.int64), np.array([m[1] for m in marks], np.int64)
    whole = mask == -1
    np.add.at(edge, np.maximum(0, pos[whole] - SIDE), 1)
    np.add.at(edge, np.minimum(n, pos[whole] + LENGTH), -1)
    k, o = np.nonzero((mask[~whole].view(np.uint64)[:, None] >> np.arange(SIDE + 1, dtype=np.uint64)) & np.uint64(1))
    start = pos[~whole][k] - o
    np.add.at(edge, start, 1)
    np.add.at(edge, start + LENGTH, -1)
    return np.cumsum(edge[:-1]) > 0


def _whole_characters(text: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """The mask widened to all bytes of each UTF-8 character that loses one."""
    if not gone.any():
        return gone
    character = np.cumsum((text & 0xC0) != 0x80)
    return np.bincount(character, gone)[character] > 0


def repeats(documents: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """row, doc_id, text and tag of the documents, and (doc_id, tag, marks) of those with repeated strings."""
    docs = documents.select(F.struct(*[documents[f"`{c}`"] for c in documents.columns]).alias("row"), documents["doc_id"].cast("long").alias("doc_id"), documents["text"].alias("text"))
    unique = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()
    if unique:
        docs = docs.withColumn("tag", F.lit(0))
    else:  # rows that share a doc_id: equal texts are one document, others follow each other
        ranked = docs.where("doc_id is not null").withColumn("tag", F.dense_rank().over(Window.partitionBy("doc_id").orderBy("text")) - 1)
        docs = ranked.union(docs.where("doc_id is null").withColumn("tag", F.lit(0)))
    known = docs.where("doc_id is not null").select("doc_id", "tag", "text")
    known = known if unique else known.dropDuplicates(["doc_id", "tag"])
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, min(31, int(np.ceil(np.log2(max(1, size / 30 / BUCKET))))))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts, n, size, batch = [], [], 0, 0, TaskContext.get().partitionId() << 20
        for b in batches:
            data, offsets = utf8(b.column("text"))
            doc, tag = b.column("doc_id").to_numpy(), b.column("tag").to_numpy()
            for lo, hi in chunks(offsets, 1 << 18):
                row, pos, gram, context, start, end = anchors(data, offsets[lo : hi + 1])
                if len(row):
                    held.append((gram, context, doc[lo + row], tag[lo + row].astype(np.int64), pos, size + start, size + end))
                    texts.append(data[offsets[lo] : offsets[hi]])
                    n, size = n + len(row), size + len(texts[-1])
                if n > 300_000:
                    yield from _deal(held, texts, bits, batch)
                    held, texts, n, size, batch = [], [], 0, 0, batch + 1
        if held:
            yield from _deal(held, texts, bits, batch)

    dealt = known.mapInArrow(find, "bucket long, " + ", ".join(f"{p} binary" for p in PLANES))
    met = scratch.table("met", dealt.groupBy("bucket").applyInArrow(_meet, "kind int, gram long, doc_id long, tag int, pos long"))
    open_ = met.where("kind > 0")
    contexts = scratch.table("contexts", _contexts(known, open_))
    buckets = max(1, contexts.where("kind = 1").count() // SORTED + 1)
    cold = contexts.where("kind = 1").withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(buckets)))
    marks = cold.groupBy("bucket").applyInArrow(_sorted, "doc_id long, tag int, pos long, mask long")
    marks = marks.union(_hot_strings(contexts.where("kind = 2"))).union(met.where("kind = 0").select("doc_id", "tag", "pos", F.lit(-1).cast("long").alias("mask")))
    gathered = scratch.table("marks", marks.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("pos", "mask")).alias("marks")))
    return docs, gathered


def remove_repeats(documents: DataFrame, scratch: Scratch, keep: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document.

    Removes each byte that a string of LENGTH bytes covers which also starts earlier: in a
    smaller doc_id, or in the same document further in front. ``keep`` gives the documents
    with what is left of their texts and its length in n_chars instead; a character that
    loses a byte goes whole there.

    Null texts are empty. Rows with a null doc_id are left whole and take nothing from
    others. Rows that share a doc_id and a text are one document; with other texts they
    follow each other in the order of the texts.
    """
    docs, gathered = repeats(documents, scratch)
    joined = docs.join(gathered, ["doc_id", "tag"], "left")

    def cut(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        data, offsets = utf8(b.column("text"))
        for lo, hi, marks in zip(offsets[:-1].tolist(), offsets[1:].tolist(), b.column("marks"), strict=True):
            text, marks = data[lo:hi], marks.as_py()
            yield text, _covered(hi - lo, [(m["pos"], m["mask"]) for m in marks]) if marks else np.zeros(hi - lo, bool)

    if keep:
        kinds = documents.schema

        def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                texts = [None if null else text[~_whole_characters(text, gone)].tobytes().decode() for (text, gone), null in zip(cut(b), pc.is_null(b.column("text")).to_pylist(), strict=True)]
                columns = dict(zip(kinds.names, b.column("row").flatten(), strict=True)) | {"text": pa.array(texts, pa.string())}
                if "n_chars" in columns:
                    columns["n_chars"] = pa.array([None if t is None else len(t) for t in texts], columns["n_chars"].type)
                yield pa.RecordBatch.from_pydict(columns)

        return joined.select("row", "text", "marks").mapInArrow(left, kinds)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, gone in cut(b):
                rows.append((len(text), int(gone.sum()), int(gone[:1].sum() + np.count_nonzero(gone[1:] & ~gone[:-1])), hashlib.sha256(text[~gone].tobytes()).hexdigest()))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return joined.select("doc_id", "text", "marks").mapInArrow(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
