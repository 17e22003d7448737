"""Exact Jaccard join of word shingle sets by parity sketches.

A set of n shingles is cut by hash into about n / 1.5 parts, and each part is XORed to one
code word: the sketch. A shingle that only one of two sets has changes one code at most, so
the number of codes that differ bounds the symmetric difference from below. Two sets of
similarity t differ in few enough shingles that some part with shingles in it must have the
same code in both: the pigeonhole. Sketches are made for size bands whose part counts are
powers of two; a set just above a band's border also enters the band below.

Codes that very many sets share (a passage, a near copy) pair nothing. A set is settled if
it has more unshared codes than it can lose to a partner. The few others meet once more by
single shingles; those that are still unsettled, members of large groups of near copies, are
compared with the group's pivot, its most central set, and, where that leaves some of them in
different components, block by block with the rest of the group.

Exact copies are one set: only the document with the smallest doc_id deals its codes. Codes meet by range of their hashes; in tables of more than ``SPLIT`` sets, each range is
dealt in as many parts by set first, where a code with more than ``HOT`` sets is told hot and
its sets go no further, so that what meets in the end is bounded for every code.

Set comparisons use 64-bit hashes of the shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillboard.llm._arrow import chunks, mix, utf8, word_hashes
from quillboard.llm._graph import connected_components
from quillboard.llm._scratch import Scratch

WIDTH = 5
NUMERATOR, DENOMINATOR = 75, 100
HOT = 32  # a code that more sets share pairs nothing by itself
BLOCK = 512  # sets of a pivot's group that are compared at once
BUCKET_CODES = 500_000
SPLIT = 500_000  # sets for which one code's references fit in a task
TOLD = (1 << 40) - 1  # the reference of a code that is known to be hot
TOKENS, FIRST = 0, 6  # the band of small sets, whose shingles are parts of their own; the first band of 2**6 parts
MULTIPLIERS = mix(np.arange(101, 101 + WIDTH, dtype=np.uint64))
REF = np.uint64((1 << 40) - 1)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = utf8(column)
    for lo, hi in chunks(offsets, 1 << 19):
        words, bounds = word_hashes(data, offsets[lo : hi + 1])
        spread = sum((words[k : len(words) - WIDTH + 1 + k] * m for k, m in enumerate(MULTIPLIERS)), np.uint64(0)) if len(words) >= WIDTH else np.empty(0, np.uint64)
        codes = mix(spread + np.uint64(WIDTH))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a >= WIDTH:
                yield np.unique(codes[a : b - WIDTH + 1])
            elif b > a:
                yield mix(np.array([(words[a:b] * MULTIPLIERS[: b - a]).sum() + np.uint64(b - a)], np.uint64))
            else:
                yield np.empty(0, np.uint64)


def _fingerprint(codes: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed longs."""
    n = np.uint64(len(codes))
    two = np.array([mix(codes ^ np.uint64(0x6A09E667F3BCC909)).sum() + n, np.bitwise_xor.reduce(mix(codes + np.uint64(0xBB67AE8584CAA73B))) + n if len(codes) else n], np.uint64)
    return tuple(two.view(np.int64).tolist())


def _bands(n: int) -> list[int]:
    """The size bands of a set: its own, and the one below if a partner can be there."""
    own = TOKENS if n < 1 << FIRST else n.bit_length() - 1
    below = TOKENS if own == FIRST else own - 1
    return [own] if own == TOKENS or n * NUMERATOR > ((1 << own) - 1) * DENOMINATOR else [own, below]


def _sketch(codes: np.ndarray, band: int) -> np.ndarray:
    """Codes of the parts that have shingles in them."""
    if band == TOKENS:
        return mix(codes + np.uint64(1))
    part = codes >> np.uint64(64 - band)
    starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    return mix(np.bitwise_xor.reduceat(mix(codes), starts) + part[starts] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(band))


def _loss(n: int, band: int, own: int) -> int:
    """The most shingles by which the set can differ from a partner that it may meet in the band."""
    partner = n * DENOMINATOR // NUMERATOR if band == own else (1 << own) - 1
    return (n + partner) * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR)


def _ref(key: int, band: int) -> int:
    return int((mix(np.array([key], np.int64).view(np.uint64) + np.array([band], np.uint64) * np.uint64(0xD6E8FEB86659FD93)) % REF)[0])


def set_table(documents: DataFrame) -> DataFrame:
    """doc_id, n, hi, lo and bands (ref, parts, loss) of each document's set."""
    band = pa.struct([("ref", pa.int64()), ("parts", pa.int64()), ("loss", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, hi, lo, bands = [], [], [], []
            for codes in shingle_sets(b.column("text")):
                n.append(len(codes))
                h, k = _fingerprint(codes)
                hi.append(h)
                lo.append(k)
                levels = _bands(len(codes)) if len(codes) else []
                bands.append([{"ref": _ref(h, x), "parts": len(_sketch(codes, x)), "loss": _loss(len(codes), x, levels[0])} for x in levels])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(bands, pa.list_(band))], names=["doc_id", "n", "hi", "lo", "bands"])

    return documents.select(documents["doc_id"].cast("long").alias("doc_id"), documents["text"].alias("text")).mapInArrow(run, "doc_id long, n long, hi long, lo long, bands array<struct<ref: long, parts: long, loss: long>>")


def _dealt(codes: list[np.ndarray], refs: list[np.ndarray], bits: int) -> pa.RecordBatch:
    """A row for each bucket of codes: the next 32 bits of each code, and its set's 40-bit reference."""
    code, ref = np.concatenate(codes), np.concatenate(refs)
    order = np.argsort(code, kind="stable")
    code, ref = code[order], ref[order]
    bucket = (code >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(code), np.int64)
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
    low, plane, top = (code >> np.uint64(32 - bits)).astype(np.uint32), ref.astype(np.uint32), (ref >> np.uint64(32)).astype(np.uint8)
    pieces = [[x[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)] for x in (low, plane, top)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]]), *(pa.array(p, pa.binary()) for p in pieces)], names=["bucket", "code", "ref", "top"])


DEALT = "bucket long, code binary, ref binary, top binary"
MET = "kind int, a long, b long, n long"  # 0: a pair and its common codes; 1: a pivot and a set; 2: a set and its hot codes


def _codes_and_refs(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (code, reference) of a bucket, in order; exact copies are one set."""
    joined = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
    code = joined("code", np.uint32)
    ref = joined("ref", np.uint32).astype(np.int64) | joined("top", np.uint8).astype(np.int64) << 32
    return code, ref


def _distinct(code: np.ndarray, ref: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ref, code))
    code, ref = code[order], ref[order]
    fresh = np.concatenate(([True], (code[1:] != code[:-1]) | (ref[1:] != ref[:-1]))) if len(code) else np.empty(0, bool)
    return code[fresh], ref[fresh]


def _shared(code: np.ndarray, ref: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Only the codes that stand more than once."""
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    twice = order[np.concatenate(([False], same)) | np.concatenate((same, [False]))] if len(order) else order
    return code[twice], ref[twice]


def _starts(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.empty(0, np.int64)
    return starts, np.diff(np.append(starts, len(code)))


def _thin(table: pa.Table) -> pa.Table:
    """A part of a bucket without the sets of its hot codes: those are tallied and each hot code is told once."""
    bucket = table.column("bucket")[0].as_py()
    code, ref = _distinct(*_codes_and_refs(table))
    starts, sizes = _starts(code)
    hot = sizes > HOT
    drop = np.repeat(hot, sizes)
    x, n = np.unique(ref[drop], return_counts=True)
    code, ref = np.append(code[~drop], code[starts[hot]]), np.append(ref[~drop], np.full(int(hot.sum()), TOLD))
    rows = len(x) + 1
    return pa.table({
        "kind": pa.array([2] * len(x) + [3], pa.int32()), "a": pa.array([*x.tolist(), None], pa.int64()), "b": pa.array([*x.tolist(), None], pa.int64()), "n": pa.array([*n.tolist(), None], pa.int64()),
        "bucket": pa.array([bucket] * rows, pa.int64()), "code": pa.array([None] * len(x) + [code.tobytes()], pa.binary()),
        "ref": pa.array([None] * len(x) + [ref.astype(np.uint32).tobytes()], pa.binary()), "top": pa.array([None] * len(x) + [(ref >> 32).astype(np.uint8).tobytes()], pa.binary()),
    })


def _meet(table: pa.Table, pivots: bool) -> pa.Table:
    code, ref = _distinct(*_shared(*_codes_and_refs(table)))
    starts, sizes = _starts(code)
    told = np.maximum.reduceat(ref, starts) == TOLD if len(starts) else np.empty(0, bool)
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for size in range(2, HOT + 1):
        at = starts[(sizes == size) & ~told]
        if len(at):
            group = ref[at[:, None] + np.arange(size)]
            i, j = np.triu_indices(size, 1)
            a.append(group[:, i].ravel())
            b.append(group[:, j].ravel())
    x, y, n = _tallied(np.concatenate(a), np.concatenate(b))
    rows = [(np.zeros(len(x)), x, y, n)]
    hot = (sizes > HOT) | told
    if pivots and hot.any():
        pivot, other = np.repeat(ref[starts[hot]], sizes[hot]), ref[np.repeat(hot, sizes)]  # the references of a code are in order
        x, y, n = _tallied(pivot[pivot < other], other[pivot < other])
        rows.append((np.ones(len(x)), x, y, n))
    x, n = np.unique(ref[np.repeat(hot, sizes) & (ref != TOLD)], return_counts=True)
    rows.append((np.full(len(x), 2), x, x, n))
    kind, x, y, n = (np.concatenate(c).astype(np.int64) for c in zip(*rows, strict=True))
    return pa.table({"kind": pa.array(kind.astype(np.int32)), "a": x, "b": y, "n": n})


def _tallied(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs and how often each occurs."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))) if len(a) else np.empty(0, np.int64)
    return a[new], b[new], np.diff(np.append(new, len(a)))


def _bits(codes: int) -> int:
    return max(0, min(31, int(np.ceil(np.log2(max(1, codes / BUCKET_CODES))))))


def _first_meeting(documents: DataFrame, codes: int, sets: int, scratch: Scratch) -> DataFrame:
    bits, parts = _bits(codes), -(-sets // SPLIT)
    bits = max(0, bits - int(np.log2(parts)))  # as many groups as without parts

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [[] for _ in range(parts)], 0
        for b in batches:
            for s in shingle_sets(b.column("text")):
                if len(s):
                    key = _fingerprint(s)[0]
                    for band in _bands(len(s)):
                        code, ref = _sketch(s, band), _ref(key, band)
                        held[ref % parts].append((code, np.full(len(code), ref, np.uint64)))
                        n += len(code)
                if n > 500_000:
                    yield from dealt_parts(held)
                    held, n = [[] for _ in range(parts)], 0
        yield from dealt_parts(held)

    def dealt_parts(held: list[list[tuple[np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        for part, some in enumerate(held):
            if some:
                rows = _dealt(*(list(x) for x in zip(*some, strict=True)), bits)
                yield rows.append_column("part", pa.array([part] * len(rows), pa.int32())) if parts > 1 else rows

    texts = documents.select(documents["text"].alias("text"))
    if parts == 1:
        return scratch.table("met", texts.mapInArrow(deal, DEALT).groupBy("bucket").applyInArrow(lambda t: _meet(t, False), MET))
    thinned = scratch.table("thinned", texts.mapInArrow(deal, f"{DEALT}, part int").groupBy("bucket", "part").applyInArrow(_thin, f"{MET}, {DEALT}"))
    met = thinned.where("kind = 3").select("bucket", "code", "ref", "top").groupBy("bucket").applyInArrow(lambda t: _meet(t, False), MET)
    return scratch.table("met", met.unionAll(thinned.where("kind = 2").select("kind", "a", "b", "n")))


def _central_ref(unshared: float, key: int) -> int:
    """A reference whose order puts sets with fewer unshared codes first: they make the better pivots."""
    return min(254, int(unshared * 256)) << 32 | _ref(key, TOKENS) & 0xFFFFFFFF


def _second_meeting(sets: DataFrame, codes: int, scratch: Scratch) -> DataFrame:
    bits = _bits(codes)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = [mix(np.frombuffer(x, np.uint64) + np.uint64(1)) for x in b.column("codes").to_pylist()]
            refs = [np.full(len(c), k, np.uint64) for c, k in zip(codes, b.column("ref").to_pylist(), strict=True)]
            for lo in range(0, len(codes), 2000):
                yield _dealt(codes[lo : lo + 2000], refs[lo : lo + 2000], bits)

    return scratch.table("met2", sets.select("ref", "codes").mapInArrow(deal, DEALT).groupBy("bucket").applyInArrow(lambda t: _meet(t, True), MET))


def _sets(documents: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = list(shingle_sets(b.column("text")))
            prints = [_fingerprint(c) for c in codes]
            yield pa.RecordBatch.from_arrays([b.column("rep"), pa.array([p[0] for p in prints], pa.int64()), pa.array([p[1] for p in prints], pa.int64()), pa.array([c.tobytes() for c in codes], pa.binary())], names=["rep", "hi", "lo", "codes"])

    found = documents.mapInArrow(run, "rep long, hi long, lo long, codes binary")
    return found.select(F.struct("rep", "hi", "lo").alias("cls"), "codes")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b (classes), shared and all shingles of each pair."""
    one = lambda x: sets.select(F.col("cls").alias(x), F.col("codes").alias(f"codes_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shared, total, last = [], [], (None, None)
            for x, y in zip(b.column("codes_a"), b.column("codes_b"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate((p, q))
                both.sort(kind="stable")
                n = int(np.count_nonzero(both[1:] == both[:-1]))
                shared.append(n)
                total.append(len(both) - n)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(shared, pa.int64()), pa.array(total, pa.int64())], names=["a", "b", "shared", "total"])

    return pairs.join(one("a"), "a").join(one("b"), "b").select("a", "b", "codes_a", "codes_b").mapInArrow(run, f"a {CLASS}, b {CLASS}, shared long, total long")


#: A class of equal sets: its smallest doc_id, which other classes may share, and the set's fingerprint.
CLASS = "struct<rep: bigint, hi: bigint, lo: bigint>"


def _block_links(table: pa.Table) -> pa.Table:
    """Links between two blocks of a pivot's group, as far as they join components.

    Sets that both link with the pivot need no look; by the triangle inequality neither do
    sets whose distances to the pivot are more than a link's distance apart.
    """
    table = table.combine_chunks()
    rep, d, near, part, block = (table.column(c).to_numpy() for c in ("rep", "d", "near", "component", "block"))
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("codes").chunk(0)]
    left, right = np.flatnonzero(block == table.column("x")[0].as_py()), np.flatnonzero(block == table.column("y")[0].as_py())
    size = np.array([len(x) for x in sets])
    flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    order = np.argsort(flat, kind="stable")
    new = np.concatenate(([True], flat[order][1:] != flat[order][:-1]))
    often = np.diff(np.append(np.flatnonzero(new), len(flat)))
    code = np.empty(len(flat), np.int64)
    code[order] = np.where(np.repeat(often > 1, often), np.cumsum(np.repeat(often > 1, often) & new) - 1, -1)
    shared, total = np.zeros((len(left), len(right)), np.float32), int(np.count_nonzero(often > 1))
    for lo in range(0, total, 4096):  # a slice of the codes that occur twice at a time
        some = np.flatnonzero((code >= lo) & (code < lo + 4096))
        has = np.zeros((len(sets), min(4096, total - lo)), np.float32)
        has[row[some], code[some] - lo] = 1
        shared += has[left] @ has[right].T
    union = size[left][:, None] + size[right][None] - shared
    link = (shared * DENOMINATOR >= union * NUMERATOR) & (part[left][:, None] != part[right][None]) & ~(near[left][:, None] & near[right][None])
    link &= np.abs(d[left][:, None] - d[right][None]) <= 1 - NUMERATOR / DENOMINATOR + 1e-9
    parent = {int(p): int(p) for p in np.unique(part)}

    def root(p: int) -> int:
        while parent[p] != p:
            parent[p] = p = parent[parent[p]]
        return p

    found = []
    for i, j in zip(*np.nonzero(link), strict=True):
        a, b = root(int(part[left[i]])), root(int(part[right[j]]))
        if a != b:
            parent[a] = b
            found.append((int(rep[left[i]]), int(rep[right[j]])))
    return pa.table({"u": pa.array([f[0] for f in found], pa.int64()), "v": pa.array([f[1] for f in found], pa.int64())})


def shingle_join(documents: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, n_shingles, component_id of every document.

    Two documents link when their sets of five-word shingles have a Jaccard similarity of
    0.75 or more. Null, empty and wordless texts have no shingles and link with nothing.
    Rows that share a doc_id are one document as far as links go, and each keep their row.
    A row with a null doc_id links with nothing and has a null component_id. Ties need no
    rule: components do not depend on order. Further columns are left out.
    """
    docs = documents.select(documents["doc_id"].cast("long").alias("doc_id"), documents["text"].alias("text"))
    table = scratch.table("sets-of", set_table(docs))
    named = table.where("doc_id is not null and n > 0")
    classes = named.groupBy("hi", "lo").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = scratch.table("classes", classes.select(F.struct("rep", "hi", "lo").alias("cls"), "n", "bands"))
    total, count = classes.agg(F.sum(F.aggregate("bands", F.lit(0).cast("long"), lambda s, x: s + x["parts"])), F.count("*")).first()
    refs = classes.select("cls", "n", F.explode("bands").alias("x")).select("cls", "n", "x.*")

    # by a merge join at every size: the plan, and so its growth, does not change where a side gets too large to broadcast
    firsts = docs.join(classes.select(F.col("cls.rep").alias("rep")).distinct().hint("merge"), F.col("doc_id") == F.col("rep"))
    met = _first_meeting(firsts, total or 0, max(1, count), scratch)
    fits = (F.least("n_a", "n_b") * DENOMINATOR >= F.greatest("n_a", "n_b") * NUMERATOR) & (F.col("a") != F.col("b"))
    losses = F.expr(f"(n_a + n_b) * {DENOMINATOR - NUMERATOR} div {DENOMINATOR + NUMERATOR}")

    def close_pairs(found: DataFrame, of: DataFrame) -> DataFrame:
        """Pairs whose common codes, shared hot ones at best, leave no more differences than a link allows."""
        side = lambda x: of.select(F.col("ref").alias(f"ref_{x}"), F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("parts").alias(f"parts_{x}"), F.col("hot").alias(f"hot_{x}"))
        pairs = found.where("kind = 0").groupBy(F.col("a").alias("ref_a"), F.col("b").alias("ref_b")).agg(F.sum("n").alias("common"))
        pairs = pairs.join(side("a"), "ref_a").join(side("b"), "ref_b")
        pairs = pairs.where(fits & (F.col("common") + F.least("hot_a", "hot_b") >= F.greatest("parts_a", "parts_b") - losses))
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def with_hot(of: DataFrame, found: DataFrame) -> DataFrame:
        lost = found.where("kind = 2").groupBy(F.col("a").alias("ref")).agg(F.sum("n").alias("hot"))
        return of.join(lost, "ref", "left").fillna(0, ["hot"])

    refs = scratch.table("refs", with_hot(refs, met))
    pairs = scratch.table("pairs", close_pairs(met, refs))
    unsettled = scratch.table("unsettled", refs.where("parts - loss - hot < 1").groupBy("cls").agg(F.min((F.col("parts") - F.col("hot")) / F.col("parts")).alias("unshared")))

    involved = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).union(unsettled.select("cls")).distinct()
    texts = docs.join(involved.select(F.col("cls.rep").alias("rep")).distinct().hint("merge"), F.col("doc_id") == F.col("rep"))  # at every size, as above
    sets = scratch.table("sets", _sets(texts.select("rep", "text")).join(involved, "cls", "left_semi").dropDuplicates(["cls"]))

    linked = f"shared * {DENOMINATOR} >= total * {NUMERATOR}"

    def joined(edges: DataFrame, name: str) -> DataFrame:
        return scratch.table(f"parts-{name}", connected_components(edges, scratch, f"steps-{name}"))

    def edges_of(checked: DataFrame, name: str) -> DataFrame:
        return scratch.table(f"edges-{name}", checked.where(linked).select(F.col("a.rep").alias("u"), F.col("b.rep").alias("v")))

    edges = edges_of(_verified(pairs, sets), "first")
    if unsettled.isEmpty():
        parts = joined(edges, "first")
    else:
        ref = F.udf(_central_ref, "long")
        loose = scratch.table("loose", classes.join(unsettled, "cls").select("cls", "n", ref("unshared", "cls.hi").alias("ref")))
        again = sets.join(loose, "cls").select("ref", "codes")
        met2 = _second_meeting(again, loose.agg(F.sum("n")).first()[0], scratch)
        refs2 = scratch.table("refs2", with_hot(loose.select("ref", "cls", "n", F.col("n").alias("parts")), met2))
        losing = F.expr(f"(n + n * {DENOMINATOR} div {NUMERATOR}) * {DENOMINATOR - NUMERATOR} div {DENOMINATOR + NUMERATOR}")
        still = refs2.where(F.col("n") - losing - F.col("hot") < 1).select(F.col("ref").alias("b"))
        around = met2.where("kind = 1").join(still, "b", "left_semi").select(F.col("a").alias("ref_a"), F.col("b").alias("ref_b")).distinct()
        spokes = around.join(refs2.select(F.col("ref").alias("ref_a"), F.col("cls").alias("a")), "ref_a").join(refs2.select(F.col("ref").alias("ref_b"), F.col("cls").alias("b")), "ref_b").where("a != b")
        stars = scratch.table("stars", _verified(spokes.select("a", "b").distinct(), sets))
        edges = edges.union(edges_of(_verified(close_pairs(met2, refs2), sets), "second")).union(edges_of(stars, "stars"))
        parts = joined(edges, "stars")
        # What is still apart around a pivot is compared block by block.
        far = stars.select(F.col("a").alias("pivot"), F.col("b").alias("cls"), F.col("b.rep").alias("rep"), (1 - F.col("shared") / F.col("total")).alias("d"), F.expr(linked).alias("near"))
        far = far.join(parts.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        groups = far.groupBy("pivot").agg(F.count("*").alias("size"), F.count_if(~F.col("near")).alias("loose")).where("loose > 0")
        dealt = far.join(groups.select("pivot", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "pivot").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
        meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("block", j).alias("x"), F.greatest("block", j).alias("y")))
        dealt = dealt.select("pivot", "cls", "rep", "d", "near", "component", "block", F.explode(meets).alias("m")).select("pivot", "m.x", "m.y", "cls", "rep", "d", "near", "component", "block")
        late = scratch.table("late", dealt.join(sets, "cls").drop("cls").groupBy("pivot", "x", "y").applyInArrow(_block_links, "u long, v long"))
        if not late.isEmpty():
            parts = joined(edges.union(late), "late")

    homes = classes.select("cls.hi", "cls.lo", "cls.rep").join(parts.withColumnRenamed("node", "rep"), "rep", "left").select("hi", "lo", F.coalesce("component", "rep").alias("home"))
    placed = named.join(homes, ["hi", "lo"]).select("doc_id", F.col("n").alias("n_shingles"), F.col("home").alias("component_id"))
    if not named.groupBy("doc_id").count().where("count > 1").isEmpty():
        placed = _one_home(placed, scratch)
    alone = table.where("doc_id is null or n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return placed.union(alone)


def _one_home(placed: DataFrame, scratch: Scratch) -> DataFrame:
    """Components joined once more by the doc_ids that stand in several of them."""
    homes = connected_components(placed.select(F.col("doc_id").alias("u"), F.col("component_id").alias("v")), scratch, "shared-ids").select(F.col("node").alias("doc_id"), "component")
    return placed.join(homes, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "component_id").alias("component_id"))
