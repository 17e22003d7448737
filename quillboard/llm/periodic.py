"""Runs of words that repeat with a period, found by recursive frequency splitting.

Every word of a run of three periods stands in it three times. So a word that stands fewer
times in a segment can be in none of its runs and splits the segment; parts too short for
a run go, and what is left is split again until nothing changes. In prose that leaves next
to nothing; the segments that survive are scanned for lags.

The scan needs no look at every lag: within a run, a window of w words, period <= w < 2 *
period, comes again after exactly one period and no sooner. For each power of two w, windows
are named by pairs of names of half the width (exact, no hashes), each is compared with
its next equal, and stretches of windows with one lag are the runs: the next equal window
proves the period, its being the next proves that no smaller one holds. Windows that stand
once are not looked at again, so the work is n log n at worst and far less on prose.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillboard.llm._arrow import chunks, utf8
from quillboard.llm._words import codes, cut

LEAST, TIMES = 24, 3


def _named(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each key: a number for its value, how often it occurs, and the index of its next equal (-1: none)."""
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    new = np.ones(len(key), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    group = np.cumsum(new) - 1
    name, times, following = np.empty(len(key), np.int64), np.empty(len(key), np.int64), np.full(len(key), -1)
    name[order], times[order] = group, np.bincount(group)[group] if len(key) else group
    same = np.flatnonzero(~new)
    following[order[same - 1]] = order[same]
    return name, times, following


def surviving(words: np.ndarray, rows: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words in segments where each word is frequent enough, and their segments.

    ``rows`` (ascending) tells which text a word is of. Segments that a pass leaves alone are
    stable and are not looked at again.
    """
    place, segment, stable = np.arange(len(words)), rows, [(np.empty(0, np.int64), np.empty(0, np.int64))]
    kinds, made = int(words.max(initial=0)) + 1, 0
    while len(place):
        # consecutive places of one segment, of enough words
        new = np.ones(len(place), bool)
        new[1:] = (segment[1:] != segment[:-1]) | (place[1:] != place[:-1] + 1)
        number = np.cumsum(new) - 1
        long = (np.bincount(number) >= least)[number]
        place, number = place[long], number[long]
        _, often, _ = _named(number * kinds + words[place])
        rare = often < times
        touched = np.zeros(int(number.max(initial=-1)) + 1, bool)
        touched[number[rare]] = True
        rest = ~touched[number]
        stable.append((place[rest], made + number[rest]))
        made += len(touched)
        again = ~rest & ~rare
        place, segment = place[again], number[again]
    place, segment = map(np.concatenate, zip(*stable, strict=True))
    order = np.argsort(place, kind="stable")
    return place[order], segment[order]


def lag_scan(words: np.ndarray, place: np.ndarray, segment: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Runs (start place, length, period) of the segments, in order of start and period."""
    runs = [np.empty((0, 3), np.int64)]
    if not len(place):
        return runs[0]
    number = np.cumsum(np.concatenate(([True], (segment[1:] != segment[:-1]) | (place[1:] != place[:-1] + 1)))) - 1
    size = np.bincount(number)
    name, _, _ = _named(number * (int(words.max()) + 1) + words[place])  # names tell segments apart
    at, width, head = np.arange(len(place)), 1, 1
    while head * 2 <= max(1, least // times):
        head *= 2  # the first width that is scanned: all smaller lags with it
    while True:
        if width >= head:
            _, _, following = _named(name[at])
            lag = np.where(following >= 0, at[following] - at, 0)
            fit = (lag > (width // 2 if width > head else 0)) & (lag <= width)
            i, q = at[fit], lag[fit]
            if len(i):
                new = np.concatenate(([True], (i[1:] != i[:-1] + 1) | (q[1:] != q[:-1])))
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(i)) - 1
                length, q = i[last] - i[first] + width + q[first], q[first]
                good = length >= np.maximum(least, times * q)
                runs.append(np.stack([place[i[first]], length, q], 1)[good])
        # Windows twice as wide: of two neighbours that both occur again, in segments long enough.
        wide = size >= times * (width + 1 if width >= head else 1)
        at = at[wide[number[at]]]
        beyond = at + width
        ok = beyond < len(place)
        at, beyond = at[ok], beyond[ok]
        ok = (name[beyond] >= 0) & (number[beyond] == number[at])
        at, beyond = at[ok], beyond[ok]
        if not len(at):
            break
        kinds = int(name[at].max()) + 1
        # Names of pairs; what occurs once gets none.
        key, often, _ = _named(name[at] + kinds * name[beyond])
        name = np.full(len(place), -1)
        at = at[often > 1]
        name[at] = key[often > 1]
        width *= 2
    found = np.concatenate(runs)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def runs_of(data: np.ndarray, offsets: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Of some rows of text: words, runs (start, length, period) with their n + 1 bounds, and the kept words joined by one space."""
    words, bounds = cut(data, offsets, spaced=True)
    word = codes(words)[0]
    counts = np.diff(bounds)
    runs = lag_scan(word, *surviving(word, np.repeat(np.arange(len(counts)), counts), least, times), least, times)
    dropped = np.zeros(len(word) + 1, np.int64)
    np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
    np.add.at(dropped, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(dropped[:-1]) == 0
    left = words if kept.all() else words.filter(pa.array(kept))
    row_bounds = np.concatenate(([0], np.cumsum(kept)))[bounds]
    at = np.frombuffer(left.buffers()[1], np.int64)[left.offset : left.offset + len(left) + 1][row_bounds] if len(left) else np.zeros(len(bounds), np.int64)
    raw = memoryview(left.buffers()[2]) if len(left) else memoryview(b"")
    texts = [bytes(raw[s : max(s, e - 1)]) for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    of_row = np.searchsorted(runs[:, 0], bounds)
    own = runs.copy()
    own[:, 0] -= np.repeat(bounds[:-1], np.diff(of_row))
    return counts, own, of_row, texts


def periodic_runs(documents: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, n_words, runs, collapsed of each whole text.

    Words are what stands between white space. ``runs``: start (word number), length and
    period of each stretch of words with smallest period p and at least ``max(least, times
    * p)`` words that no neighbouring word extends, by start and period; ``times`` is two
    or more, ``least`` at least eight times its half. ``collapsed``: the words joined by one
    space, without those that stand in a run after its first period.

    Null and empty texts, and those of white space, have no words, no runs and an empty
    collapsed text. Null and repeated doc_ids are rows of their own, an empty table gives
    an empty result, and further columns are left out, so their names cannot clash. A very
    long text is worked on whole, in memory of some times its size.
    """
    if times < 3 or least < times:
        raise ValueError("runs are of three periods at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for b in batches:
            data, offsets = utf8(b.column("text"))
            for lo, hi in chunks(offsets, 1 << 21):
                counts, runs, bounds, texts = runs_of(data, offsets[lo : hi + 1], least, times)
                spans = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in range(3)], fields=list(kind))
                columns = [b.column("doc_id")[lo:hi], pa.array(counts), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), spans), pa.array(texts, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    source = documents.select(documents["doc_id"].cast("long").alias("doc_id"), documents["text"].alias("text"))
    return source.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def looped(documents: DataFrame) -> DataFrame:
    """doc_id, text, where a tenth of the texts ends in a loop of its own words, as digits of the doc_id's crc32 say.

    With h that crc32 and g = h div 10, texts with h % 10 = 0 and n > 0 words repeat, from
    word a = g % n on, the p = 1 + (n - a) div (3 + g % 8) words that begin there. A null
    doc_id or text stays as it is.
    """
    h = F.crc32(documents["doc_id"].cast("string"))
    split = documents.select(documents["doc_id"].alias("doc_id"), documents["text"].alias("text"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, F.regexp_extract_all(documents["text"], F.lit(r"([^\x20\x09-\x0D]+)"))).alias("words"))
    split = split.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    again = F.expr("concat_ws(' ', transform(sequence(0, n - 1), i -> get(words, cast(if(i < a, i, a + (i - a) % p) as int))))")
    return split.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))


def run_digest(documents: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of the greatest length for its period, digests of all runs and of the collapsed text: see periodic_runs.

    Exponents are compared as fractions; the first of equal ones by start and period is given.
    """
    found = periodic_runs(documents)
    better = "best is null or r.length * best.period > best.length * r.period"
    best = F.expr(f"aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (best, r) -> if({better}, r, best))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    found = found.select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return found.select("doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
