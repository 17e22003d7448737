"""Quality classifier by co-training on two views of a document.

One classifier sees the text alone: hashed one- and two-word grams, ratios of words and
characters, and how the lines lie. The other sees the page's metadata alone: source,
language and declared length. Over a few rounds each scores all documents and names those
without a label that it is surest of, as far as its answers on held-out labels are right, and
the other learns from them. Both scores are then calibrated on labelled documents that neither learned from, and combined to score every
document.

The classifiers are fitted on bounded samples: ``labelled`` rows of the labels by the hash of
the doc_id, and in a round ``each`` of the surest documents of each view and class. The
surest ones are sought among all documents; features and scores cover all rows.
"""

from __future__ import annotations

import heapq
import math
import operator
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from quillboard.llm._arrow import mix, utf8, word_hashes
from quillboard.llm._scratch import Scratch

LABELLED = 6000
EACH = 300
ROUNDS = 3
SURE = 0.97  # precision on held-out rows that a view's pseudo-labels must have
LEAST_HELD = 20  # held-out rows that such a precision rests on
RATIO_RIDGE, GRAM_RIDGE = 1.0, 50.0
GRAM_BITS = 8  # of the buckets that word grams are hashed to
SOURCE_BINS = 32
DIGITS, UPPER, MARKS = b"0123456789", bytes(range(65, 91)), bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"!?()-")
STOPS = re.compile(r"[.!?](?:\s|$)")


def text_view(text: str) -> list[float]:
    """Ratios of the words, characters and lines of one text."""
    raw, words, sizes = text.encode(), text.split(), list(map(len, text.split("\n")))
    n, size = max(1, len(words)), max(1, len(raw))
    lengths = list(map(len, words))
    marks = size - len(raw.translate(None, MARKS))
    marked = sum(1 for w in words if not w[-1].isalnum() and w[-1] not in ".,;:'\"!?)")
    return [
        math.log1p(len(words)),
        sum(lengths) / n,
        sum(1 for x in lengths if x <= 3) / n,
        sum(1 for x in lengths if x >= 15) / n,
        len(set(words)) / n,
        len(set(words)) / math.sqrt(n),
        sum(map(operator.eq, words, words[1:])) / n,
        sum(map(operator.eq, words, words[2:])) / n,
        marks / size,
        marked / n,
        (size - len(raw.translate(None, DIGITS))) / size,
        (size - len(raw.translate(None, UPPER))) / size,
        len(STOPS.findall(text)) / n,
        len(zlib.compress(raw, 1)) / size if len(raw) <= 1 << 16 else _ratio(raw),
        math.log1p(len(sizes)),
        math.log1p(max(sizes)),
        sum(sizes) / len(sizes) / 100,
        sum(1 for x in sizes if x < 20) / len(sizes),
    ]


def _ratio(raw: bytes) -> float:
    """Compressed share of a long text, block by block."""
    return sum(len(zlib.compress(raw[lo : lo + (1 << 16)], 1)) for lo in range(0, len(raw), 1 << 16)) / len(raw)


def meta_view(lang: str | None, source: str | None, n_chars: float | None) -> list[float]:
    """What is known of a page without its text: origin, language and declared length (-1 where there is none)."""
    out = [0.0] * (SOURCE_BINS + 8)
    out[zlib.crc32((source or "").encode()) % SOURCE_BINS] = 1.0
    out[SOURCE_BINS + zlib.crc32((lang or "").encode()) % 8] = 1.0
    known = n_chars is not None and n_chars >= 0
    return [*out, math.log1p(n_chars) if known else -1.0, math.log1p(n_chars) ** 2 if known else 0.0]


def gram_view(column: pa.Array) -> np.ndarray:
    """A byte for each bucket of one- and two-word grams: the root of its share of a text's grams."""
    words, bounds = word_hashes(*utf8(column))
    row = np.repeat(np.arange(len(column)), np.diff(bounds))
    pair = np.flatnonzero(row[1:] == row[:-1])
    grams = np.concatenate((words, mix(words[pair] * np.uint64(3) + words[pair + 1])))
    rows, width = np.concatenate((row, row[pair])), 1 << GRAM_BITS
    counts = np.bincount(rows * width + (grams >> np.uint64(64 - GRAM_BITS)).astype(np.int64), minlength=len(column) * width).reshape(-1, width)
    return np.round(255 * np.sqrt(counts / np.maximum(1, counts.sum(1, keepdims=True)))).astype(np.uint8)


def features(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grams, text ratios and metadata of some rows with text, lang, source and n_chars."""
    texts = [t or "" for t in b.column("text").to_pylist()]
    ratios = np.array([text_view(t) for t in texts], np.float32).reshape(len(texts), -1)
    meta = zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), b.column("n_chars").to_pylist(), strict=True)
    return gram_view(b.column("text")), ratios, np.array([meta_view(*x) for x in meta], np.float32).reshape(len(texts), -1)


def _text_matrix(grams: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """Ratios, their roots (extremes on either side can both be bad) and grams."""
    x = ratios.astype(np.float64)
    return np.hstack([x, np.sign(x) * np.sqrt(np.abs(x)), grams.astype(np.float64)])


@dataclass
class Logistic:
    """Logistic regression on standardised features, by Newton's steps."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float | np.ndarray = 1.0) -> Logistic:
        mean, scale = x.mean(0), x.std(0)
        scale = np.where(scale > 1e-12, scale, 1.0)
        z = np.hstack([np.clip((x - mean) / scale, -8, 8), np.ones((len(x), 1))])
        w, keep = np.zeros(z.shape[1]), np.append(np.broadcast_to(ridge, x.shape[1]), 1e-6)
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(keep), z.T @ (y - p) - keep * w)
            w = w + step
            if np.abs(step).max() < 1e-6:
                break
        return cls(mean, scale, w)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights[:-1] + self.weights[-1]


def _sure(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class CoTrained:
    text: Logistic
    meta: Logistic
    combine: Logistic

    def score(self, grams: np.ndarray, ratios: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = np.clip(self.text.logit(_text_matrix(grams, ratios)), -20, 20), np.clip(self.meta.logit(meta.astype(np.float64)), -20, 20)
        return _sure(a), _sure(b), _sure(self.combine.logit(np.column_stack([a, b])))


FEATURES = "key long, doc_id long, grams binary, ratios array<float>, meta array<float>"


def feature_table(documents: DataFrame) -> DataFrame:
    """key (a hash of doc_id and text), doc_id and the features of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, len(b), 1000):
                some = b.slice(lo, 1000)
                grams, ratios, meta = features(some)
                columns = [some.column("key"), some.column("doc_id"), pa.array([g.tobytes() for g in grams], pa.binary()), pa.array(list(ratios), pa.list_(pa.float32())), pa.array(list(meta), pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "doc_id", "grams", "ratios", "meta"])

    return _inputs(documents).mapInArrow(run, FEATURES)


def _unpacked(b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    grams = np.frombuffer(b"".join(b["grams"]), np.uint8).reshape(len(b), -1)
    return grams, np.array(b["ratios"].tolist(), np.float32), np.array(b["meta"].tolist(), np.float32)


def _sure_from(p: np.ndarray, y: np.ndarray) -> dict[int, float]:
    """For each class, how sure a view must be for SURE of its held-out answers to be right; absent where it never is."""
    out = {}
    for c in (0, 1):
        mine = np.flatnonzero((p >= 0.5) == bool(c))
        sure = np.maximum(p[mine], 1 - p[mine])
        order = np.argsort(-sure, kind="stable")
        right = np.cumsum(y[mine][order] == c) / np.arange(1, len(mine) + 1)
        good = np.flatnonzero((right >= SURE) & (np.arange(1, len(mine) + 1) >= LEAST_HELD))
        if len(good):
            out[c] = float(sure[order][good[-1]])
    return out


def _surest(table: DataFrame, labels: DataFrame, models: list[Logistic], floors: list[dict[int, float]], used: set[int], each: int) -> pd.DataFrame:
    """Of all documents, those that each view is surest of, ``each`` for each view and class at most; those with a label go.

    Tasks send their own surest rows only, so the features themselves are never shuffled.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[tuple[int, int], list] = {}
        for b in batches:
            if not len(b):
                continue
            grams, ratios, meta = _unpacked(b)
            keys = b["key"].to_numpy()
            for view, x in enumerate((_text_matrix(grams, ratios), meta.astype(np.float64))):
                p = _sure(models[view].logit(x))
                sure = np.maximum(p, 1 - p)
                at = np.flatnonzero(sure >= np.where(p >= 0.5, floors[view].get(1, 2.0), floors[view].get(0, 2.0)))
                for i in at[np.argsort(-sure[at], kind="stable")][: 2 * each].tolist():
                    if int(keys[i]) not in used:
                        heap = best.setdefault((view, int(p[i] >= 0.5)), [])
                        item = (float(sure[i]), int(keys[i]), b["doc_id"].iloc[i], b["grams"].iloc[i], ratios[i], meta[i])
                        if len(heap) < each or item[:2] > heap[0][:2]:
                            heapq.heappush(heap, item)
                            if len(heap) > each:
                                heapq.heappop(heap)
        rows = [(view, y, *item) for (view, y), heap in best.items() for item in heap]
        if rows:
            yield pd.DataFrame(rows, columns=["view", "y", "sure", "key", "doc_id", "grams", "ratios", "meta"]).astype({"doc_id": "Int64"})

    found = table.mapInPandas(run, "view int, y int, sure double, key long, doc_id long, grams binary, ratios array<float>, meta array<float>")
    found = found.join(labels.select("doc_id"), "doc_id", "left_anti").drop("doc_id")
    order = (F.desc("sure"), F.col("key"))
    some = Window.partitionBy("view", "y", F.pmod("key", F.lit(256))).orderBy(*order)  # the surest of parts first
    found = found.withColumn("at", F.row_number().over(some)).where(F.col("at") <= each)
    return found.withColumn("at", F.row_number().over(Window.partitionBy("view", "y").orderBy(*order))).where(F.col("at") <= each).toPandas()


def fit_quality(table: DataFrame, labels: DataFrame, labelled: int = LABELLED, each: int = EACH, rounds: int = ROUNDS) -> CoTrained | float:
    """The trained model, or where the labels know one class only, its constant score.

    The driver reads the features of ``labelled`` labelled rows at most, and in a round of
    4 * ``each`` others. Labels that are null are no labels; a document with several takes
    the least. Every third labelled row is held out to calibrate and combine.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.least(F.greatest(F.min("quality"), F.lit(0)), F.lit(1)).cast("int").alias("y"))
    here = known.join(table.select("doc_id").distinct(), "doc_id", "left_semi")
    picked = here.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    got = table.join(F.broadcast(picked), "doc_id").toPandas().sort_values(["doc_id", "key"]).drop_duplicates("doc_id")  # bounded by labelled
    y = got["y"].to_numpy(float)
    if len(set(y)) < 2:
        return float(y.mean()) if len(y) else 1.0
    got = got.iloc[np.random.default_rng(7).permutation(len(got))]
    y, (grams, ratios, meta) = got["y"].to_numpy(float), _unpacked(got)
    views = [_text_matrix(grams, ratios), meta.astype(np.float64)]
    held = np.arange(len(y)) % 3 == 0
    if len(y) < 30 or len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.ones(len(y), bool)
    learn = ~held if not held.all() else held
    xs, ys = [[v[learn]] for v in views], [[y[learn]] for _ in views]

    ridges = (np.append(np.full(2 * ratios.shape[1], RATIO_RIDGE), np.full(grams.shape[1], GRAM_RIDGE)), RATIO_RIDGE)

    def fit() -> list[Logistic]:
        return [Logistic.fit(np.vstack(x), np.concatenate(t), ridge) for x, t, ridge in zip(xs, ys, ridges, strict=True)]

    models, used = fit(), set()
    for _ in range(rounds):
        named = _surest(table, known, models, [_sure_from(_sure(m.logit(v[held])), y[held]) for m, v in zip(models, views, strict=True)], used, each)
        if not len(named):
            break
        for view in (0, 1):  # what one view is sure of, the other learns
            mine = named[named["view"] == view]
            if len(mine):
                grams, ratios, meta = _unpacked(mine)
                xs[1 - view].append(meta.astype(np.float64) if view == 0 else _text_matrix(grams, ratios))
                ys[1 - view].append(mine["y"].to_numpy(float))
        used |= set(named["key"].tolist())
        models = fit()
    both = np.column_stack([np.clip(m.logit(v[held]), -20, 20) for m, v in zip(models, views, strict=True)])
    return CoTrained(*models, Logistic.fit(both, y[held]))


def _inputs(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.xxhash64(documents["doc_id"].cast("long"), documents["text"]).alias("key"), documents["doc_id"].cast("long").alias("doc_id"), documents["text"].alias("text"), documents["lang"].alias("lang"), documents["source"].alias("source"), documents["n_chars"].cast("double").alias("n_chars")
    )


def quality_scores(documents: DataFrame, labels: DataFrame, scratch: Scratch, threshold: float = 0.5, keep: bool = False, **bounds: int) -> DataFrame:
    """doc_id, text_score, meta_score, quality_score, accepted of every document.

    ``keep`` gives the accepted documents with their own columns instead. Null texts are
    empty, null sources and languages are classes of their own, as is a null n_chars. Null
    and repeated doc_ids are scored like others. Without labels of both classes all
    documents have the share of good labels as their score (1 without any).
    """
    table = scratch.table("features", feature_table(documents))
    model = fit_quality(table, labels, **bounds)

    def scored(grams: np.ndarray, ratios: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if isinstance(model, float):
            return (np.full(len(grams), model),) * 3
        return model.score(grams, ratios, meta)

    if keep:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for lo in range(0, len(b), 1000):
                    some = b.slice(lo, 1000)
                    seen = features(some.select(["text", "lang", "source", "n_chars"]))
                    yield some.filter(pa.array(scored(*seen)[2] >= threshold))

        return documents.mapInArrow(run, documents.schema)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                t, m, q = scored(*_unpacked(b))
                yield pd.DataFrame({"doc_id": b["doc_id"], "text_score": t, "meta_score": m, "quality_score": q, "accepted": q >= threshold})

    return table.mapInPandas(score, "doc_id long, text_score double, meta_score double, quality_score double, accepted boolean")
