"""Near-duplicate vectors by an inverted multi-index.

Two codebooks, one for each half of the vectors, form a product grid of cells. Each
vector stays in its own cell and visits the nearest other cells in the order of a
multi-sequence traversal, until the cells left hold less than 1 - target recall of its
neighbours; what meets in a cell is verified by the exact cosine. How far that is, is measured:
some queries are held against all rows. Vectors of different dimension have grids of their own.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from quillboard.llm._graph import connected_components
from quillboard.llm._scratch import Scratch

SAMPLE = 8192
CENTRES = 1024
QUERIES = 256
BINS = 2048  # of a square distance from 0 to 4
CELL = 512
BLOCK = 2048


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _codebook(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's rounds from spread-out starts; deterministic."""
    centres = [x[0]]
    far = ((x - x[0]) ** 2).sum(1)
    while len(centres) < k:
        centres.append(x[int(far.argmax())])
        far = np.minimum(far, ((x - centres[-1]) ** 2).sum(1))
    c = np.array(centres)
    for _ in range(rounds):
        near = (-2 * x @ c.T + (c**2).sum(1)).argmin(1)
        for j in np.unique(near):
            c[j] = x[near == j].mean(0)
    return c


def _walls(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Home centre of each row, and the squared distance to the wall of each other centre's region."""
    d = (x**2).sum(1)[:, None] - 2 * x @ c.T + (c**2).sum(1)
    home = d.argmin(1)
    gap = np.sqrt(((c[:, None] - c[None]) ** 2).sum(2))[home]
    wall = np.divide(d - d[np.arange(len(x)), home][:, None], 2 * gap, out=np.zeros_like(d), where=gap > 0)
    return home, np.maximum(wall, 0) ** 2


class Grid:
    """Codebooks of the two halves, fitted on a bounded sample, and the reach of a visit."""

    def __init__(self, sample: np.ndarray, rows: int):
        x = _unit(sample.astype(np.float64))
        self.half = x.shape[1] // 2
        k = int(np.clip(np.ceil(np.sqrt(rows / CELL)), 1, CENTRES))
        self.books = [_codebook(p, max(1, min(k, len(p) // 8))) if p.shape[1] else np.zeros((1, 0)) for p in (x[:, : self.half], x[:, self.half :])]
        self.reach = 0.0

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Square distance from each x to the walls of the cell of each y."""
        _, (w1, w2) = self.place(x)
        (h1, h2), _ = self.place(y)
        return w1[:, h1] + w2[:, h2]

    def place(self, x: np.ndarray) -> tuple[tuple, tuple]:
        (h1, w1), (h2, w2) = _walls(x[:, : self.half], self.books[0]), _walls(x[:, self.half :], self.books[1])
        return (h1, h2), (w1, w2)

    def visits(self, w1: np.ndarray, w2: np.ndarray) -> list[int]:
        """Cells in the order of their distance, the home cell first, as far as the reach."""
        o1, o2, n = np.argsort(w1, kind="stable"), np.argsort(w2, kind="stable"), len(w2)
        out, heap, pushed = [], [(0.0, 0, 0)], {(0, 0)}
        while heap:
            far, i, j = heapq.heappop(heap)
            if far > self.reach:
                break
            out.append(int(o1[i]) * n + int(o2[j]))
            for a, b in ((i + 1, j), (i, j + 1)):
                if a < len(o1) and b < n and (a, b) not in pushed:
                    pushed.add((a, b))
                    heapq.heappush(heap, (float(w1[o1[a]] + w2[o2[b]]), a, b))
        return out


def _fit_grids(classes: DataFrame, cosine: float, recall: float) -> dict[int, Grid]:
    """A grid for each dimension: codebooks of a sample, the reach of sampled queries against all rows.

    The driver gets at most SAMPLE vectors and one histogram for each dimension.
    """
    sizes = dict(classes.groupBy("width").count().collect())
    first = Window.partitionBy("width").orderBy(F.xxhash64("key"), "rep")
    picked = classes.select("width", "label", "key", "rep", "v", F.row_number().over(first).alias("at")).where(F.col("at") <= SAMPLE)
    rows = sorted(picked.select("width", "at", F.col("label").cast("string").alias("label"), "rep", "v").collect(), key=lambda r: (r["width"], r["at"]))
    grids, queries = {}, {}
    for width in sizes:
        mine = [r for r in rows if r["width"] == width]
        grids[width] = Grid(np.array([r["v"] for r in mine], np.float64), sizes[width])
        some = mine[:QUERIES]
        queries[width] = (_unit(np.array([r["v"] for r in some], np.float64)), np.array([r["label"] for r in some]), np.array([r["rep"] for r in some]))

    def met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, np.ndarray] = {}
        for b in batches:
            for width, some in b.groupby("width"):
                q, labels, reps = queries[width]
                for lo in range(0, len(some), 2048):
                    part = some.iloc[lo : lo + 2048]
                    x = _unit(np.array(part["v"].tolist(), np.float64))
                    near = (q @ x.T >= cosine) & (labels[:, None] == part["label"].to_numpy()[None]) & (reps[:, None] != part["rep"].to_numpy()[None])
                    i, j = np.nonzero(near)
                    if len(i):
                        use = np.unique(j)
                        far = grids[width].apart(q, x[use])[i, np.searchsorted(use, j)]
                        tally = np.bincount(np.minimum((far / 4 * BINS).astype(int), BINS - 1), minlength=BINS)
                        seen[width] = seen.get(width, 0) + tally
        for width, tally in seen.items():
            at = np.flatnonzero(tally)
            yield pd.DataFrame({"width": width, "bin": at, "n": tally[at]})

    tallies = classes.select("width", F.col("label").cast("string").alias("label"), "rep", "v").mapInPandas(met, "width int, bin int, n long").groupBy("width", "bin").agg(F.sum("n").alias("n")).collect()
    for width, grid in grids.items():
        mine = sorted((r["bin"], r["n"]) for r in tallies if r["width"] == width)
        upto, total, needed = 0, sum(n for _, n in mine), 0.0
        for at, n in mine:
            upto += n
            needed = 4 * (at + 1) / BINS
            if upto >= recall * total:
                break
        floor = 9 * (2 - 2 * cosine) / width
        grid.reach = max(needed, floor)
    return grids


def near_vectors(embeddings: DataFrame, scratch: Scratch, cosine: float = 0.98, recall: float = 0.999) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Rows link when their labels are equal and not null, their dimensions are equal and their
    cosine in double precision is at least ``cosine``. Vectors that are null, zero, or hold
    null or non-finite parts link with nothing, nor do rows with a null vec_id (their
    component_id is null). Each repeated row is another vector. The grids are fitted on at
    most SAMPLE rows of a dimension; all rows are indexed. Equal vectors are collapsed
    first, and cells of more than BLOCK rows are compared block by block. Beyond
    CENTRES * CENTRES * CELL vectors of a dimension, cells grow with the table.
    """
    kind = dict(embeddings.dtypes)["embedding"]
    kind = kind if kind == "array<float>" else "array<double>"
    raw = embeddings.select(embeddings["vec_id"].cast("long").alias("vec_id"), embeddings["label"].alias("label"), embeddings["embedding"].cast(kind).alias("v"))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    good = F.coalesce(usable & finite, F.lit(False))
    keyed = raw.select("vec_id", "label", F.when(good, F.md5(F.col("v").cast("string"))).alias("key"), "v")
    classes = keyed.where("key is not null").groupBy("label", "key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"), F.first("v").alias("v"))
    classes = scratch.table("classes", classes.withColumn("width", F.size("v")))
    alone = keyed.where("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    grids = _fit_grids(classes, cosine, recall)
    if not grids:
        return alone
    label_kind = dict(classes.dtypes)["label"]

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for width, some in b.groupby("width"):
                grid = grids[width]
                x = _unit(np.array(some["v"].tolist(), np.float64))
                (h1, h2), (w1, w2) = grid.place(x)
                cells = [grid.visits(p, q) for p, q in zip(w1, w2, strict=True)]
                home = h1 * len(grid.books[1]) + h2
                cells = [[h, *(c for c in cs if c != h)] for h, cs in zip(home.tolist(), cells, strict=True)]
                out = some.assign(home=home, visits=cells)
                out["cell"] = cells
                yield out.explode("cell")[["label", "width", "cell", "home", "visits", "rep", "size", "v"]].astype({"cell": "int32"})

    routed = classes.select("label", "width", "rep", "size", "v").mapInPandas(route, f"label {label_kind}, width int, cell int, home int, visits array<int>, rep long, size long, v {kind}")
    # a cell's key tells dimensions apart
    routed = scratch.table("routed", routed.withColumn("label", F.struct("label", "width")).drop("width"))
    split = routed.where("cell = home").groupBy("label", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n"))
    dealt = routed.join(split, ["label", "cell"]).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("n")).cast("int"))
    # A vector at home meets its cell's other parts; a visitor meets each part once.
    others = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda j: F.when(F.col("cell") == F.col("home"), F.struct(F.least("part", j).alias("a"), F.greatest("part", j).alias("b"))).otherwise(F.struct(j.alias("a"), j.alias("b"))))
    dealt = dealt.withColumn("pair", F.explode(others)).select("label", "cell", "pair.a", "pair.b", "part", "home", "visits", "rep", "size", "v")

    def meet(g: pd.DataFrame) -> pd.DataFrame:
        cell, a, b = int(g["cell"].iloc[0]), int(g["a"].iloc[0]), int(g["b"].iloc[0])
        at_home = (g["home"] == cell).to_numpy()
        x = _unit(np.array(g["v"].tolist(), np.float64))
        part, rep, size, home = g["part"].to_numpy(), g["rep"].to_numpy(), g["size"].to_numpy(), g["home"].to_numpy()
        left, right = np.flatnonzero(at_home & (part == a)), np.flatnonzero(at_home & (part == b))
        links, edges = np.zeros(len(g), np.int64), []

        def compare(l, r, same, allowed=None):
            for lo in range(0, len(l), 1024):
                some = l[lo : lo + 1024]
                hit = x[some] @ x[r].T >= cosine
                if same:
                    hit &= np.arange(len(r))[None] > np.arange(lo, lo + len(some))[:, None]
                if allowed is not None:
                    hit &= allowed[lo : lo + 1024]
                links[some] += hit @ size[r]
                np.add.at(links, r, size[some] @ hit)
                i, j = _joined(hit)
                edges.extend(zip(rep[some[i]].tolist(), rep[r[j]].tolist(), strict=True))

        compare(left, right, a == b)
        if a == b:
            guests = np.flatnonzero(~at_home)
            if len(guests) and len(left):
                # A pair whose vectors visit each other's cell counts in the greater cell only.
                theirs = [set(v) for v in g["visits"].iloc[left]]
                from_cells = np.unique(home[guests])
                back = {int(c): np.array([c in s for s in theirs]) for c in from_cells}
                allowed = np.array([(home[k] < cell) | ~back[int(home[k])] for k in guests])
                compare(guests, left, False, allowed)
        out = pd.DataFrame({"u": rep, "v": rep, "links": links})
        more = pd.DataFrame(edges, columns=["u", "v"]).drop_duplicates().assign(links=0) if edges else out.iloc[:0]
        return pd.concat([out[out["links"] > 0], more])

    met = scratch.table("met", dealt.groupBy("label", "cell", "a", "b").applyInPandas(meet, "u long, v long, links long"))
    links = met.where("links > 0").groupBy(F.col("u").alias("rep")).agg(F.sum("links").alias("more"))
    parts = connected_components(met.where("u != v").select("u", "v"), scratch).withColumnRenamed("node", "rep")
    home = classes.select("label", "key", "rep", "size").join(links, "rep", "left").join(parts, "rep", "left")
    home = home.select("label", "key", (F.col("size") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    found = keyed.where("key is not null").select("vec_id", "label", "key").join(home, ["label", "key"]).select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    return found.union(alone)


def _joined(hit: np.ndarray) -> tuple[list[int], list[int]]:
    """Of the links of a block, a spanning forest: it joins the same rows and columns."""
    rows, columns, out_i, out_j = hit.any(1), np.zeros(hit.shape[1], bool), [], []
    while rows.any():
        front = np.array([int(rows.argmax())])
        rows[front] = False
        while len(front):
            new = np.flatnonzero(hit[front].any(0) & ~columns)
            if not len(new):
                break
            columns[new] = True
            out_i.extend(front[hit[np.ix_(front, new)].argmax(0)].tolist())
            out_j.extend(new.tolist())
            front = np.flatnonzero(hit[:, new].any(1) & rows)
            rows[front] = False
            out_i.extend(front.tolist())
            out_j.extend(new[hit[np.ix_(front, new)].argmax(1)].tolist())
    return out_i, out_j
