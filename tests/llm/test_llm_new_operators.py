"""Periodic runs, source divergence and shards against plain versions."""

import hashlib
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillboard.llm import divergence, periodic, sharding
from quillboard.llm._scratch import Scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, runs string, part string, shard string, value string, row string"
WORDS = "ash bee cat dog elm fox gnu hen ivy jay kid law map nut oak pig rat sea tea urn ünï Σ".split()


def prose(seed, n, kinds=len(WORDS)):
    r = np.random.default_rng(seed)
    return " ".join(WORDS[k] for k in r.integers(0, kinds, n))


LOOP = prose(7, 40)
TEXTS = [None, "", " \n\t ", "one", "a " * 24, "a " * 23, "a b\n" * 60 + "tail", prose(1, 30) + " " + " ".join([LOOP] * 3), " ".join([LOOP] * 4) + " " + prose(2, 50), " ".join([LOOP] * 3)[:-4], prose(3, 400, 2), prose(4, 600, 3), prose(5, 9000), "x" * 80000 + " y", "q r q q r q " * 9 + LOOP + " z z z" * 30, ("a b " * 12 + "c ") * 5]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, ["en", "de", None][k % 3], f"s{k % 4}" if k % 5 else None, len(t) if t else None, *["clash"] * 6) for k, t in enumerate(TEXTS)]
    more = [(100 + k, prose(k, 200), "en", f"s{k % 4}", 0, *["clash"] * 6) for k in range(60)]
    return spark.createDataFrame([*rows, *more, rows[8], rows[8], (None, LOOP, *[None] * 9), (None, LOOP, *[None] * 9)], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


def plain_runs(w, least=24, times=3):
    """Longest stretches for each lag, without those that a smaller period has."""
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(least, times * q):
                found.setdefault((s, i + q - s), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_periodic_runs(docs):
    rows = periodic.periodic_runs(docs).collect()
    assert len(rows) == docs.count()
    seen = 0
    for r in rows:
        w = words(LOOP if r["doc_id"] is None else TEXTS[r["doc_id"]] if r["doc_id"] < 100 else prose(r["doc_id"] - 100, 200))
        want = plain_runs(w)
        seen += len(want)
        assert (r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) == (len(w), want, collapsed(w, want))
    assert seen > 12
    assert periodic.periodic_runs(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, 24, 2)


def test_periodic_runs_of_random_words():
    r = np.random.default_rng(11)
    texts = []
    for k in range(150):
        loop = r.integers(0, 1 + k % 6, int(r.integers(1, 30)))
        w = np.concatenate([r.integers(0, 1 + k % 6, int(r.integers(0, 40))), np.tile(loop, int(r.integers(1, 7))), r.integers(0, 3, int(r.integers(0, 30)))])
        w[r.integers(0, len(w), len(w) // 60)] = 9
        texts.append(" ".join(map(str, w)).encode())
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    for least, times in ((24, 3), (30, 4), (12, 3)):
        counts, runs, bounds, left = periodic.runs_of(np.frombuffer(b"".join(texts), np.uint8), offsets, least, times)
        for k, t in enumerate(texts):
            w = t.decode().split()
            want = plain_runs(w, least, times)
            assert counts[k] == len(w) and [tuple(x) for x in runs[bounds[k] : bounds[k + 1]].tolist()] == want and left[k].decode() == collapsed(w, want)


def test_splitting_leaves_little_of_prose():
    w = np.random.default_rng(1).zipf(1.3, 20000) % 4000
    loop = np.concatenate([w, np.tile(np.arange(5000, 5030), 4), w[::-1]])
    place, _ = periodic.surviving(loop, np.zeros(len(loop), np.int64))
    assert set(range(20000, 20120)) <= set(place.tolist()) and len(place) < 0.9 * len(loop)


def test_loops_of_the_query(docs):
    rows = periodic.run_digest(periodic.looped(docs)).collect()
    changed = 0
    for r in rows:
        k = r["doc_id"]
        w = words(LOOP if k is None else TEXTS[k] if k < 100 else prose(k - 100, 200))
        h = zlib.crc32(str(k).encode()) if k is not None else 1
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
            changed += 1
        runs = plain_runs(w)
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=(None, None, None))
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        milli = 1000 * best[1] // best[2] if runs else None
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(runs), *best, milli)
        assert r["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)) and r["collapsed_sha256"] == sha(collapsed(w, runs))
    assert changed > 3


def plain_divergence(rows, least=10, best=10):
    rows = [(r["text"] or "", r["lang"] or "", r["source"] or "") for r in rows]
    fold = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    found = [(Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", fold(t))), lang, s) for t, lang, s in rows]
    out = []
    for lang in {x[1] for x in found}:
        own = [x for x in found if x[1] == lang]
        docs = Counter(t for c, _, _ in own for t in c)
        kept = [t for t, n in docs.items() if n >= least]
        counts = {s: Counter() for _, _, s in own}
        for c, _, s in own:
            counts[s].update({t: c[t] for t in kept if c[t]})
        whole = sum(counts.values(), Counter())
        p = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        shares, q = {s: p(c) for s, c in counts.items()}, p(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pairs = [(-sum(f(shares[s][t], shares[o][t]) for t in kept), o.encode(), o) for o in counts if o != s]
            terms = [(-f(shares[s][t], q[t]), t.encode(), t) for t in kept if counts[s][t] and shares[s][t] > q[t]]
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(sorted(terms)[:best])]
    return sorted(out)


@pytest.mark.parametrize("side", [256, 2])
def test_source_divergence(spark, docs, side):
    got = divergence.source_divergence(docs, Scratch(spark, "divergence"), 3, side=side, terms=5)
    assert sorted(map(tuple, got.select("lang", "source", "part", "item", "value", "rank").collect())) == plain_divergence(docs.collect(), 3)
    assert divergence.source_divergence(docs.where("false"), Scratch(spark, "divergence-none")).count() == 0


def test_skyband(spark):
    r = np.random.default_rng(5)
    rows = [("en", f"s{k % 3}", f"t{k}", int(r.integers(1, 40)), int(r.integers(40, 90))) for k in range(6000)]
    df = spark.createDataFrame(rows, "lang string, source string, term string, n long, lang_n long").repartition(5)
    got = {tuple(x) for x in divergence.skyband(df, 4).collect()}
    want = set()
    for s in ("s0", "s1", "s2"):
        own = [x for x in rows if x[1] == s]
        n, m, t = (np.array([x[k] for x in own]) for k in (3, 4, 2))
        want |= {x for x, by in zip(own, (((n >= a[3]) & (m <= a[4]) & (t < a[2])).sum() for a in own), strict=True) if by < 4}
    assert got == want and len(got) < 1000


@pytest.mark.parametrize("shards", [40, 3])
def test_shards(spark, docs, shards, tmp_path):
    rows = sharding.shard_documents(docs, Scratch(spark, "shards"), shards).collect()
    texts = lambda k: LOOP if k is None else (TEXTS[k] if k < 100 else prose(k - 100, 200)) or ""
    assert len(rows) == docs.count() and all((r["size"], r["text_crc32"]) == (len(texts(r["doc_id"]).encode()) + 16, zlib.crc32(texts(r["doc_id"]).encode())) for r in rows)
    line = sorted(rows, key=lambda r: r["before"])
    total, at, slots = sum(r["size"] for r in rows), 0, Counter()
    for r in line:
        assert r["before"] == at and r["shard"] == (2 * at + r["size"]) * shards // (2 * total) and r["slot"] == slots[r["shard"]]
        slots[r["shard"]] += 1
        at += r["size"]
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in line]
    assert ids == sorted(ids)
    assert sharding.shard_documents(docs.where("false"), Scratch(spark, "none")).count() == 0
    if shards == 3:
        told = sharding.write_shards(docs, f"{tmp_path}/out", Scratch(spark, "write"), shards).collect()
        back = spark.read.parquet(f"{tmp_path}/out")
        assert sum(r["documents"] for r in told) == back.count() == docs.count() and sum(r["bytes"] for r in told) == total
        assert sorted(map(repr, back.select("row.*").collect())) == sorted(map(repr, docs.collect()))
        assert {r["shard"]: r["n"] for r in back.groupBy("shard").agg(F.max("slot").alias("n")).collect()} == {k: n - 1 for k, n in slots.items()}


def test_shards_of_one_hot_id(spark):
    df = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    rows = sharding.shard_documents(df, Scratch(spark, "hot"), 40).collect()
    assert sorted(r["before"] for r in rows) == [20 * k for k in range(3000)] and Counter(r["shard"] for r in rows) == {k: 75 for k in range(40)}
