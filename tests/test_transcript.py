"""Operators without SQL, against plain forms."""

import random
import re
import statistics
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillboard.functions import dates as dt, text as tx
from quillboard.operators import rater as rt, transcript as tr
from quillboard.plans import catalog
from quillboard.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("most", [1000, 1])
def test_venue_effects(spark, most):
    rows = [("ab"[k % 2] if v != "z" else "a", v, float(10 * (k % 2) + {"x": 3, "y": -2, "z": 40}[v] + k % 3)) for k in range(40) for v in ("xy" if k > 5 else "xz")]
    got = {r["venue"]: (r["n"], r["effect"]) for r in rt.venue_effects(spark.createDataFrame(rows, "person string, venue string, v double"), "v", most_venues=most).collect()}
    effect = {"x": 0.0, "y": 0.0}
    used = [r for r in rows if r[1] in effect]
    for _ in range(300):
        person = {p: statistics.mean(v - effect[w] for q, w, v in used if q == p) for p in "ab"}
        effect = {w: statistics.mean(v - person[p] for p, u, v in used if u == w) for w in effect}
        effect = {w: e - sum(effect.values()) / 2 for w, e in effect.items()}
    assert got["z"] == (6, 0.0)
    assert all(abs(got[w][1] - e) < 2e-3 for w, e in effect.items())


def test_venue_effects_query(spark):
    rows = QUERIES["venue_effects"](spark, SF).collect()
    assert rows and abs(sum(r["effect"] for r in rows)) < 0.01


def test_distinct_spans(spark):
    spans = [(d, i, s, s + n) for d in range(3) for i, (s, n) in enumerate([(0, 10), (1, 10), (2, 9), (40, 5), (40, 5), (41, 30), (42, 29), (d, 12)])]
    want = {}
    for d in range(3):
        kept = []
        for i, s, e in sorted(((i, s, e) for q, i, s, e in spans if q == d), key=lambda x: (x[1] - x[2], x[1], x[0])):
            if not any(max(0, min(e, f) - max(s, t)) >= 0.8 * max(e - s, f - t) for _, t, f in kept):
                kept.append((i, s, e))
        want[d] = [k[0] for k in kept]
    got = tr.distinct_spans(spark.createDataFrame(spans, "doc long, id int, start int, end int"), "doc").collect()
    assert {r["doc"]: [k["id"] for k in r["kept"]] for r in got} == want


def test_span_query(spark):
    assert QUERIES["span_dedupe"](spark, SF).count() > 0


def test_pages(spark):
    pages = ["<p>a&amp;b<br>c</p>", "<style>p{}</style><!-- x --><h1>T&eacute;</h1>  <b>u</b>nd", "", None, "1 < 2 and 3 > 2", "<script>var t='</p>';</script>z"]
    assert [tr.page_text(p or "") for p in pages] == ["a&b\nc", "Té\nund", "", "", "1 < 2 and 3 > 2", "z"]
    rows = spark.createDataFrame([(k, p) for k, p in enumerate(pages)], "k int, html string").select(tr.page_digest("html").alias("t")).collect()
    assert [r["t"]["chars"] for r in rows] == [5, 6, 0, 0, 15, 1] and all(r["t"]["verbatim"] for r in rows)
    assert all(r["verbatim"] for r in QUERIES["html_text"](spark, SF).collect())


def test_stutter_and_runs(spark):
    texts = ["you you, You. you. and so", "a a a b b b a a a", "", None, "x", "- - - ... ... ..."]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc int, text string")
    got = {r["doc"]: (r["removed"], r["runs"]) for r in tr.stutter(rows, "doc", tx.words(F.col("text"))).collect()}
    assert (got[0], got[1], got[2], got[4]) == ((2, 1), (3, 3), (0, 0), (0, 0))
    run = rows.select("doc", tr.longest_gram_run(F.split(F.lit("a b c d e e e e e e e e f"), " ")).alias("r")).first()["r"]
    assert run == 4


def test_deadlines(spark):
    stated = ["2024", "2024-02", "2023-2", "2024-02-30", "2024-02-9", "soon", "", None, " 2025 ", "2024-13"]
    deadline, note = dt.stated_deadline(F.col("v"))
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(stated)], "k int, v string").select("k", deadline.alias("d"), note.alias("n")).orderBy("k").collect()
    assert [str(r["d"]) for r in rows] == ["2024-12-31", "2024-02-29", "2023-02-28", "None", "2024-02-09", "None", "None", "None", "2025-12-31", "None"]
    assert [r["n"] for r in rows] == ["ok", "ok", "ok", "malformed", "ok", "malformed", "missing", "missing", "ok", "malformed"]


def test_containment(spark):
    base = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    texts = {1: base, 2: base, 3: base[:30], 4: base[:30] + ["q"] * 6, 5: ["z"] * 20, 6: [], 7: base[:4]}
    rows = spark.createDataFrame([(k, "s", " ".join(t)) for k, t in texts.items()] + [(8, "t", " ".join(base))], "doc long, s string, text string")
    got = {(r["doc_a"], r["doc_b"]): r["common"] for r in tr.containment_pairs(rows, "doc", "s", F.when(F.col("text") != "", F.split("text", " "))).collect()}
    sets = {k: {tuple(t[i : i + 5]) for i in range(len(t) - 4)} for k, t in texts.items() if k != 2}
    want = defaultdict(int)
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.75 * min(len(sets[a]), len(sets[b])):
                want[a, b] = len(sets[a] & sets[b])
    assert got == dict(want)


def plain_gate(text):
    bare = re.sub(tr.NONSPEECH, " ", re.sub(tr.STAMP, " ", text or ""))
    w = re.findall("[a-z']+", bare.lower())
    if not w:
        return 0, None, None, None, "empty_after_cleaning", "reject"
    loops, i = 0, 0
    while i < len(w):
        j = i
        while j + 1 < len(w) and w[j + 1] == w[i]:
            j += 1
        loops, i = loops + max(0, j - i - 1), j + 1
    parts = [w] if len(w) <= 1000 else [w[i : i + 1000] for i in range(0, len(w) - 999, 250)]
    loop, ttr, mattr = round(loops / len(w), 5), round(len(set(w)) / len(w), 4), round(statistics.mean(len(set(p)) / len(p) for p in parts), 4)
    reasons = ",".join(r for r, bad in (("word_count", len(w) < 700), ("loop_share", loop > 0.02), ("mattr", mattr < 0.28)) if bad)
    return len(w), loop, ttr, mattr, reasons, "reject" if reasons else "pass"


def test_gate(spark):
    names = [a + b + c for a in "abcdefgh" for b in "aeiou" for c in "klmnprst"]
    long = " ".join(names[k % 320] + " and" * (k % 97 == 0) for k in range(6000))
    texts = [long, "[00:00:01] [Music] a", None, "[applause]", " ".join(names[:150] * 5), "um um um um " * 100 + " ".join(names * 2), " ".join(names[:200] * 5), " ".join(names * 3 + ["x"] * 19), "a " * 2000, " ".join(names * 3)[: 700 * 4 - 1], " ".join(names * 3)[: 699 * 4 - 1], " ".join(names * 4)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc int, text string")
    got = {r["doc"]: r for r in tr.gate(rows, "doc", "text").collect()}
    for k, t in enumerate(texts):
        g, want = got[k], plain_gate(t)
        assert (g["words"], g["reasons"], g["verdict"]) == (want[0], want[4], want[5]), k
        assert all((a is None) == (b is None) and (a is None or abs(a - b) < 1.1e-4) for a, b in zip((g["loop_share"], g["ttr"], g["mattr"]), want[1:4], strict=True)), k
    assert got[0]["ttr"] < 0.2 and got[0]["verdict"] == "pass" and got[5]["reasons"] == "loop_share" and got[1]["nonspeech"] == 1
    assert got[9]["verdict"] == "pass" and got[10]["reasons"] == "word_count"


def test_gate_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["words"], r["reasons"]) for r in QUERIES["qa_gate"](spark, SF).collect()}
    assert got == {r["doc_id"]: (plain_gate(r["text"])[0], plain_gate(r["text"])[4]) for r in docs}


def _shares(sets, least):
    """Pairs by brute force: {(a, b): common} of sets of a group, copies once by the least key."""
    first = {}
    for k, (group, s) in sorted(sets.items()):
        if s:
            first.setdefault((group, s), k)
    out = {}
    for (g, s), a in first.items():
        for (h, t), b in first.items():
            if a < b and g == h and len(s & t) / min(len(s), len(t)) >= least:
                out[a, b] = len(s & t)
    return out


@pytest.mark.parametrize("least", [0.15, 0.4, 0.75])
def test_packed_copies_lose_no_pair(spark, least):
    """Short sets, sets in large ones, frequent lines, copies, keys without a group: all pairs, and exact counts."""
    r = random.Random(11)
    line = [f"l{k}" for k in range(12)]
    texts = {}
    for k in range(260):
        w = [f"w{r.randrange(4000)}" for _ in range(r.choice((3, 5, 6, 8, 30, 200)))]
        if k > 40 and k % 3:
            w = list(texts[r.randrange(k)][1])
            for _ in range(r.choice((0, 0, 1, 3, 12))):
                w[r.randrange(len(w))] = f"x{r.randrange(9999)}"
            w = w[: r.choice((len(w), len(w), max(1, len(w) // 2)))]
        texts[k] = (None if k % 37 == 0 else f"g{k % 2}", w + line if k % 4 == 0 else w if k % 17 else line)
    rows = spark.createDataFrame([(k, g, " ".join(w)) for k, (g, w) in texts.items()], "doc int, s string, text string").repartition(7)
    sets = {k: (g, frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))) for k, (g, w) in texts.items() if g}
    got = {(x["doc_a"], x["doc_b"]): x["common"] for x in tr.containment_pairs(rows, "doc", "s", F.split("text", " "), least=least).collect()}
    want = _shares(sets, least)
    assert got == want and len(want) > 30

    pairs = tr.shared_shingles(rows.where("doc % 2 = 1"), rows.where("doc % 2 = 0"), "doc", "s", F.split("text", " "), least).collect()
    share = {(a, b): len(s & t) / min(len(s), len(t)) for a, (g, s) in sets.items() for b, (h, t) in sets.items() if a % 2 and not b % 2 and g == h and s and t}
    assert {(x["new"], x["known"]): x["containment"] for x in pairs}.items() <= {p: c for p, c in share.items() if c >= least}.items()
    least_known = lambda b: min(k for k, v in sets.items() if v == sets[b] and k % 2 == 0)
    assert {(x["new"], x["known"]) for x in pairs} == {(a, least_known(b)) for (a, b), c in share.items() if c >= least}


def test_copies_are_dealt_packed(spark):
    """A shingle is dealt as fifteen bytes of a packed row, and most only where they may count: no row for each."""
    from quillboard.operators import copies as cp

    rows = spark.createDataFrame([(k, "g", " ".join(f"w{k}x{i}" for i in range(1004))) for k in range(40)], "doc int, s string, text string").coalesce(1)
    sets = cp.shingle_hashes(rows, "doc", "s", F.split("text", " "), 5)
    none = np.zeros(0, np.uint64)
    dealt = cp._dealt(sets, cp.Order(0.75, none, np.zeros((1 << cp.MAP_BITS) // 8, np.uint8))).select(F.length("h").alias("h"), F.length("s").alias("s"), F.length("f").alias("f")).collect()
    n = sum(x["f"] for x in dealt)
    assert 0.33 * 40_000 < n < 0.37 * 40_000 and len(dealt) <= 1 << cp.PART_BITS
    assert all((x["h"], x["s"]) == (6 * x["f"], 8 * x["f"]) for x in dealt)


def test_copy_sweep_drops_equal_copies(spark, tmp_path):
    """Of equal texts only the best stays, also where it is not the least id, and near copies are held against it."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    base = [[word() for _ in range(60)] for _ in range(6)]
    docs, labels = [], []
    for k in range(90):
        w = list(base[k % 6])
        if k % 4 == 3:
            w = w[: r.choice((25, 40))] + [word() for _ in range(r.choice((5, 40)))]
        text = " ".join(w if k % 9 else w[:3]) + " [1:2]" * (k % 5 if k > 30 else 0)
        docs.append((k, f"s{k % 2}" if k != 50 else None, text))
        labels += [(k, k // 40)] * (k % 7 == 0)
    spark.createDataFrame(docs, "doc_id long, source string, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {x["doc_id"]: x["kept"] for x in catalog.QUERIES["copy_sweep"](spark, str(tmp_path)).collect()}

    made, want, kept = dict(labels), {}, []
    sets = {k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for k, _, t in docs for w in [re.findall("[a-z']+", t)]}
    better = sorted(docs, key=lambda x: (-made.get(x[0], 0), -x[2].count("["), -len(re.findall("[a-z']+", x[2])), x[0]))
    for k, source, _ in better:
        s = sets[k]
        want[k] = not any(source and source == o and s and sets[q] and len(s & sets[q]) >= 0.4 * min(len(s), len(sets[q])) for q, o in kept)
        kept += [(k, source)] * want[k]
    assert got == want and sum(want.values()) < 45


def test_pairs_leave_a_block_once(spark, monkeypatch):
    """A large group of near copies: a shuffled row for each set, not for each pair, in small blocks, groups and parts as well."""
    from quillboard.operators import copies as cp

    monkeypatch.setattr(cp, "SETS", 7), monkeypatch.setattr(cp, "GROUP", 900), monkeypatch.setattr(cp, "PAIRS", 50), monkeypatch.setattr(cp, "BYTES", 500)
    near, real = [], cp.stored
    monkeypatch.setattr(cp, "stored", lambda rows, name: near.append(real(rows, name)) or near[-1] if name == "near" else real(rows, name))
    r = random.Random(3)
    base, texts = [f"w{k}" for k in range(80)], {}
    for k in range(70):
        texts[k] = list(base)
        for _ in range(2):
            texts[k][r.randrange(80)] = f"x{r.randrange(9999)}"
    rows = spark.createDataFrame([(k, "g", " ".join(w)) for k, w in texts.items()], "doc int, s string, text string").repartition(5)
    got = {(x["doc_a"], x["doc_b"]): x["common"] for x in tr.containment_pairs(rows, "doc", "s", F.split("text", " ")).collect()}
    sets = {k: ("g", frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))) for k, w in texts.items()}
    want = _shares(sets, 0.75)
    blocks = 10
    assert got == want and len(want) > 1000 and near[0].count() <= 70 * (blocks + 1)


def test_names_of_a_set_are_dealt_together(spark):
    """In few parts each set's name stands in one run of a packed row, so that it is compressed."""
    from quillboard.operators import copies as cp

    rows = spark.createDataFrame([(k, "g", " ".join(f"w{k}x{i}" for i in range(1004))) for k in range(10)], "doc int, s string, text string").coalesce(1)
    sets = cp.shingle_hashes(rows, "doc", "s", F.split("text", " "), 5)
    bits = cp.part_bits(10_000)
    dealt = cp._dealt(sets, cp.Order(0.15, np.zeros(0, np.uint64), np.zeros((1 << cp.MAP_BITS) // 8, np.uint8)), bits).collect()
    names = [np.frombuffer(r["s"], np.int64) for r in dealt]
    assert len(dealt) <= 32 == 1 << bits and sum(s.size for s in names) > 9000
    assert all((s[1:] != s[:-1]).sum() + 1 == np.unique(s).size for s in names)
    assert (cp.part_bits(0), cp.part_bits(1 << 31), cp.part_bits(1 << 50)) == (5, 7, cp.PART_BITS)
