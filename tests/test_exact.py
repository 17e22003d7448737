"""Results that must not hang on regular-expression dialects, on null rows or on the order of sums."""

import hashlib
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from quillboard.operators import intervals as iv, rater as rt
from quillboard.plans import board_queries, corpus_queries, gate_queries
from quillboard.plans.catalog import ORACLES, QUERIES
from quillboard.sources import tables as tables_


@pytest.fixture
def tables(spark, tmp_path):
    def write(**frames):
        con = duckdb.connect()
        for name, (data, schema) in frames.items():
            spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
            con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
        return str(tmp_path), con

    return write


def test_redacted_texts_of_letters_beyond_ascii(spark, tables):
    texts = ["1 2", "señor maquemió été", None, "Ada Lovelace here", "ada lovelace, éLovelACe Éada [NAME]\x0b[NAME]", "ADA LOVELACE Love­lace Lovelaceé", "Loſa Ada"]
    docs = [(k, t, "en", "a" if k < 2 else "b") for k, t in enumerate(texts)]
    d, con = tables(documents=(docs, "doc_id long, text string, lang string, source string"))
    got = sorted(map(tuple, QUERIES["redacted_texts"](spark, d).collect()))
    assert got == sorted(con.execute(ORACLES["redacted_texts"]).fetchall())


def test_exact_mean_at_a_half(spark):
    rows = spark.createDataFrame([(x,) for x in [0.1000005] * 7 + [0.3000005, 0.2000005, 0.1000005]], "x double").repartition(3)
    assert rows.select(rt.exact_mean(F.col("x")).alias("m")).first()["m"] == 0.130001
    rows = spark.createDataFrame([(k / 50000,) for k in [5000, 5001] * 20 + [5005] * 0], "x double")
    assert rows.select(rt.exact_mean(F.col("x")).alias("m")).first()["m"] == 0.10001


@pytest.mark.parametrize("name", ["default_order", "person_rows"])
def test_means_at_a_half_are_those_of_the_sql(spark, name):
    """At sf0.01 some means are halves of the sixth place: there the SQL's sum in the order of its rows decides."""
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{d}/events.parquet'")
    columns = [c[0] for c in con.execute(f"describe {ORACLES[name]}").fetchall()]
    assert sorted(map(tuple, QUERIES[name](spark, d).select(*columns).collect())) == sorted(con.execute(ORACLES[name]).fetchall())


def test_means_in_order(spark):
    """The sum goes by the order, not by partitions; nulls count for nothing and a group of nulls has no mean."""
    values = [0.1 * k for k in range(1, 400)]
    rows = spark.createDataFrame([("a", k, v if k % 5 else None) for k, v in enumerate(values)] + [("b", 1, None)], "g string, k int, v double").repartition(7)
    got = {r["g"]: (r["mean"], r["n"]) for r in rt.means_in_order(rows, "g", ["k"], F.col("v"), n=F.count("*")).collect()}
    kept = [v for k, v in enumerate(values) if k % 5]
    total = 0.0
    for v in kept:
        total += v
    assert got == {"a": (math.floor(total / len(kept) * 1e6 + 0.5) / 1e6, 399), "b": (None, 1)}


def test_digests_take_every_line(spark, tables):
    docs = [(k, None if k == 3 else f"t{k}") for k in range(600)]
    d, con = tables(documents=(docs, "doc_id long, text string"))
    got = tuple(QUERIES["corpus_digest"](spark, d).first())
    assert got == con.execute(ORACLES["corpus_digest"]).fetchone()
    lines = sorted(hashlib.sha256(f"{k} {hashlib.sha256(t.encode()).hexdigest()}".encode()).hexdigest() for k, t in docs if t)
    parts = [f"{b:02x} " + hashlib.sha256("\n".join(g).encode()).hexdigest() for b in range(256) if (g := [h for h in lines if h[:2] == f"{b:02x}"])]
    assert got == (600, hashlib.sha256("\n".join(parts).encode()).hexdigest())


def test_fingerprints_take_every_line(spark, tables):
    orders = [(k, None if k == 5 else "OFP"[k % 3]) for k in range(600)]
    d, con = tables(orders=(orders, "o_orderkey long, o_orderstatus string"), customer=([(1, "x"), (2, None)], "c_custkey long, c_mktsegment string"))
    assert sorted(map(tuple, QUERIES["input_fingerprints"](spark, d).collect())) == sorted(con.execute(ORACLES["input_fingerprints"]).fetchall())


def _picks(key, n, suffix=""):
    return [int(hashlib.md5(f"{key}{k // 4}{suffix}".encode()).hexdigest()[k % 4 * 8 : k % 4 * 8 + 8], 16) % n for k in range(n)]


@pytest.mark.parametrize("block", [1 << 23, 3])
def test_resampling_in_tasks_and_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(iv, "BLOCK", block), monkeypatch.setattr(iv, "SLICE", 2), monkeypatch.setattr(iv, "PICKS", 200)
    units = {g: sorted(range(n), key=lambda u: (hashlib.md5(str(u).encode()).hexdigest()[:2], u)) for g, n in {"a": 33, "long" * 20: 7, "one": 1}.items()}
    value = lambda g, u: None if u % 5 == 1 else u * 1.5
    rows = [(g, u, value(g, u), 1.0 + u % 3) for g, all_ in units.items() for u in all_]
    got = {r["g"]: (r["units"], r["lo"], r["hi"]) for r in iv.ratio_interval(spark.createDataFrame(rows, "g string, u int, num double, den double"), "g", "u", 40, 0.1).collect()}
    for g, at in units.items():
        m = sorted(sum(value(g, at[p]) or 0.0 for p in ps) / sum(1.0 + at[p] % 3 for p in ps) for i in range(40) for ps in [_picks(f"{g}:{i}:", len(at))])
        assert got[g] == pytest.approx((len(at), m[2], m[38])), g

    sides = {"a": {1: [1.0, 4.0, 9.0, None, 7.0], 2: [3.0] * 9 + [8.0]}, "b": {5: [2.0, None, 6.0], 6: [float(k) for k in range(21)], 7: [5.0]}}
    data = [(by, s, c, v) for by in "xy" for s, cs in sides.items() for c, vs in cs.items() for v in vs if by == "x" or c != 7]
    found = {r["by"]: r for r in iv.cluster_gap(spark.createDataFrame(data, "by string, side string, c int, value double"), "c", 30, 0.1, by=["by"]).collect()}
    for by in "xy":
        means = []
        for i in range(30):
            mean = {}
            for s, cs in sides.items():
                kept = [sorted(vs, key=lambda v: (v is None, v)) for c, vs in sorted(cs.items()) if by == "x" or c != 7]
                drawn = []
                for slot in range(len(kept)):
                    vs = kept[int(hashlib.md5(f"{s}:{i}:{slot}".encode()).hexdigest()[:8], 16) % len(kept)]
                    drawn += [vs[p] for p in _picks(f"{s}:{i}:{slot}:", len(vs), ":v") if vs[p] is not None]
                mean[s] = sum(drawn) / len(drawn)
            means.append(mean["a"] - mean["b"])
        means.sort()
        assert (found[by]["lo"], found[by]["hi"]) == pytest.approx((means[1], means[28])), by
        flat = {s: [v for c, vs in cs.items() for v in vs if v is not None and (by == "x" or c != 7)] for s, cs in sides.items()}
        assert found[by]["gap"] == pytest.approx(sum(flat["a"]) / len(flat["a"]) - sum(flat["b"]) / len(flat["b"]))
        assert (found[by]["a"], found[by]["b"]) == (15, 25 if by == "x" else 24)


def test_run_zero_is_numbered_once(spark, monkeypatch):
    numbered = []
    monkeypatch.setattr(tables_, "ratings", lambda s, d, real=tables_.ratings: numbered.append(d) or real(s, d))
    monkeypatch.setattr(board_queries, "ratings", None), monkeypatch.setattr(corpus_queries, "ratings", None), monkeypatch.setattr(gate_queries, "ratings", None)
    for name in ["venue_adjusted", "venue_sensitivity", "person_rollup"]:
        QUERIES[name](spark, "/root/testdata/sf0.001")
    assert len(numbered) == 3
