"""Operators against plain forms, with the cases that go wrong: refusals, ties, gaps, panels of any size."""

import datetime as dt
import itertools
import math

import pytest
from pyspark.sql import functions as F

from quillboard.functions import dates, special as sp, text as tx
from quillboard.operators import corpus as co, deadlines as dl, grounding as gr, intervals as iv, rater as rt, records as rc, replays as rp, screens as sc, selection as se, transcript as tr
from quillboard.sources import records as js


def test_horizons(spark):
    want = {
        "in 3 years": (3, "year"), "10 to 15 years": (15, "year"), "10-12 months": (12, "month"), "every year": "recurring", "3 or more years": "open_ended", "a few weeks": (3, "week"), "a couple more months": (2, "month"), "Next Year": (1, "year"),
        "in the next year": (1, "year"), "first half of next year": (1, "year"), "when it closes": "event_anchored", "before 2031": "no_horizon_value", "": "no_horizon_text", None: "no_horizon_text", "twenty days": (20, "day"), "1 or 2 days": (2, "day"),
    }
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(want)], "k int, t string").select("k", dl.horizon_span(F.col("t")).alias("s")).orderBy("k").collect()
    for r, w in zip(rows, want.values(), strict=True):
        assert (r["s"]["how"] == w) if isinstance(w, str) else ((r["s"]["count"], r["s"]["unit"]) == w), (r, w)


def test_spans_by_the_calendar(spark):
    cases = [("2024-02-29", 1.0, "year", "2025-02-28"), ("2024-01-31", 1.0, "month", "2024-02-29"), ("2024-01-01", 0.5, "year", "2024-07-02"), ("2024-01-01", 2.0, "week", "2024-01-15"), ("2024-01-01", 1.5, "month", "2024-02-16"), ("2024-03-05", 0.5, "day", "2024-03-05")]
    rows = spark.createDataFrame(cases, "s string, c double, u string, w string").select(dl.add_span(F.to_date("s"), F.col("c"), F.col("u")).cast("string").alias("d"), "w").collect()
    assert all(r["d"] == r["w"] for r in rows), rows


def test_new_year_and_trend(spark):
    rows = spark.createDataFrame([("2024-01-05", "2023-12-28", "next year"), ("2024-01-05", None, "next year"), ("2024-01-05", "2023-12-28", "in 2025, next year"), ("2024-01-05", "2023-12-28", "2 years")], "s string, e string, t string")
    got = [r["x"] for r in rows.select(dl.crosses_new_year(F.to_date("s"), F.to_date("e"), F.col("t")).alias("x")).collect()]
    assert got == [True, False, False, False]
    said = spark.createDataFrame([("2021-01-01", "it will grow"), ("2021-01-02", "it will grow"), ("2020-01-01", "it is so"), (None, "up")], "s string, t string")
    found = [r["d"]["how"] for r in said.select(dl.trend_deadline(F.to_date("s"), [F.col("t")], F.lit("2024-01-02").cast("date")).alias("d")).collect()]
    assert [h.split(" ")[0] for h in found] == ["trend", "only", "no", "no_statement_date"]


def test_implied_windows_of_words(spark):
    rows = [("soon", None, "own"), ("coming weeks", None, "own"), (None, None, "own"), (None, "if it rains", None), ("soon, in the coming months", None, None), ("at least seven years", None, None), (None, "before the end of the year", "other"), (None, "before the rival", "other")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, p string, c string, ctl string").withColumn("said", F.lit("2024-01-31").cast("date"))
    w = dl.implied_window(F.col("said"), {"phrase": F.col("p"), "quote": F.lit(""), "claim": F.col("c"), "criteria": F.lit("")}, F.lit(None).cast("string"), F.lit("technology_product"), F.col("ctl"))
    got = [(r["w"]["basis"].split(",")[0], r["w"]["shortest"]) for r in df.select("k", w.alias("w")).orderBy("k").collect()]
    own = "implied: claim: the speaker's own company or product"
    assert got == [("implied: words: soon (phrase)", None), ("implied: words: coming weeks (phrase)", 14), (own, None), ("conditional_claim", None), ("implied_ambiguous_words", None), ("speaker_horizon_longer", None), ("implied: claim: another company", None), ("ordering_claim", None)]


def test_a_trend_resolved_over_two_windows_stops_the_job(spark):
    rows = spark.createDataFrame([(1, "trend: x", dt.date(2024, 1, 1))], "id long, basis string, deadline date")
    judged = spark.createDataFrame([(1, dt.date(2023, 1, 1))], "id long, judged date")
    assert dl.due_set(rows, judged, F.lit("2024-01-01").cast("date")).first()["deadline"] == dt.date(2023, 1, 1)
    with pytest.raises(Exception, match="different windows"):
        dl.due_set(rows, judged.union(spark.createDataFrame([(1, dt.date(2023, 5, 1))], judged.schema)), F.lit("2024-01-01").cast("date")).collect()


def test_locate_quotes(spark):
    text = "[00:00:00] Good day, it's fine. [00:01:00] it's fine [00:02:00] Élan vital"
    quotes = [(1, "IT'S fine", "[00:01:00]"), (2, "it's fine", None), (3, "day [00:05:00] it s", None), (4, "élan VITAL", None), (5, "...", None), (6, "ood day", None), (7, None, None)]
    t, q = spark.createDataFrame([("a", text)], "id string, text string"), spark.createDataFrame([("a", *x) for x in quotes] + [("b", 8, "x", None)], "id string, quote_id int, quote string, hint string")
    got = {r["quote_id"]: r for r in gr.locate_quotes(t, q, "id").collect()}
    assert (text[got[1]["start"] : got[1]["end"]], got[1]["mark"], got[1]["occurrences"]) == ("it's fine", "[00:01:00]", 2)
    assert [got[k]["error"] for k in (2, 5, 6, 7, 8)] == ["ambiguous_no_hint", "empty_quote", "not_found", "empty_quote", "no_transcript"]
    assert text[got[3]["start"] : got[3]["end"]] == "day, it's" and text[got[4]["start"] : got[4]["end"]] == "Élan vital"


def test_replays(spark):
    say = [f"w{k}" for k in range(200)]
    again = [*say[:60], "[00:01:00]", "[00:02:00]", *say[20:60], "x", *say[100:160]]
    slipped = [*say[:100], "a", "b", *say[2:100]]  # two words before the passage fit nowhere
    grown = [*say[:100], "q", *say[3:6], "a", "b", "c", *say[9:60]]  # three slips, and words that fit before them
    broken = [*say[:100], "q", *say[3:6], "a", "b", "c", "d", *say[10:60]]  # four slips end the growth
    island = [*say[:60], *say[0:25], *[f"i{k}" for k in range(19)], *say[30:60]]
    apart = [*say[:60], *say[0:25], *[f"i{k}" for k in range(24)], *say[30:60]]
    thrice = [*say[:30], *say[:30], *say[:30]]
    teaser = [*say[:20], *[f"v{k}" for k in range(1000)], *say[:20]]
    texts = [again, say, [], slipped, grown, broken, island, apart, thrice, teaser, ["a"] * 30, None]
    rows = [(k, None if t is None else " ".join(t)) for k, t in enumerate(texts)]
    got = rp.without_replays(spark.createDataFrame([*rows, rows[0], (None, rows[3][1]), (0, rows[3][1])], "doc_id long, text string"), "doc_id", "text").collect()
    assert len(got) == len(texts) + 3 and sum(r["doc_id"] == 0 and r["removed"] == 40 for r in got) == 2 and {r["removed"] for r in got if r["doc_id"] is None} == {98}
    by = {r["doc_id"]: r for r in got if not (r["doc_id"] == 0 and r["removed"] == 98)}
    assert [by[k]["removed"] for k in range(12)] == [40, 0, 0, 98, 57, 50, 25 + 19 + 30, 25 + 30, 60, 0, 29, 0]
    assert (by[0]["words"], by[0]["share"]) == (161, round(40 / 161, 4)) and by[0]["text"].split()[60:63] == ["[00:02:00]", "x", "w100"]
    assert by[4]["text"].split() == [*say[:100], "q"] and by[5]["text"].split() == [*say[:100], "q", *say[3:6], "a", "b", "c", "d"]
    assert by[9]["share"] == round(20 / 1040, 4) and by[9]["text"] == " ".join(teaser) and by[11]["text"] == ""


@pytest.mark.parametrize("window", [1, 2, 3, 7, 20])
def test_window_hashes(spark, window):
    words = "a b c a b c d e a b c a b c d f g h i j k l a b c a b c d e a b".split()
    got = spark.createDataFrame([(words,), (words[:window],), (words[: window - 1],), ([],)], "w array<string>").select("w", rp.window_hashes(F.col("w"), window).alias("h")).collect()
    for w, h in got:
        pieces = [tuple(w[k : k + window]) for k in range(len(w) - window + 1)]
        assert len(h) == len(pieces) and len(set(h)) == len(set(pieces)) == len(set(zip(h, pieces, strict=True)))


def test_sweep(spark, tmp_path):
    like = [(0, 1), (1, 2), (2, 3), (5, 6), (6, 7), (5, 7)]
    places = [(k, k) for k in range(8)]
    kept: list[int] = []
    for k, _ in places:
        if not any((a, k) in like or (k, a) in like for a in kept):
            kept.append(k)

    def write(name, df):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}")

    got = co.sweep(spark.createDataFrame(places, "id long, place int"), spark.createDataFrame(like, "a long, b long"), write).collect()
    assert sorted(r["id"] for r in got if r["kept"]) == kept and len(got) == 8


def test_pages_with_hard_tags():
    pages = {
        '<p title="a > b">x</p>y': "x\ny", "<script>if (a < b) { '</p>' }</script>t": "t", "<nav>menu<nav>more</nav>x</nav>z": "z", "a<!-- <b> -->b": "ab", "<style>x": "", "3 < 4": "3 < 4", "<svg/>k": "k", "a<br/>b<hr>c": "a\nb\nc", "&lt;p&gt;": "<p>",
    }
    for page, want in pages.items():
        assert tr.page_text(page) == want, page
        assert tr.letters(tr.page_text(page)) == tr.letters(tr.parsed(page)), page


def test_dates_named(spark):
    text = "due 30 June 2026 or JULY 4th, 2026, not 2024-13 nor 2024-02-31x; by march 2025, in 1999"
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(dates.dates_in(F.col("t")).alias("d")).first()["d"] == ["30 June 2026", "JULY 4th, 2026", "march 2025", "1999"]
    parts = df.select(F.explode(dates.dates_in(F.col("t"))).alias("d")).select(*[c.alias(n) for c, n in zip(dates.date_parts(F.col("d")), "ymd", strict=True)]).collect()
    assert [tuple(r) for r in parts] == [(2026, 6, 30), (2026, 7, 4), (2025, 3, None), (1999, None, None)]


def test_horizons_beyond_the_calendar(spark):
    texts = ["in 12345678901 years", "in 900000 years", "3 to 99999999999 days", "in 2000000 days", "in 2 years", "40000000 months"]
    said = F.to_date(F.lit("2020-02-29"))
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", dl.horizon_span(F.col("t")).alias("s"))
    got = [(r["count"], r["how"], r["d"]) for r in rows.select("k", "s.*", dl.add_span(said, F.col("s.count"), F.col("s.unit")).cast("string").alias("d")).orderBy("k").collect()]
    none = (None, "no_horizon_value", None)
    assert got == [none, (900000.0, "number and unit", None), none, (2000000.0, "number and unit", None), (2.0, "number and unit", "2022-02-28"), (40000000.0, "number and unit", None)]


def test_stated_date_beats_a_range_over_new_year(spark):
    day = lambda x: F.to_date(F.lit(x))
    row = spark.range(1).select(
        day("2021-01-02").alias("said"), day("2020-12-30").alias("earliest"), F.lit("next year").alias("phrase"), F.lit(None).cast("double").alias("years"), F.lit("2021-06-30").alias("target"),
        *[F.lit("x").alias(c) for c in ("claim", "criteria", "quote", "category", "control", "form")],
    )
    a = dl.attach_deadlines(row).first()
    assert str(a["deadline"]) == "2021-06-30"
    assert dl.attach_deadlines(row.withColumn("target", F.lit(None).cast("string"))).first()["why_none"] == "range_crosses_new_year"


def test_shares_round_alike(spark):
    rows = spark.createDataFrame([(41875, 100000), (1, 3), (0, 5), (5, 0), (1, 20000), (3, 20000)], "p int, w int")
    assert [r["x"] for r in rows.select(tx.rounded_share(F.col("p"), F.col("w"), 4).alias("x")).collect()] == [0.4188, 0.3333, 0.0, None, 0.0001, 0.0002]


def test_sounds(spark):
    words = ["phonetics", "check", "xerox", "quizzes", "aardvark", "cook", "", "o'neil"]
    got = [r["s"] for r in spark.createDataFrame([(k, w) for k, w in enumerate(words)], "k int, w string").select("k", tx.consonant_skeleton(F.col("w")).alias("s")).orderBy("k").collect()]
    assert got == ["fntks", "khk", "ksrks", "ks", "ardvrk", "k", "", "onl"]


@pytest.mark.parametrize("judges", [3, 4])
def test_two_way_icc_of_any_panel(spark, judges):
    import numpy as np

    r = np.random.default_rng(judges)
    x = r.normal(size=(30, 1)) * 3 + r.normal(size=(1, judges)) + r.normal(size=(30, judges))
    rows = [(u, j, float(x[u, j])) for u in range(30) for j in range(judges)] + [(99, 0, 5.0)]
    got = iv.two_way_icc(spark.createDataFrame(rows, "u int, j int, x double"), "u", "j", "x").first()
    n, k, m = 30, judges, x.mean()
    msu, msr = k * ((x.mean(1) - m) ** 2).sum() / (n - 1), n * ((x.mean(0) - m) ** 2).sum() / (k - 1)
    mse = ((x - x.mean(1, keepdims=True) - x.mean(0, keepdims=True) + m) ** 2).sum() / ((n - 1) * (k - 1))
    assert (got["n"], got["k"]) == (n, k)
    assert math.isclose(got["icc31"], (msu - mse) / (msu + (k - 1) * mse), abs_tol=1e-5) and math.isclose(got["icc21"], (msu - mse) / (msu + (k - 1) * mse + k * (msr - mse) / n), abs_tol=1e-5)


def test_intervals_cover_the_mean(spark):
    rows = [("a", k, float(k % 10), 1.0) for k in range(200)] + [("b", 0, 7.0, 2.0)]
    got = {r["g"]: r for r in iv.ratio_interval(spark.createDataFrame(rows, "g string, u int, num double, den double"), "g", "u", 400).collect()}
    assert got["a"]["units"] == 200 and 3.9 < got["a"]["lo"] < 4.3 and 4.7 < got["a"]["hi"] < 5.1
    assert (got["b"]["lo"], got["b"]["hi"]) == (3.5, 3.5)
    sides = [("a", c, 1.0 + c % 2) for c in range(20) for _ in range(5)] + [("b", c, 1.0) for c in range(20) for _ in range(5)]
    gap = iv.cluster_gap(spark.createDataFrame(sides, "side string, c int, value double"), "c", 200).first()
    assert gap["gap"] == 0.5 and gap["lo"] < 0.5 < gap["hi"] and gap["a"] == 100
    assert spark.range(1).select(iv.distinct_resamples(F.lit(5)).alias("n")).first()["n"] == 126.0
    with pytest.raises(Exception, match="inverted"):
        spark.range(1).select(iv.equivalence(F.lit(2.0), F.lit(1.0), 3)).collect()


def test_share_dissent(spark):
    rows = [(1, "a", 50.0), (1, "b", 52.0), (1, "c", 90.0), (2, "a", 10.0), (2, "b", 90.0), (3, "a", 1.0), (3, "b", 50.0), (3, "c", 99.0), (4, "a", 50.0), (4, "b", 50.0), (4, "c", 51.0), (4, "d", 10.0)]
    got = sc.share_dissent(spark.createDataFrame(rows, "u int, judge string, share double"), "u", 20, 10).collect()
    assert sorted((r["u"], r["judge"], r["others"]) for r in got) == [(1, "c", 51.0), (4, "d", 50.0)]


def test_thresholds(spark):
    texts = {"exceed 5 million by 2025-01-01": {("n", 5e6)}, "12% or 12 percent in 2024": {("pct", 12.0)}, "1,500 units and 3bn": {("n", 1500.0), ("n", 3e9)}, "December 31, 2013": set(), "": set()}
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", sc.thresholds(F.col("t"), dates.DATE).alias("x")).orderBy("k").collect()
    assert [{(y["kind"], y["v"]) for y in r["x"]} for r in rows] == list(texts.values())


def test_refusals(spark):
    with pytest.raises(Exception, match="differently"):
        se.refuse_conflicts(spark.createDataFrame([(1, 2)], "k int, v int"), spark.createDataFrame([(1, 3)], "k int, v int"), "k", "v").collect()
    runs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "k int, run string")
    none = spark.createDataFrame([], "k int, run string")
    with pytest.raises(Exception, match="two runs"):
        se.across_runs(runs, "k", none, spark.createDataFrame([], "k int, old string, new string")).collect()
    assert se.across_runs(runs, "k", none, spark.createDataFrame([(1, "a", "b")], "k int, old string, new string")).count() == 2
    with pytest.raises(Exception, match="unknown board"):
        se.board_membership(spark.createDataFrame([("x", "q")], "slug string, board string"), ["p"]).collect()
    with pytest.raises(ValueError):
        se.limited(runs, "k", [F.col("run")], -1)
    assert se.limited(runs, "k", [F.col("run")], 0).count() == 0 and se.limited(runs, "k", [F.col("run")], None).count() == 3
    with pytest.raises(Exception, match="malformed"):
        spark.createDataFrame([("20240231",)], "r string").select(rc.upload_date(F.col("r"))).collect()
    shelf = spark.createDataFrame([(1, None, None)], "id int, arrived timestamp, fetched timestamp")
    with pytest.raises(Exception, match="does not cover"):
        co.arrival_states(shelf, shelf.select("id").where("id > 1"), F.lit(None).cast("timestamp"), refuse=True).collect()


def test_broken_records(spark, tmp_path):
    (tmp_path / "x" / "_raw").mkdir(parents=True)
    (tmp_path / "x" / "a.json").write_text('{"slug": "p", "text": "a b"}\n{"slug": "q"}\nnot json\n{"slug": "r", "text": "c\u0085"}\n', encoding="utf-8")
    (tmp_path / "x" / "_raw" / "b.json").write_text('{"slug": "z", "text": "t"}\n')
    rows = js.read_transcripts(spark, str(tmp_path / "x"), "slug string, text string").collect()
    assert sorted((r["slug"], r["text"]) for r in rows) == [("p", "a b"), ("r", "c\u0085")]
    with pytest.raises(Exception, match="(?i)malformed"):
        js.read_json(spark, str(tmp_path / "x"), "slug string, text string", strict=True).collect()


def test_key_paths():
    from pyspark.sql import types as T

    schema = T.StructType().add("a", T.StructType().add("b", "integer").add("hit_rate", T.ArrayType(T.StructType().add("c", "string")))).add("m", T.MapType(T.StringType(), T.StructType().add("rank", "integer")))
    paths = co.schema_paths(schema)
    assert paths == ["$.a", "$.a.b", "$.a.hit_rate", "$.a.hit_rate[].c", "$.m", "$.m.*.rank"]
    assert co.forbidden(paths) == ["$.a.hit_rate", "$.m.*.rank"]


def test_panels_of_four(spark):
    cells = [(r, j, "F", 0) for r in range(6) for j in "ABCD"[: 4 if r % 2 else 3]] + [(0, "D", "F", 1)]
    rows = spark.createDataFrame(cells, "rec int, judge string, mode string, run int")
    got = {r["rec"]: (r["cells"], r["panel"], r["complete"]) for r in rt.panel_cells(rows).collect()}
    assert got == {r: (4, 4, True) if r % 2 else (3, 4, False) for r in range(6)}
    votes = spark.createDataFrame([(1, "zoo", 0), (1, "arena", 0), (2, "b", 0), (2, "b", 0), (2, "a", 0)], "rec int, venue string, run int")
    assert {r["rec"]: (r["venue"], r["agreed"]) for r in rt.venue_vote(votes).collect()} == {1: ("arena", False), 2: ("b", True)}


def test_exact_bounds(spark):
    got = [tuple(round(x, 4) for x in r["c"]) for r in spark.createDataFrame([(0, 10), (10, 10), (3, 10)], "k int, n int").select(sp.clopper_pearson(F.col("k"), F.col("n")).alias("c")).collect()]
    assert got == [(0.0, 0.3085), (0.6915, 1.0), (0.0667, 0.6525)]


def test_top_up_and_halves(spark):
    items = spark.createDataFrame([("p", k) for k in range(10)] + [("q", k) for k in range(3)], "who string, k int")
    complete, partial = spark.createDataFrame([("p", 0), ("p", 1)], items.schema), spark.createDataFrame([("p", 9)], items.schema)
    got = se.top_up(items, complete, partial, "who", "k", 5).collect()
    mine = [r for r in got if r["who"] == "p"]
    assert len(mine) == 3 and mine[0]["begun"] and {r["short"] for r in got if r["who"] == "q"} == {2}
    half = spark.createDataFrame([(w, k, k < e) for w, n, e in (("a", 20, 10), ("b", 20, 2), ("c", 20, 19), ("d", 4, 1)) for k in range(n)], "w string, k int, ext boolean")
    n = {w: (sum(1 for r in g if r["ext"]), sum(1 for r in g if not r["ext"])) for w, g in ((w, list(g)) for w, g in itertools.groupby(sorted(se.half_sample(half, "w", "k", "ext", 10).collect(), key=lambda r: r["w"]), key=lambda r: r["w"]))}
    assert n == {"a": (5, 5), "b": (2, 8), "c": (9, 1), "d": (1, 3)}



def test_misheard_names(spark):
    from quillboard.operators import likeness as lk

    texts = spark.createDataFrame([(1, "Curran spoke. Then Kurion and the hang of it. Kurian's words, Kurian. CURRENT Curran"), (2, "curran is not capital"), (3, "Kuran " * 30)], "id int, text string")
    anchors = spark.createDataFrame([(k, "Kurian") for k in (1, 2, 3)] + [(1, "Bob")], "id int, anchor string")
    known = spark.createDataFrame([("current",)], "word string")
    assert {(r["id"], r["word"], r["anchor"]) for r in lk.misheard(texts, "id", anchors, known).collect()} == {(1, "curran", "Kurian"), (1, "kurion", "Kurian")}


def test_heard_words_as_java(spark):
    import random

    from quillboard.operators import likeness as lk, vocabulary as vo

    r = random.Random(3)
    letters = "abcDEFxyz'\u2019--__09 \u0301\u0308\u00e9\u00b2\u00bd\u00aa\u0416\u65e5\u2014.,"
    texts = ["", None, *("".join(r.choices(letters, k=r.randint(1, 40))) for _ in range(3000))]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    java = rows.select("k", F.explode(F.regexp_extract_all("text", F.lit("\\b([A-Za-z][A-Za-z'\u2019-]{3,})\\b"), 1)).alias("raw")).withColumn("word", F.lower("raw"))
    want = java.groupBy("k", "word").agg(F.count("*").alias("n"), F.bool_or(F.col("raw").rlike("^[A-Z]")).alias("capital"))
    assert sorted(map(tuple, vo.counted(rows, "k", lk.heard_words).collect())) == sorted(map(tuple, want.collect()))
    plain = want.where(F.col("capital") & ~F.col("word").rlike("['\u2019]")).select("word").distinct()
    assert sorted(map(tuple, vo.vocabulary(rows.select("text"), lk.capitals).collect())) == sorted(map(tuple, plain.collect()))


def test_tokens_as_column(spark):
    from quillboard.operators import checks as ck, vocabulary as vo

    rows = spark.createDataFrame([("It's \u212aELVIN \u0130s o'clock\nX9y flies",), (None,), ("",), ("it's \u017fo boxes",)], "text string")
    want = rows.select(F.explode(tx.tokens(F.col("text"))).alias("word")).distinct()
    words = vo.vocabulary(rows, vo.tokens)
    assert sorted(map(tuple, words.collect())) == sorted(map(tuple, want.collect()))
    known = ck.in_dictionary(words, spark.createDataFrame([("fly",), ("box",), ("box",), ("x",)], "word string"))
    assert {r["word"] for r in known.collect() if r["known"]} == {"flies", "boxes", "x"} and known.count() == words.count()
    assert known.rdd.getNumPartitions() == vo.parts(spark)  # not merged by their few bytes


def test_likeness_as_difflib(spark):
    import random
    from difflib import SequenceMatcher

    from quillboard.operators import likeness as lk

    r = random.Random(5)
    pairs = [("", ""), ("", "a"), ("kurian", "curran"), ("abcdefgh", "hgfedcba"), ("aaaa", "aa"), ("private thread", "private volatile")]
    pairs += [("".join(r.choices("abcde", k=r.randint(0, 14))), "".join(r.choices("abcde", k=r.randint(0, 14)))) for _ in range(150)]
    rows = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "k int, a string, b string")
    got = rows.select("k", lk.likeness(F.col("a"), F.col("b")).alias("x"), lk.common_letters(F.col("a"), F.col("b")).alias("c")).orderBy("k").collect()
    for (a, b), row in zip(pairs, got, strict=True):
        assert math.isclose(row["x"], SequenceMatcher(None, a, b).ratio()), (a, b)
        assert row["c"] == sum(min(a.count(c), b.count(c)) for c in set(a))


def test_alike_loses_no_pair(spark):
    import random
    from difflib import SequenceMatcher

    from quillboard.operators import likeness as lk

    r = random.Random(6)
    words = sorted({"".join(r.choices("bcdfgkrtaeiou", k=r.randint(4, 9))) for _ in range(160)})
    names = sorted({"".join(c if r.random() > 0.2 else r.choice("bcdaeo") for c in w) for w in words[::3]})
    skeleton = dict(spark.createDataFrame([(w,) for w in {*words, *names}], "w string").select("w", tx.consonant_skeleton(F.col("w"))).collect())
    like = lambda a, b: SequenceMatcher(None, a, b).ratio()
    want = {(w, n) for w in words for n in names if w != n and abs(len(w) - len(n)) <= 3 and like(w, n) >= lk.SPELLING and like(skeleton[w], skeleton[n]) >= lk.SOUND}
    got = lk.alike(spark.createDataFrame([(w,) for w in words], "word string"), spark.createDataFrame([(n,) for n in names], "name string")).collect()
    assert {tuple(x) for x in got} == want and len(got) == len(want) > 20


def test_special_functions(spark):
    def below(k, n, p):  # at least k hits of n
        return math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log1p(-p)) for j in range(k, n + 1))

    xs = [0.001, 0.5, 1.0, 2.5, 10.0, 123.4, 5e4]
    got = [r["g"] for r in spark.createDataFrame([(k, x) for k, x in enumerate(xs)], "k int, x double").select("k", sp.log_gamma(F.col("x")).alias("g")).orderBy("k").collect()]
    assert all(math.isclose(g, math.lgamma(x), rel_tol=1e-12, abs_tol=1e-12) for g, x in zip(got, xs, strict=True))
    trials = [(1, 1), (1, 10), (5, 10), (10, 10), (3, 400), (390, 400), (1500, 3000), (20, 30000), (15000, 30000)]
    cases = [(k, n, p) for k, n in trials for p in (0.001, 0.3, 0.5, 0.97)]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, k int, n int, p double")
    got = rows.select("i", sp.incomplete_beta(F.col("k"), F.col("n") - F.col("k") + 1, F.col("p")).alias("x")).orderBy("i").collect()
    assert all(math.isclose(r["x"], below(*c), rel_tol=1e-7, abs_tol=1e-10) for r, c in zip(got, cases, strict=True))
    bounds = spark.createDataFrame([(i, *c) for i, c in enumerate(trials)], "i int, k int, n int").select("i", sp.clopper_pearson(F.col("k"), F.col("n")).alias("c")).orderBy("i").collect()
    for r, (k, n) in zip(bounds, trials, strict=True):
        assert math.isclose(below(k, n, r["c"]["lo"]), 0.025, rel_tol=1e-4) and (k == n or math.isclose(below(k + 1, n, r["c"]["hi"]), 0.975, rel_tol=1e-4))
    ends = spark.createDataFrame([(0, 0), (0, 5), (5, 5)], "k int, n int").select(sp.clopper_pearson(F.col("k"), F.col("n")).alias("c")).collect()
    assert ends[0]["c"] is None and ends[1]["c"]["lo"] == 0 and ends[2]["c"]["hi"] == 1
    p = [r["p"] for r in spark.createDataFrame([(0, 2.0, 10), (1, -2.228, 10), (2, 12.706, 1), (3, 0.0, 4)], "k int, t double, f int").select("k", sp.two_sided_t(F.col("t"), F.col("f")).alias("p")).orderBy("k").collect()]
    assert [round(x, 4) for x in p] == [0.0734, 0.05, 0.05, 1.0]


def test_ols(spark):
    rows = [("a", float(x), 2.0 * x + 1 + (-1) ** x) for x in range(9)] + [("b", 1.0, 2.0), ("b", 2.0, 4.0), ("c", 1.0, 2.0), ("c", 1.0, 3.0), ("c", 1.0, 4.0)]
    got = {r["g"]: r for r in rt.ols(spark.createDataFrame(rows, "g string, x double, y double"), "g", "x", "y").collect()}
    xs, ys = [r[1] for r in rows if r[0] == "a"], [r[2] for r in rows if r[0] == "a"]
    mx, my = sum(xs) / 9, sum(ys) / 9
    b = sum((x - mx) * (y - my) for x, y in zip(xs, ys, strict=True)) / sum((x - mx) ** 2 for x in xs)
    se = math.sqrt(sum((y - my - b * (x - mx)) ** 2 for x, y in zip(xs, ys, strict=True)) / 7 / sum((x - mx) ** 2 for x in xs))
    assert math.isclose(got["a"]["se"], se) and math.isclose(got["a"]["t"], b / se) and math.isclose(got["a"]["hi"], b + 2.365 * se) and 0 < got["a"]["p"] < 1e-4
    assert got["b"]["slope"] == 2 and got["b"]["se"] is None and got["c"]["slope"] is None and got["c"]["t"] is None


@pytest.mark.parametrize(("gone", "refused"), [(9, False), (10, False), (11, True)])
def test_pruning_is_guarded(spark, gone, refused):
    from quillboard.operators import checks as ck

    frame = lambda ks: spark.createDataFrame([(k,) for k in ks], "k int")
    derived, written = frame(range(40)), frame(range(20))
    shelf = frame(k for k in range(40) if not 20 <= k < 20 + gone - 1)
    grades = spark.createDataFrame([(k, m) for k in range(40) for m in ("F", "O")], "k int, mode string")
    left, marked, report = ck.prune_orphans(derived, grades, written, shelf, frame([39, 39, 1]), ["k"], "F")
    r = report.first()
    assert (r["examined"], r["pruned"], r["refused"], r["would_have_pruned"]) == (40, 0 if refused else gone, refused, gone if refused else None)
    kept = {x["k"] for x in left.collect()}
    want = set(range(40)) - (set() if refused else {39, *range(20, 20 + gone - 1)})
    assert kept == want and left.count() == len(want) and left.columns == ["k"]
    assert {x["k"] for x in marked.where("orphaned").collect()} == set(range(40)) - want and r["orphaned_grades"] == 40 - len(want) and marked.count() == 80
