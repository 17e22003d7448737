"""Dates in texts and the reconciliation of daters, case by case."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quillboard.functions import dategrammar as dg
from quillboard.operators import dating as dn

day = dt.date.fromisoformat


def spans(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(dg.dated_spans(F.col("t")).alias("s")).first()["s"]
    return got and [(x["text"], str(x["lo"]), str(x["hi"]), str(x["utc_lo"]), x["utc_stamp"]) for x in got]


def test_grammar(spark):
    text = "on 2024-01-02T23:30:00-08:00 and Sept. 7-9, 2025, then 3rd of May 2021; August 2023. 31 Feb 2020, 1999"
    got = spark.createDataFrame([(text,)], "t string").select(dg.dated_spans(F.col("t")).alias("s")).first()["s"]
    assert [text[x["at"] : x["end"]] for x in got] == [x["text"] for x in got] == ["2024-01-02T23:30:00-08:00", "Sept. 7-9, 2025", "3rd of May 2021", "August 2023", "Feb 2020"]
    assert [(str(x["lo"]), str(x["hi"])) for x in got] == [("2024-01-02", "2024-01-02"), ("2025-09-07", "2025-09-09"), ("2021-05-03", "2021-05-03"), ("2023-08-01", "2023-08-31"), ("2020-02-01", "2020-02-29")]
    assert str(got[0]["utc_lo"]) == "2024-01-03"
    assert spans(spark, None) is None and spans(spark, "") == [] and spans(spark, "Sep 13, in 2020, 2024-13-40, May 9-7, 2024") == []
    assert spans(spark, "2019-05-31T04:30:00Z") == [("2019-05-31T04:30:00Z", "2019-05-31", "2019-05-31", "2019-05-31", True)]
    assert [s[0] for s in spans(spark, "May 2024-05-06")] == ["2024-05-06"]
    assert spans(spark, "May 30, 2024 25:10 UTC")[0][3] == "2024-05-30"


@pytest.mark.parametrize(("when", "utc"), [("Apr 1, 2006 11:30 pm ET", "2006-04-02"), ("Oct 29, 2006 8:30 pm PT", "2006-10-30"), ("Mar 11, 2007 8:30 pm ET", "2007-03-12"), ("Mar 10, 2007 7:30 pm ET", "2007-03-11"), ("Nov 3, 2007 7:30 pm ET", "2007-11-03"), ("Nov 4, 2007 7:30 pm ET", "2007-11-05"), ("May 3, 2020 00:30 CEST", "2020-05-02")])
def test_daylight_saving(spark, when, utc):
    assert spans(spark, when)[0][3] == utc


def test_only_day(spark):
    cases = {
        "A talk on 4 May 2001.": ("2001-05-04", None), "Born 3 May 1990. Talk on 4 May 2001 here": ("2001-05-04", None), "3 May 2001 and 4 May 2001": (None, "several_days"), "3 May 2001, 2001-05-03": ("2001-05-03", None),
        "use code X until May 3, 2001": (None, "no_full_day"), "May 2001": (None, "no_full_day"), "https://a.com/2001-05-03/x": (None, "no_full_day"), "2001-05-03T01:00:00Z": (None, "utc_time"), "4 May 2030": (None, "not_before_bound"), "": (None, "no_description"),
    }
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(cases)], "k int, t string")
    got = rows.select("k", dg.only_day(F.col("t"), F.lit(False), F.to_date(F.lit("2025-01-01"))).alias("o")).orderBy("k").collect()
    assert [(r["o"]["day"] and str(r["o"]["day"]), r["o"]["why"]) for r in got] == list(cases.values())


def test_quotes(spark):
    text = "We met in town today, and spoke of rates."
    cases = {"met in town today": True, "Met in town ... spoke of rates": True, "met in … spoke of rates": False, "spoke of hats": False, "": False, "own today": False}
    got = spark.createDataFrame([(k, q) for k, q in enumerate(cases)], "k int, q string").select("k", dn.quote_found(F.lit(text), F.col("q")).alias("x")).orderBy("k").collect()
    assert [r["x"] for r in got] == list(cases.values())


RECORDING = "recording long, own_date date, own_basis string, fetched date, description string, text string, named_years array<int>, shown array<date>"
PROPOSAL = "recording long, dater string, place int, verdict string, earliest date, latest date, event string, sources int, reupload boolean, evidence string, bounds array<struct<kind: string, day: date>>"
CHECK = "recording long, dater string, route string, excerpt string, cited boolean, found boolean, published boolean"


def case(daters, own=("2020-06-20", "youtube_upload_date"), shown=(), years=(), description=None, **want):
    return daters, own, shown, years, description, want


def holds(spark, cases):
    """Each case is a recording: its daters (verdict, earliest, latest, excerpt of a page, options) and what the merge must say."""
    r, p, c = [], [], []
    for n, (daters, own, shown, years, description, _) in enumerate(cases):
        r.append((n, day(own[0]), own[1], day("2021-01-01"), description, "we met in town today", list(years), [day(x) for x in shown]))
        for k, (verdict, lo, hi, excerpt, more) in enumerate(daters):
            p.append((n, f"d{k}", k, verdict, lo and day(lo), hi and day(hi), "talk" if verdict != "cannot_date" else "", 1, more.get("reupload", False), more.get("evidence"), more.get("bounds")))
            if excerpt:
                c.append((n, f"d{k}", "page", excerpt, more.get("cited", True), True, more.get("published", False)))
            if "pin" in more:
                c.append((n, f"d{k}", "pin", more["pin"], True, True, False))
    recordings = spark.createDataFrame(r, RECORDING)
    a = dn.assess_proposals(spark.createDataFrame(p, PROPOSAL), recordings, spark.createDataFrame(c, CHECK))
    got = {x["recording"]: x.asDict() for x in dn.merge_proposals(a, recordings).collect()}
    assert len(got) == len(cases)
    for n, (*_, want) in enumerate(cases):
        assert {k: (str(got[n][k]) if isinstance(got[n][k], dt.date) else got[n][k]) for k in want} == want, (cases[n], got[n])


def test_one_dater(spark):
    good = ("dated", "2020-06-01", "2020-06-03", "held June 1-3, 2020", {})
    cases = [
        case([good], outcome="override", day="2020-06-03", lead="d0", method="source_confirmed", refined=""),
        case([good], own=("2020-06-03", "youtube_upload_date"), outcome="check", day="2020-06-03"),
        case([("dated", "2020-06-01", "2020-06-03", "held June 1, 2020", {})], outcome="queue", reason="latest_day_unsourced"),
        case([("dated", "2020-06-01", "2020-06-03", "held June 4, 2020", {})], reason="no_confirming_source"),
        case([("dated", "2020-06-01", "2020-06-03", "held June 3, 2020", {"cited": False})], reason="no_confirming_source"),
        case([("dated", "2020-06-05", "2020-06-03", "June 3, 2020", {})], reason="invalid_proposal"),
        case([("dated", "2020-06-01", "2020-06-03", "June 3, 2020", {"bounds": [("floor", day("2020-06-02"))]})], reason="invalid_proposal"),
        case([("cannot_date", None, None, None, {})], reason="cannot_date"),
        case([("publication_only", "2020-06-03", "2020-06-03", "June 3, 2020", {"reupload": True})], reason="reupload_publication_only"),
        case([("dated", "2020-06-30", "2020-06-30", "June 30, 2020", {})], reason="after_upper_bound"),
        case([good], own=("2020-06-03", "stated_in_page"), reason="own_date_stated"),
        case([good], own=("2020-06-09", "stated_in_page"), reason="stated_date_contradicted"),
        case([good], years=[2019], reason="strong_year_conflict"),
        case([("dated", "2020-06-01", "2020-06-03", None, {})], description="On June 3, 2020 in town", outcome="override", day="2020-06-03"),
        case([("dated", "2020-06-03", "2020-06-03", None, {"evidence": "never said"})], reason="transcript_evidence_not_found"),
        # words that are not in the talk are dropped, the page still confirms
        case([("dated", "2020-06-03", "2020-06-03", "June 3, 2020", {"evidence": "never said"})], outcome="override"),
    ]
    holds(spark, cases)


def test_several_daters(spark):
    a = ("dated", "2020-06-01", "2020-06-30", "in June 2020", {})
    b = ("dated", "2020-06-12", "2020-06-12", "12 June 2020", {})
    own = ("2020-08-01", "youtube_upload_date")
    other = ("dated", "2020-06-13", "2020-06-13", None, {})
    pinned = ("dated", "2020-06-01", "2020-06-12", None, {"pin": "10 June 2020"})
    late = ("publication_only", "2020-06-14", "2020-06-14", "14 June 2020", {})
    cases = [
        case([a, b], own, day="2020-06-12", lead="d1", refined="d0", outcome="override"),  # refined
        case([b, ("dated", "2020-06-13", "2020-06-13", "13 June 2020", {})], own, reason="dater_disagreement"),
        case([b, other], own, outcome="override", overruled="d1"),  # no source of its own
        case([("dated", "2020-06-12", "2020-06-12", "12 June 2020", {"published": True}), other], own, reason="dater_disagreement"),  # a publication day yields
        case([b, ("dated", "2020-06-13", "2020-06-14", "13 June 2020", {})], own, reason="dater_disagreement"),  # supported, not confirmed
        case([late, pinned], own, day="2020-06-10", lead="d1", refined="d0", outcome="override"),
        case([("dated", "2020-06-14", "2020-06-14", "14 June 2020", {}), pinned], own, reason="dater_disagreement"),
    ]
    holds(spark, cases)


def test_agreement(spark):
    own = ("2020-08-01", "youtube_upload_date")
    a, b, c = (("dated", "2020-06-01", x, None, {}) for x in ("2020-06-12", "2020-06-15", "2020-06-25"))
    cases = [
        case([a, a], own, method="two_agent_agreement", day="2020-06-12", days_apart=0, lead=None),
        case([a, b], own, method="two_agent_agreement", day="2020-06-15", days_apart=3),
        case([a, c], own, outcome="queue", reason="no_confirming_source"),
        case([a, b], own, shown=["2020-06-15"], reason="agreement_on_shared_input"),
        case([a, a], ("2020-06-12", "youtube_upload_date"), reason="agreement_on_shared_input"),
        case([a, ("cannot_date", None, None, None, {})], own, reason="no_confirmation"),
    ]
    holds(spark, cases)


def test_a_dater_twice_stops(spark):
    recordings = spark.createDataFrame([(1, None, None, None, None, None, None, None)], RECORDING)
    row = (1, "d0", 0, "dated", day("2020-06-01"), day("2020-06-01"), "talk", 1, False, None, None)
    a = dn.assess_proposals(spark.createDataFrame([row, row], PROPOSAL), recordings, spark.createDataFrame([], CHECK))
    with pytest.raises(Exception, match="one proposal for each dater"):
        dn.merge_proposals(a, recordings).collect()
    none = dn.assess_proposals(spark.createDataFrame([], PROPOSAL), recordings, spark.createDataFrame([], CHECK))
    assert dn.merge_proposals(none, recordings).count() == 0


def test_dates_are_read_by_tasks_in_one_pass(spark):
    """One Arrow call a text; a letter of any alphabet in front ends no word, and null texts stay null."""
    rows = spark.createDataFrame([(1, "\u00e92024-01-02 or June 31, 2024, 3rd of May 2024"), (2, None), (3, "")], "k int, t string")
    df = rows.select("k", dg.dated_spans(F.col("t")).alias("s"))
    assert "ArrowEvalPython" in df._jdf.queryExecution().executedPlan().toString()
    got = {r["k"]: r["s"] and [(s["text"], str(s["lo"]), str(s["hi"])) for s in r["s"]] for r in df.collect()}
    assert got == {1: [("3rd of May 2024", "2024-05-03", "2024-05-03")], 2: None, 3: []}


def test_a_description_is_read_once_for_a_recording(spark):
    """The parse of descriptions stands below the join of proposals with recordings."""
    from quillboard.plans.catalog import QUERIES

    plan = QUERIES["dating_assessed"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().split("\n")
    read = next(k for k, line in enumerate(plan) if "EvalPython" in line and "description" in line)
    assert any("Join Inner" in line for line in plan[:read])
