"""When was a recording spoken: proposals of several daters are judged alone, then reconciled.

A proposal is a range of days with checks of the sources that it cites. Each is judged by
rules in a fixed order; of those that a source confirms, the ranges of all must leave one
last day, or the recording goes to a queue with the reason. Daters are few for a recording,
so what meets in one row is bounded by their number.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from quillboard.functions import text as tx
from quillboard.functions.dategrammar import dated_spans, for_verdict, let, only_day

#: Days that last days of agreeing daters may lie apart, words of a piece of a quote.
NEAR_DAYS, PIECE_WORDS = 7, 3


def first_reason(rules: list[tuple[Column, str]]) -> Column:
    """The name of the first rule that holds; null without one."""
    return reduce(lambda c, r: c.when(F.coalesce(r[0], F.lit(False)), r[1]), rules[1:], F.when(F.coalesce(rules[0][0], F.lit(False)), rules[0][1]))


def quote_found(text: Column, quote: Column) -> Column:
    """Whether a quote stands in a text, or, where an ellipsis joins pieces of three words or more, all pieces do."""
    pieces = F.filter(F.split(quote, r"\s*(?:\.\.\.|…)\s*"), lambda p: F.size(F.split(tx.normalised(p), " ")) >= PIECE_WORDS)

    def within(whole: Column) -> Column:
        has = lambda q: let(tx.normalised(q), lambda x: (x != "") & whole.contains(F.concat(F.lit(" "), x, F.lit(" "))))
        return F.coalesce(has(quote) | let(pieces, lambda ps: (F.size(ps) > 1) & F.forall(ps, has)), F.lit(False))

    return let(F.concat(F.lit(" "), tx.normalised(text), F.lit(" ")), within)


def check_spans(checks: DataFrame, proposals: DataFrame) -> DataFrame:
    """recording, dater, spans of what the sources of each proposal show inside its range.

    ``checks``: recording, dater, route (page or pin), excerpt, cited and found (the page holds the words that
    the proposal cites) and published (the date stands beside a word of publication). A span is lo, hi,
    route and publication; a date in UTC dates no speech and one counts as publication.
    """
    ranges = proposals.select("recording", "dater", "earliest", "latest", (F.col("verdict") == "publication_only").alias("publication"))
    met = checks.where("cited and found").join(ranges, ["recording", "dater"]).select("*", F.explode(dated_spans(F.col("excerpt"))).alias("s"))
    read = met.select("recording", "dater", "route", "earliest", "latest", (F.col("published") | F.col("s.utc_stamp")).alias("published"), for_verdict(F.col("s"), F.col("publication")).alias("r"))
    inside = read.where("r is not null and (route = 'pin' or (r.lo >= earliest and r.hi <= latest))")
    span = F.struct(F.col("r.lo").alias("lo"), F.col("r.hi").alias("hi"), "route", F.col("published").alias("publication"))
    return inside.groupBy("recording", "dater").agg(F.array_sort(F.collect_set(span)).alias("spans"))


def assess_proposals(proposals: DataFrame, recordings: DataFrame, checks: DataFrame) -> DataFrame:
    """Each proposal by itself: eligible, confirmed, supported, pinned, publication_day, its range, spans and the reason it waits for.

    ``proposals``: recording, dater, place (order of the daters), verdict (dated, publication_only
    or cannot_date), earliest, latest, event, sources, reupload, evidence (words of the talk)
    and bounds (array of kind, floor or ceiling, and day). ``recordings``: recording, own_date,
    own_basis, fetched, description, text. ``checks``: see check_spans.

    Rules in order: invalid_proposal (dates, event and sources that do not fit the verdict, a
    range outside its own bounds), cannot_date, reupload_publication_only, no_upper_bound,
    after_upper_bound, transcript_evidence_not_found, no_confirming_source and
    latest_day_unsourced. Words that are not in the talk are dropped: the proposal is no
    longer eligible but a source may still confirm it. A day that the talk pins (route pin)
    narrows the range to it; the one full day of the description confirms it too.
    """
    per = check_spans(checks, proposals)
    known = recordings.select("recording", "own_date", "own_basis", "description", F.col("text").alias("talk"), F.coalesce("own_date", "fetched").alias("bound"))
    # once for a recording, however many daters it has
    known = known.select("*", *[only_day(F.col("description"), F.lit(publication), F.col("bound"))["day"].alias(name) for name, publication in (("told_talk", False), ("told_publication", True))]).drop("description")
    rows = proposals.join(known, "recording").join(per, ["recording", "dater"], "left")
    undated = F.col("verdict") == "cannot_date"
    low, high = F.col("earliest"), F.col("latest")
    outside = F.exists(F.coalesce("bounds", F.array().cast("array<struct<kind: string, day: date>>")), lambda b: ((b["kind"] == "floor") & (low < b["day"])) | ((b["kind"] == "ceiling") & (high > b["day"])))
    empty = F.coalesce(F.trim("event"), F.lit("")) == ""
    invalid = (undated & (low.isNotNull() | high.isNotNull() | ~empty)) | (~undated & (low.isNull() | high.isNull() | (low > high) | (F.coalesce("sources", F.lit(0)) == 0) | empty | outside))
    early = first_reason([
        (invalid | ~F.col("verdict").isin("dated", "publication_only", "cannot_date") | F.col("verdict").isNull(), "invalid_proposal"), (undated, "cannot_date"), ((F.col("verdict") == "publication_only") & F.col("reupload"), "reupload_publication_only"),
        (F.col("bound").isNull(), "no_upper_bound"), (high > F.col("bound"), "after_upper_bound"),
    ])
    rows = rows.withColumn("early", early)
    open_ = F.col("early").isNull()
    rows = rows.withColumn("missing", open_ & (F.coalesce("evidence", F.lit("")) != "") & ~quote_found(F.col("talk"), F.col("evidence")))
    rows = rows.withColumn("eligible", open_ & ~F.col("missing"))
    rows = rows.withColumn("told", F.when(open_, F.when(F.col("verdict") == "publication_only", F.col("told_publication")).otherwise(F.col("told_talk"))))
    none = F.array().cast("array<struct<lo: date, hi: date, route: string, publication: boolean>>")
    told = F.when(F.col("told").between(low, high), F.array(F.struct(F.col("told").alias("lo"), F.col("told").alias("hi"), F.lit("description").alias("route"), F.lit(False).alias("publication"))))
    rows = rows.withColumn("spans", F.when(open_, F.concat(F.coalesce("spans", none), F.coalesce(told, none))).otherwise(none))
    pin = F.filter("spans", lambda s: (s["route"] == "pin") & (s["lo"] == s["hi"]) & s["lo"].between(low, high))
    rows = rows.withColumn("pin", F.array_min(F.transform(pin, lambda s: s["lo"])))
    rows = rows.withColumn("pinned", F.col("pin").isNotNull() & (F.col("verdict") == "dated"))
    supported = F.exists("spans", lambda s: s["route"] != "pin")
    rows = rows.withColumns({"supported": supported, "narrowed": F.when(F.col("pinned"), F.struct(low.alias("earliest"), high.alias("latest")))})
    rows = rows.withColumns({"earliest": F.when(F.col("pinned"), F.col("pin")).otherwise(low), "latest": F.when(F.col("pinned"), F.col("pin")).otherwise(high), "verdict": F.when(F.col("pinned"), "dated").otherwise(F.col("verdict"))})
    usable = F.filter("spans", lambda s: ((s["route"] != "pin") | F.col("pinned")) & (~F.col("pinned") | F.col("pin").between(s["lo"], s["hi"])))
    rows = rows.withColumn("spans", usable)
    showing = F.filter("spans", lambda s: F.col("latest").between(s["lo"], s["hi"]))
    unsourced = F.when(F.col("missing"), "transcript_evidence_not_found").otherwise("no_confirming_source")
    late = F.when(F.size("spans") == 0, unsourced).when(F.size(showing) == 0, "latest_day_unsourced")
    rows = rows.withColumn("reason", F.coalesce("early", late))
    confirmed = F.col("reason").isNull()
    published = confirmed & ((F.col("verdict") == "publication_only") | F.forall(showing, lambda s: s["publication"]))
    return rows.withColumns({"confirmed": confirmed, "publication_day": published, "from_evidenced": confirmed & F.exists("spans", lambda s: s["lo"] == F.col("earliest"))}).select(
        "recording", "dater", "place", "verdict", "earliest", "latest", "event", "narrowed", "eligible", "confirmed", "supported", "pinned", "publication_day", "from_evidenced", "spans", "reason"
    )


def merge_proposals(assessed: DataFrame, recordings: DataFrame) -> DataFrame:
    """One row for each recording with proposals: outcome (override, check or queue) and what it rests on.

    ``recordings``: recording, own_date, own_basis, fetched, named_years (of title and id) and
    shown (days that the daters' prompts showed). Columns: outcome, reason, day, earliest,
    lead, method, refined, overruled, days_apart.

    Confirmed proposals with several last days are a dater_disagreement, unless the earliest
    last day lies in all their ranges (it refines them) or is pinned by the talk and the
    others are later days of publication. The confirmed day must lie in the range of every
    other eligible proposal, but a dissenter that no source supports is overruled where the
    day is no day of publication. Without a confirmed proposal, two or more eligible ones
    agree if their last days are a week apart at most: the later one counts, unless the
    prompts showed it (agreement_on_shared_input). A year that the title names and the range
    misses (strong_year_conflict) and a date that the source states itself (own_date_stated,
    stated_date_contradicted) go to the queue as well. A dater that stands twice in a
    recording stops the job.
    """
    dater = F.struct("place", "dater", "verdict", "earliest", "latest", "event", "eligible", "confirmed", "supported", "pinned", "publication_day", "from_evidenced", "reason")
    per = assessed.groupBy("recording").agg(F.array_sort(F.collect_list(dater)).alias("all"))
    twice = F.size("all") > F.size(F.array_distinct(F.transform("all", lambda a: a["dater"])))
    per = per.where(F.when(twice, F.raise_error(F.concat(F.lit("one proposal for each dater, but two are of recording "), F.col("recording").cast("string"))).cast("boolean")).otherwise(True))
    rows = per.join(recordings.select("recording", "own_date", "own_basis", F.coalesce("own_date", "fetched").alias("bound"), "named_years", "shown"), "recording")

    days = lambda xs: F.array_distinct(F.transform(xs, lambda a: a["latest"]))
    rows = rows.withColumn("sure", F.filter("all", lambda a: a["confirmed"]))
    rows = rows.withColumn("n_days", F.size(days(F.col("sure"))))
    width = lambda a: F.struct(a["latest"].alias("latest"), F.datediff(a["latest"], a["earliest"]).alias("width"), a["place"].alias("place"))
    inner = F.array_min(F.transform("sure", width))
    rows = rows.withColumn("inner", inner)
    fits = (F.size("sure") > 1) & F.forall("sure", lambda a: F.col("inner.latest").between(a["earliest"], a["latest"]))
    rows = rows.withColumns({"fits": fits, "pins": F.filter("sure", lambda a: a["pinned"]), "rest": F.filter("sure", lambda a: ~a["pinned"])})
    rows = rows.withColumn("refines", F.col("fits") & (F.col("n_days") > 1))
    pin_day = F.get(F.col("pins"), F.lit(0))["latest"]
    outranks = ~F.col("refines") & (F.col("n_days") > 1) & (F.size(days(F.col("pins"))) == 1) & (F.size("rest") > 0) & F.forall("rest", lambda a: a["publication_day"] & (a["latest"] > pin_day))
    rows = rows.withColumn("outranks", F.coalesce(outranks, F.lit(False)))
    lead = F.when(F.col("fits"), F.get(F.filter("sure", lambda a: a["place"] == F.col("inner.place")), F.lit(0))).when(F.col("outranks"), F.get(F.col("pins"), F.lit(0))).otherwise(F.get(F.col("sure"), F.lit(0)))
    rows = rows.withColumn("lead", lead)
    who = lambda xs: F.transform(xs, lambda a: a["dater"])
    refined = F.when(F.col("refines"), who(F.filter("sure", lambda a: a["latest"] != F.col("lead.latest")))).when(F.col("outranks"), who(F.col("rest"))).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("refined", refined)
    out_of_range = lambda a: a["eligible"] & (a["place"] != F.col("lead.place")) & ~F.col("lead.latest").between(a["earliest"], a["latest"])
    rows = rows.withColumn("against", F.filter("all", lambda a: out_of_range(a) & ~(F.col("outranks") & F.array_contains("refined", a["dater"]))))
    yields = ~F.col("lead.publication_day")
    rows = rows.withColumns({"overruled": F.when(yields, who(F.filter("against", lambda a: ~a["supported"]))).otherwise(F.array().cast("array<string>")), "blocking": F.when(yields, F.filter("against", lambda a: a["supported"])).otherwise(F.col("against"))})

    last, first = F.array_max(days(F.col("all"))), F.array_min(days(F.col("all")))
    rows = rows.withColumns({"last": last, "apart": F.datediff(last, first)})
    agreed = (F.size("sure") == 0) & (F.size("all") >= 2) & F.forall("all", lambda a: a["eligible"]) & (F.col("apart") <= NEAR_DAYS)
    rows = rows.withColumn("agreed", F.coalesce(agreed, F.lit(False)))
    named = F.get(F.filter("all", lambda a: a["latest"] == F.col("last")), F.lit(0))
    rows = rows.withColumn("found", F.size("sure") > 0)
    rows = rows.withColumns({"day": F.when(F.col("found"), F.col("lead.latest")).when(F.col("agreed"), F.col("last")), "from": F.when(F.col("found"), F.col("lead.earliest")).when(F.col("agreed"), F.array_min(F.transform("all", lambda a: a["earliest"])))})
    years = F.when(F.size("named_years") > 0, ~F.exists("named_years", lambda y: y.between(F.year("from"), F.year("day"))))
    reasons = F.array_distinct(F.transform("all", lambda a: a["reason"]))
    disagree = F.col("found") & ((F.col("n_days") > 1) & ~F.col("refines") & ~F.col("outranks") | (F.size("blocking") > 0))
    shared = F.col("agreed") & ((F.col("last") == F.col("bound")) | F.array_contains(F.coalesce("shown", F.array().cast("array<date>")), F.col("last")))
    stated = F.col("own_basis") == "stated_in_page"
    reason = first_reason([
        (disagree, "dater_disagreement"), (shared, "agreement_on_shared_input"), (F.col("day").isNotNull() & years, "strong_year_conflict"),
        (F.col("day").isNotNull() & stated & (F.col("day") == F.col("own_date")), "own_date_stated"), (F.col("day").isNotNull() & stated, "stated_date_contradicted"),
    ])
    reason = F.coalesce(reason, F.when(F.col("day").isNull(), F.when(F.size(reasons) == 1, F.get(reasons, F.lit(0))).otherwise("no_confirmation")))
    rows = rows.withColumn("reason", reason)
    ok = F.col("reason").isNull()
    only = lambda c: F.when(ok, c)
    return rows.select(
        "recording",
        F.when(~ok, "queue").when(F.col("own_date") == F.col("day"), "check").otherwise("override").alias("outcome"),
        "reason",
        only(F.col("day")).alias("day"),
        only(F.col("from")).alias("earliest"),
        only(F.when(F.col("found"), F.col("lead.dater"))).alias("lead"),
        only(F.when(F.col("found"), "source_confirmed").otherwise("two_agent_agreement")).alias("method"),
        only(F.when(F.col("found"), F.col("lead.event")).otherwise(named["event"])).alias("event"),
        only(F.array_join("refined", ",")).alias("refined"),
        only(F.array_join(F.when(F.col("found"), F.col("overruled")).otherwise(F.array().cast("array<string>")), ",")).alias("overruled"),
        only(F.when(~F.col("found"), F.col("apart"))).alias("days_apart"),
    )
