"""The registered queries: operators applied to the whole tables in their roles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quillboard.functions import dates as dt, text as tx
from quillboard.operators import forecast as fc, intervals as iv, rater as rt, transcript as tr
from quillboard.operators.rater import r6
from quillboard.sources.tables import first_ratings, forecasts, ratings, read
from quillboard.streaming.arrivals import daily_cells

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def board_calibrated(spark, d):
    cal = rt.calibrated(ratings(spark, d)).where("mode = 'F'")
    return rt.board(rt.consensus(cal))


@query
def calibration_params(spark, d):
    return rt.calibration(ratings(spark, d)).select("judge", "mode", "dim", "jm", "js", "pm", "ps", "n", "rescaled")


@query
def share_filter(spark, d):
    return rt.share_filter(ratings(spark, d), 25).select("rec", r6(F.col("mean_share")).alias("mean_share"), "min_share", "kept")


@query
def complete_panels(spark, d):
    return rt.panel_cells(ratings(spark, d))


@query
def bucket_conservation(spark, d):
    return rt.exclusion_bucket(ratings(spark, d), 25).groupBy("bucket").agg(F.count("*").alias("n"), F.count_distinct("rec").alias("recordings"))


@query
def consensus_spread(spark, d):
    c = rt.consensus(rt.calibrated(ratings(spark, d)))
    return c.select("person", "rec", "mode", r6(F.col("d1")).alias("d1"), r6(F.col("overall")).alias("overall"), r6(F.col("coverage")).alias("coverage"), "judges", r6(F.when(F.col("judges") > 1, F.col("spread"))).alias("spread"))


@query
def venue_vote(spark, d):
    return rt.venue_vote(ratings(spark, d))


@query
def venue_support(spark, d):
    """Per venue: rows, people, and whether it has the support to be adjusted for."""
    per = ratings(spark, d).where("run = 0").groupBy("venue").agg(F.count("*").alias("n"), F.count_distinct("person").alias("people"))
    return per.withColumn("supported", (F.col("n") >= 8) & (F.col("people") >= 3))


@query
def leave_one_venue_out(spark, d):
    """Person means without each venue: totals less the venue's own part, no second scan."""
    cells = ratings(spark, d).where("run = 0").groupBy("person", "venue").agg(F.sum("d1").alias("s"), F.count("*").alias("k"))
    whole = cells.groupBy("person").agg(F.sum("s").alias("ts"), F.sum("k").alias("tk"))
    left = cells.join(whole, "person").withColumn("mean_without", (F.col("ts") - F.col("s")) / F.nullif(F.col("tk") - F.col("k"), F.lit(0)))
    order = Window.partitionBy("venue").orderBy(F.desc(F.round("mean_without", 6)), "person")
    return left.select("venue", "person", r6(F.col("mean_without")).alias("mean_without"), r6(F.col("mean_without") - F.col("ts") / F.col("tk")).alias("shift"), F.row_number().over(order).alias("rank"))


@query
def leader_rollup(spark, d):
    c = rt.consensus(rt.calibrated(ratings(spark, d))).groupBy("person", "mode")
    out = c.agg(F.count("*").alias("n"), r6(F.avg("d1")).alias("d1"), r6(F.stddev_pop("d1")).alias("sd"), r6(F.avg("coverage")).alias("coverage"), F.max("judges").alias("judges"))
    return out.withColumn("confidence", F.when(F.col("judges") < 2, "low").when(F.col("n") >= 5, "high").when(F.col("n") >= 3, "medium").otherwise("low"))


@query
def halo_pairs(spark, d):
    g = ratings(spark, d).where("run = 0")
    a = g.where("mode = 'O'").select("rec", "judge", F.col("d1").alias("open"))
    b = g.where("mode = 'F'").select("rec", "judge", F.col("d1").alias("blind"))
    return a.join(b, ["rec", "judge"]).groupBy("judge").agg(F.count("*").alias("n"), r6(F.avg(F.col("open") - F.col("blind"))).alias("halo"), r6(F.stddev_samp(F.col("open") - F.col("blind"))).alias("sd"))


@query
def judge_pair_agreement(spark, d):
    return rt.judge_pairs(ratings(spark, d).where("run = 0"))


@query
def icc_ccc_loa(spark, d):
    """Lin's concordance and limits of agreement of each pair of judges over recordings that both rated."""
    per = ratings(spark, d).where("run = 0").groupBy("rec", "judge").agg(F.avg("d1").alias("v"))
    a, b = per.select("rec", F.col("judge").alias("judge_a"), F.col("v").alias("x")), per.select("rec", F.col("judge").alias("judge_b"), F.col("v").alias("y"))
    gap = F.col("x") - F.col("y")
    s = a.join(b, "rec").where("judge_a < judge_b").groupBy("judge_a", "judge_b")
    s = s.agg(F.count("*").alias("n"), F.covar_pop("x", "y").alias("c"), F.var_pop("x").alias("vx"), F.var_pop("y").alias("vy"), F.avg("x").alias("mx"), F.avg("y").alias("my"), F.avg(gap).alias("bias"), F.stddev_samp(gap).alias("sd"))
    return s.select("judge_a", "judge_b", "n", r6(2 * F.col("c") / (F.col("vx") + F.col("vy") + F.pow(F.col("mx") - F.col("my"), F.lit(2)))).alias("ccc"), r6(F.col("bias")).alias("bias"), r6(F.col("bias") - 1.96 * F.col("sd")).alias("loa_low"), r6(F.col("bias") + 1.96 * F.col("sd")).alias("loa_high"))


@query
def sample_icc(spark, d):
    return rt.one_way_icc(ratings(spark, d).where("run = 0"), "person", "d1")


@query
def repeatability(spark, d):
    g = ratings(spark, d).groupBy("judge", "mode")
    return g.agg(F.count("*").alias("n"), r6(F.avg("d1")).alias("mean"), r6(F.stddev_samp("d1")).alias("sd"), F.min("d1").alias("low"), F.max("d1").alias("high"), r6(100 * F.stddev_samp("d1") / F.avg("d1")).alias("cv"), r6(2.77 * F.stddev_samp("d1")).alias("lsd"))


@query
def retest(spark, d):
    """First and second run of the same cell, matched within one grouping rather than a self join."""
    cells = ratings(spark, d).where("run < 2").groupBy("rec", "judge", "mode").agg(F.max(F.when(F.col("run") == 0, F.col("d1"))).alias("x"), F.max(F.when(F.col("run") == 1, F.col("d1"))).alias("y")).where("y is not null")
    return cells.groupBy("judge").agg(F.count("*").alias("n"), r6(F.corr("x", "y")).alias("r"), r6(F.avg(F.col("y") - F.col("x"))).alias("drift"), r6(F.stddev_samp(F.col("y") - F.col("x"))).alias("sd"))


@query
def ols_fit(spark, d):
    """Slope, intercept, standard error, t and 95 % interval of prices on quantities for each judge."""
    g = read(spark, d, "lineitem").select(F.col("l_returnflag").alias("judge"), F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"))
    return rt.ols(g, "judge", "x", "y").select("judge", "n", *[r6(F.col(c)).alias(c) for c in ("slope", "intercept", "r2", "se", "t", "lo", "hi")])


@query
def era_slope(spark, d):
    """Pooled slope of the score on years within persons: sums per person, then one row."""
    years = F.datediff("day", F.lit("1992-01-01").cast("date")) / 365.25
    g = ratings(spark, d).where("run = 0").withColumn("t", years).groupBy("person").agg(F.count("*").alias("n"), F.sum("t").alias("st"), F.sum("d1").alias("sy"), F.sum(F.col("t") * F.col("d1")).alias("sty"), F.sum(F.col("t") * F.col("t")).alias("stt"))
    return g.agg(F.sum("n").alias("n"), F.round(F.sum(F.expr("sty - st * sy / n")) / F.sum(F.expr("stt - st * st / n")), 6).alias("slope"))


@query
def drift_gate(spark, d):
    """Latest less earliest run of each repeated cell, by judge, with an equivalence verdict at 2 points."""
    c = ratings(spark, d).groupBy("rec", "judge", "mode").agg(F.max_by("d1", "run").alias("late"), F.min_by("d1", "run").alias("early"), F.max("run").alias("last")).where("last > 0")
    g = c.groupBy("judge").agg(F.count("*").alias("n"), F.avg(F.col("late") - F.col("early")).alias("m"), (F.stddev_samp(F.col("late") - F.col("early")) / F.sqrt(F.count("*"))).alias("se"))
    lo, hi = F.col("m") - 1.645 * F.col("se"), F.col("m") + 1.645 * F.col("se")
    return g.select("judge", "n", r6(F.col("m")).alias("drift"), r6(lo).alias("lo"), r6(hi).alias("hi"), F.when((lo > -2) & (hi < 2), "PASS").when((lo >= 2) | (hi <= -2), "FAIL").otherwise("INCONCLUSIVE").alias("verdict"))


@query
def judge_lean(spark, d):
    """Judge less the mean of the other judges of the same recording, over recordings that the whole panel judged."""
    per = ratings(spark, d).where("run = 0 and mode = 'F'").select("rec", "judge", "d1")
    w = Window.partitionBy("rec")
    panel = per.agg(F.count_distinct("judge").alias("panel"))  # one row
    full = per.select("rec", "judge", "d1", F.sum("d1").over(w).alias("s"), F.count("*").over(w).alias("k")).crossJoin(F.broadcast(panel)).where("k = panel")
    return full.groupBy("judge").agg(F.count("*").alias("n"), r6(F.avg(F.col("d1") - (F.col("s") - F.col("d1")) / (F.col("k") - 1))).alias("lean"))


@query
def coverage_gate(spark, d):
    """Persons with the recordings that have any rating, a blinded one, and all judges' ones."""
    g = ratings(spark, d)
    per = g.groupBy("person", "rec").agg(F.count_if(F.col("mode") == "F").alias("blind"), F.count_distinct("judge").alias("judges")).crossJoin(F.broadcast(g.agg(F.count_distinct("judge").alias("panel"))))  # one row
    return per.groupBy("person").agg(F.count("*").alias("recordings"), F.count_if(F.col("blind") > 0).alias("blinded"), F.count_if(F.col("judges") == F.col("panel")).alias("full"))


@query
def incidence_skew(spark, d):
    """Share of ratings under the filter, by judge and mode and in all (grouping sets), against the whole."""
    g = ratings(spark, d).groupingSets([["judge", "mode"], ["judge"], []], "judge", "mode")
    return g.agg(F.count("*").alias("n"), F.count_if(F.col("share") < 5).alias("rejected")).select("judge", "mode", "n", "rejected", r6(F.col("rejected") / F.col("n")).alias("rate"))


@query
def eligibility(spark, d):
    f = fc.flags(forecasts(spark, d))
    return f.groupBy("reason").agg(F.count("*").alias("n"), r6(F.avg("lead")).alias("mean_lead"), F.count_if("eligible").alias("eligible"))


@query
def deadline_span(spark, d):
    """Deadlines by calendar: horizon months for even horizons, days times 1.5 rounded to even otherwise."""
    f = forecasts(spark, d)
    deadline = F.when(F.col("horizon") % 2 == 0, F.add_months("said", F.col("horizon"))).otherwise(F.date_add("said", F.bround(F.col("horizon") * 1.5, 0).cast("int")))
    return f.select("id", "said", "horizon", deadline.alias("deadline"))


@query
def log_score(spark, d):
    s = fc.scored(forecasts(spark, d))
    return s.select("id", "person", r6(F.col("p")).alias("p"), r6(F.col("q")).alias("q"), "occurred", r6(F.col("points")).alias("points"))


@query
def person_scores(spark, d):
    return fc.person_scores(fc.scored(forecasts(spark, d)))


@query
def reliability(spark, d):
    return fc.reliability(fc.scored(forecasts(spark, d)))


@query
def separation(spark, d):
    s = fc.scored(forecasts(spark, d))
    return s.agg(F.count("*").alias("n"), r6(F.avg(F.when(F.col("occurred"), F.col("p")))).alias("p_if_hit"), r6(F.avg(F.col("p") * F.col("p")) / F.avg("p")).alias("expected"), r6(F.avg(F.when(F.col("occurred"), F.col("p"))) - F.avg(F.col("p") * F.col("p")) / F.avg("p")).alias("excess"))


@query
def unresolvable_split(spark, d):
    f = fc.flags(forecasts(spark, d)).where("kind in ('error', 'signup')")
    return f.cube("eligible", "kind").agg(F.count("*").alias("n")).select("eligible", "kind", "n")


@query
def asof_market(spark, d):
    return fc.latest_before(forecasts(spark, d))


@query
def market_window(spark, d):
    f = forecasts(spark, d)
    cut = F.lit("2024-02-15").cast("date")
    return f.withColumn("state", F.when(F.col("said") >= cut, "opens_late").when(F.col("deadline") < cut, "closed").otherwise("open")).groupBy("person", "state").agg(F.count("*").alias("n"), F.min("deadline").alias("first_deadline"))


@query
def year_cells(spark, d):
    o = read(spark, d, "orders")
    return o.groupBy("o_orderpriority", F.year("o_orderdate").cast("long").alias("year")).agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("people"))


@query
def record_summary(spark, d):
    o = read(spark, d, "orders").join(read(spark, d, "customer").select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    return o.rollup("c_mktsegment").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.count_if(F.col("o_orderstatus") == "O").alias("open"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query
def breadth_first(spark, d):
    """Depth of each document among its source's, fewest-first order: hashed ranges keep a hot source out of one task."""
    docs = read(spark, d, "documents").select("doc_id", "source", (F.col("doc_id") / 1000).cast("long").alias("range"))
    tally = docs.groupBy("source", "range").agg(F.count("*").alias("k"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tally.select("source", "range", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("source", "range").orderBy("doc_id")
    return docs.join(offsets, ["source", "range"]).select("doc_id", "source", (F.col("before") + F.row_number().over(within)).alias("depth"))


@query
def stratified_sample(spark, d):
    """Top five of each source and language by salted digest: a sampling operator."""
    docs = read(spark, d, "documents").select("doc_id", "source", "lang", F.sha2(F.concat(F.lit("salt:"), F.col("doc_id").cast("string")), 256).alias("h"))
    w = Window.partitionBy("source", "lang").orderBy("h", "doc_id")
    return docs.withColumn("k", F.row_number().over(w)).where("k <= 5").select("source", "lang", "doc_id", "k")


@query
def qa_signals(spark, d):
    """Signals of each text; its ratio of types is reported only, as it falls with length."""
    docs = read(spark, d, "documents").select("doc_id", tx.tokens(F.col("text")).alias("w"))
    n = F.size("w").cast("long")
    s = docs.select("doc_id", n.alias("words"), r6(tx.type_token_ratio(F.col("w"))).alias("ttr"), F.size(F.filter("w", lambda x: F.length(x) >= 12)).cast("long").alias("long_words"), r6(tr.loop_share(F.col("w"))).alias("loop_share"))
    return s.withColumn("verdict", F.when((F.col("words") < tr.LEAST_WORDS) | (F.col("loop_share") > tr.MOST_LOOP), "reject").otherwise("pass"))


@query
def mattr(spark, d):
    docs = read(spark, d, "documents").select("doc_id", tx.tokens(F.col("text")).alias("w"))
    return docs.select("doc_id", r6(tx.moving_ttr(F.col("w"), 1000, 250)).alias("mattr"))


@query
def name_density(spark, d):
    """The name of a text's person per thousand words after the first 12 %; 0 under 200 words.

    A source's name is here the first word of four letters or more of its first document.
    """
    docs = read(spark, d, "documents").select("doc_id", "source", tx.tokens(F.col("text")).alias("w"))
    names = docs.groupBy("source").agg(F.min_by(F.get(F.filter("w", lambda x: F.length(x) >= 4), F.lit(0)), "doc_id").alias("name"))
    rest = F.slice("w", F.floor(F.size("w") * 0.12).cast("int") + 1, F.size("w"))
    hits = F.size(F.filter(rest, lambda x: x == F.col("name")))
    return docs.join(names, "source").select("doc_id", F.when(F.size("w") < 200, 0.0).otherwise(r6(1000.0 * F.coalesce(hits, F.lit(0)) / F.size(rest))).alias("density"))


def _passages(spark, d, text):
    """Documents' word places where a passage of ``text`` begins: its first six words (all of a shorter one) meet as one hash and are confirmed word by word."""
    quotes = read(spark, d, "benchmark").select("item_id", F.split(tx.normalised(F.col("text")), " ").alias("q")).where(F.get("q", F.lit(0)) != "")
    quotes = quotes.select("item_id", "q", F.least(F.lit(6), F.size("q")).alias("k"), F.xxhash64(F.slice("q", 1, 6)).alias("key"))
    sizes = sorted(r["k"] for r in quotes.select("k").distinct().collect())  # six at most
    docs = read(spark, d, "documents").select("doc_id", F.split(tx.normalised(F.col("text")), " ").alias("w"))
    runs = lambda k: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - k + 1)), lambda i: F.struct(i.alias("at"), F.xxhash64(F.slice("w", i, F.lit(k))).alias("key")))
    keys = docs.select("doc_id", F.explode_outer(F.concat(*[runs(k) for k in sizes]) if sizes else F.array().cast("array<struct<at: int, key: bigint>>")).alias("r")).select("doc_id", "r.*")
    hits = keys.join(quotes, "key").select("doc_id", "at", "item_id", "q").distinct()
    return hits.join(docs, "doc_id").where(F.slice("w", F.col("at"), F.size("q")) == F.col("q")).select("doc_id", "item_id", F.col("at").alias("start"), (F.col("at") + F.size("q")).alias("end"))


@query
def quote_ground(spark, d):
    """Documents that hold each benchmark passage, of whatever length, and how often it stands there."""
    found = _passages(spark, d, "text")
    return found.groupBy("item_id").agg(F.count_distinct("doc_id").alias("documents"), F.min("doc_id").alias("first_doc"), F.count("*").alias("places"))


@query
def digest(spark, d):
    docs = read(spark, d, "documents")
    return docs.select("doc_id", F.substring(F.sha2(F.concat(F.col("doc_id").cast("string"), F.lit("\n"), tx.normalised(F.col("text"))), 256), 1, 16).alias("digest"))


@query
def speaker_ranges(spark, d):
    """Token ranges of each turn of a conversation; a range ends where the next one starts."""
    c = read(spark, d, "conversations").select("conv_id", "turn", "role", F.size(F.split(F.trim(F.regexp_replace("text", "\\s+", " ")), " ")).cast("long").alias("n"))
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "n").rowsBetween(Window.unboundedPreceding, -1)
    return c.select("conv_id", "turn", "role", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("start"), "n")


@query
def invariants(spark, d):
    """Named failures of documents and labels, counted."""
    docs, labels = read(spark, d, "documents"), read(spark, d, "labels")
    rows = docs.join(labels, "doc_id", "left").select(F.array_compact(F.array(F.when(F.col("n_chars") != F.length("text"), "length"), F.when(F.col("quality").isNull(), "unlabelled"), F.when(F.col("toxic") == 1, "toxic"), F.when(~F.col("lang").isin("de", "en", "es", "fr"), "language"))).alias("failed"))
    return rows.select(F.explode("failed").alias("invariant")).groupBy("invariant").agg(F.count("*").alias("n"))


@query
def arrival_watermark(spark, d):
    return daily_cells(spark, f"{d}/events.parquet")


@query
def window_freeze(spark, d):
    """A forecast's first row fixes its window: first deadline by person and kind, and how many later ones differ."""
    first = forecasts(spark, d).groupBy("person", "kind").agg(F.min_by("deadline", F.struct("ts", "id")).alias("deadline"), F.count("*").alias("n"), F.count_distinct("deadline").alias("windows"))
    return first


@query
def board_bootstrap(spark, d, draws: int = 100):
    """Interval of each person's mean value by resampling with digest draws; endpoints are order statistics."""
    rows = forecasts(spark, d).select("person", "id", F.col("value").alias("num"), F.lit(1.0).alias("den"))
    ci = iv.ratio_interval(rows, "person", "id", draws, 0.1)
    return ci.select("person", F.col("units").alias("n"), r6(F.col("lo")).alias("lo"), r6(F.col("hi")).alias("hi"))


@query
def venue_effects(spark, d):
    """Over blinded recordings whose judges agree on the venue."""
    g = first_ratings(spark, d)
    agreed = rt.venue_vote(g).where("agreed").select("rec", "venue")
    return rt.venue_effects(rt.consensus(rt.calibrated(g).where("mode = 'F'")).join(agreed, "rec"), "overall")


@query
def search_rate_gate(spark, d):
    """Rate of events worth over 100 by kind for even and odd users, with a verdict on their difference at 5 points."""
    left = F.col("person") % 2 == 0
    x = F.when(F.col("value") > 100, 100.0).otherwise(0.0)
    per = forecasts(spark, d).groupBy(F.col("kind").alias("judge")).agg(*[a for side, of in (("left", left), ("right", ~left)) for a in (F.count_if(of).alias(f"n_{side}"), F.avg(F.when(of, x)).alias(f"r_{side}"), F.var_samp(F.when(of, x)).alias(f"v_{side}"))])
    gap, se = F.col("r_left") - F.col("r_right"), F.sqrt(F.col("v_left") / F.col("n_left") + F.col("v_right") / F.col("n_right"))
    lo, hi = gap - 1.645 * se, gap + 1.645 * se
    return per.select("judge", "n_left", "n_right", r6(F.col("r_left")).alias("rate_left"), r6(F.col("r_right")).alias("rate_right"), r6(gap).alias("gap"), r6(se).alias("se"), F.when((lo > -5) & (hi < 5), "PASS").when((lo >= 5) | (hi <= -5), "FAIL").otherwise("INCONCLUSIVE").alias("verdict"))


@query
def deadline_stated(spark, d):
    """Order dates as years, months, days, another form or nothing, read back to the last day that they name."""
    form = lambda f: F.date_format("o_orderdate", f)
    kind = F.substring("o_orderpriority", 1, 1)
    stated = F.when(kind == "1", form("yyyy")).when(kind == "2", form("yyyy-MM")).when(kind == "3", form("yyyy-MM-dd")).when(kind == "4", form("dd.MM.yyyy"))
    deadline, note = dt.stated_deadline(F.col("stated"))
    return read(spark, d, "orders").select("o_orderkey", stated.alias("stated")).select("o_orderkey", "stated", deadline.alias("deadline"), note.alias("note"))


@query
def dates_in_text(spark, d):
    """Dates named in a note on each order: one row for each, in order."""
    form = lambda f: F.date_format("o_orderdate", f)
    note = F.concat(F.lit("Placed on "), form("MMMM d, yyyy"), F.lit(" in "), form("MMMM yyyy"), F.lit(", billed "), form("yyyy-MM-dd"), F.lit(" for "), form("yyyy-MM"), F.lit(" of "), form("yyyy"), F.lit(", due "), form("d MMMM yyyy"), F.lit(", account 4994"), F.col("o_custkey").cast("string"))
    found = read(spark, d, "orders").select("o_orderkey", F.posexplode(dt.dates_in(note)).alias("k", "found"))
    year, month, day = dt.date_parts(F.col("found"))
    return found.select("o_orderkey", "k", "found", year.alias("year"), month.alias("month"), day.alias("day"))


@query
def outcome_join(spark, d):
    f = fc.flags(forecasts(spark, d))
    o = read(spark, d, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "yes").when(F.col("o_orderstatus") == "O", "no").otherwise("unresolvable")
    resolutions = o.select(F.col("o_orderkey").alias("id"), status.alias("outcome"), F.to_date("o_orderdate").alias("judged"), (F.col("o_orderpriority") == "1-URGENT").alias("public"))
    priors = read(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("id"), (F.col("c_acctbal") / 10000).alias("prior"))
    withdrawn = read(spark, d, "labels").where("toxic = 1").select(F.col("doc_id").alias("id"))
    restated = read(spark, d, "part").where("p_size > 40").select(F.col("p_partkey").alias("id"))
    j = fc.join_outcomes(f, resolutions, priors, withdrawn, restated, F.lit("1993-06-01").cast("date"))
    return j.groupBy("state").agg(F.count("*").alias("n"), F.count_distinct("person").alias("people"), r6(F.avg(F.when(F.col("state") == "scored", F.col("prior")))).alias("mean_prior"))


@query
def schedule_blocks(spark, d):
    """Rounds over languages and sources in digest order, ten of each to a block.

    Ranks come from counts of digest prefixes and ranks within one: a hot source is spread.
    """
    docs = read(spark, d, "documents").select("doc_id", "source", "lang", F.md5(F.col("doc_id").cast("string")).alias("h")).withColumn("b", F.substring("h", 1, 3))
    tally = docs.groupBy("source", "lang", "b").agg(F.count("*").alias("k"))
    before = Window.partitionBy("source", "lang").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tally.select("source", "lang", "b", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("source", "lang", "b").orderBy("h", "doc_id")
    placed = docs.join(offsets, ["source", "lang", "b"]).select("doc_id", "source", "lang", (F.col("before") + F.row_number().over(within)).alias("round"))
    return placed.withColumn("block", F.floor((F.col("round") - 1) / 10))


@query
def ngram_run(spark, d):
    return read(spark, d, "documents").select("doc_id", tx.tokens(F.col("text")).alias("w")).select("doc_id", tr.longest_gram_run(F.col("w")).alias("run"))


@query
def stutter_collapse(spark, d):
    return tr.stutter(read(spark, d, "documents"), "doc_id", tx.words(F.col("text")))


@query
def replay_share(spark, d):
    return tr.replay_share(read(spark, d, "documents"), "doc_id", tx.tokens(F.col("text")))


@query
def near_dup_pairs(spark, d):
    return tr.containment_pairs(read(spark, d, "documents"), "doc_id", "lang", tx.tokens(F.col("text")))


@query
def sound_groups(spark, d):
    """Distinct words of the conversations by their consonants."""
    w = read(spark, d, "conversations").select(F.explode(tx.tokens(F.col("text"))).alias("word")).distinct()
    return w.groupBy(tx.consonant_skeleton(F.col("word")).alias("sound")).agg(F.count("*").alias("words"), F.min("word").alias("first"), F.max("word").alias("last"))


@query
def span_dedupe(spark, d):
    """Spans of documents where benchmark passages stand; near-identical ones once."""
    spans = _passages(spark, d, "text").withColumnRenamed("item_id", "id")
    return tr.distinct_spans(spans, "doc_id").select("doc_id", "spans", F.explode("kept").alias("s")).select("doc_id", "spans", F.col("s.id").alias("item_id"), F.col("s.s").alias("start"), F.col("s.e").alias("end"))


@query
def html_text(spark, d):
    return read(spark, d, "pages").select("page_id", tr.page_digest("html").alias("t")).select("page_id", "t.*")


@query
def qa_gate(spark, d):
    """The gate as far as the tables have its columns."""
    return tr.gate(read(spark, d, "documents"), "doc_id", "text")
