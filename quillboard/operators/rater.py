"""Ratings by several judges: filters, calibration, consensus, board, agreement."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from quillboard.functions.special import two_sided_t
from quillboard.sources.shared import shared_folder, stored

DIMENSIONS = ("d1", "d2", "d3")
WEIGHTS = {"d1": 0.4, "d2": 0.35, "d3": 0.25}
LEAST_SD, LEAST_ROWS, LEAST_COVERAGE, RANK_FLOOR = 3.0, 25, 0.05, 5


def r6(c: Column) -> Column:
    return F.round(c, 6)


def exact_mean(c: Column) -> Column:
    """The mean of decimals as they are written, rounded half up to six places: no order of sums moves it."""
    return F.round(F.avg(c.cast("decimal(20,16)")), 6).cast("double")


def means_in_order(rows: DataFrame, by: str, order: list[str], value: Column, **others: Column) -> DataFrame:
    """(by, mean, others): the mean of doubles added one by one in an order, rounded as a product with a million is.

    Where a mean is a half of the sixth place the order of the sum decides its last digit. A running
    sum reads a group in its order row by row, however long it is; ``others`` are aggregates of the same rows.
    """
    so_far = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = rows.withColumn("__v", value).withColumn("__sum", F.sum("__v").over(so_far)).withColumn("__k", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
    mean = F.max_by("__sum", "__k") / F.nullif(F.count("__v"), F.lit(0))
    return running.groupBy(by).agg((F.round(mean * 1e6) / 1e6).alias("mean"), *[c.alias(n) for n, c in others.items()])


def share_filter(grades: DataFrame, cutoff: float = 10) -> DataFrame:
    """(rec, mean_share, min_share, kept): a recording goes when its subject hardly speaks."""
    per = grades.groupBy("rec").agg(F.avg("share").alias("mean_share"), F.min("share").alias("min_share"))
    return per.withColumn("kept", ~F.coalesce((F.col("mean_share") < cutoff) | (F.col("min_share") == 0), F.lit(False)))


def panel_cells(grades: DataFrame) -> DataFrame:
    """(rec, cells, panel, complete): relational division; a repeat fills no cell."""
    panel = grades.select("judge", "mode").distinct().agg(F.count("*").alias("panel"))
    cells = grades.groupBy("rec").agg(F.count_distinct(F.when(F.col("run") == 0, F.struct("judge", "mode"))).alias("cells"))
    return cells.crossJoin(F.broadcast(panel)).withColumn("complete", F.col("cells") == F.col("panel"))  # one row


def exclusion_bucket(grades: DataFrame, cutoff: float = 10) -> DataFrame:
    """Each rating with the first bucket that takes it: repeat, partial_panel, unscorable, usable."""
    marks = panel_cells(grades).select("rec", "complete").join(share_filter(grades, cutoff).select("rec", "kept"), "rec")
    return grades.join(marks, "rec").withColumn("bucket", F.when(F.col("run") > 0, "repeat").when(~F.col("complete"), "partial_panel").when(~F.col("kept"), "unscorable").otherwise("usable"))


def calibration(grades: DataFrame) -> DataFrame:
    """Per (judge, mode, dim): judge and pooled mean and population sd, and whether to rescale."""
    long = grades.where("run = 0").unpivot(["judge", "mode"], list(DIMENSIONS), "dim", "raw")
    both = long.rollup("mode", "dim", "judge").agg(F.grouping_id().alias("level"), F.round(F.avg("raw"), 2).alias("m"), F.round(F.stddev_pop("raw"), 2).alias("s"), F.count("raw").alias("n"))
    own = both.where("level = 0").select("judge", "mode", "dim", F.col("m").alias("jm"), F.col("s").alias("js"), "n")
    pooled = both.where("level = 1").select("mode", "dim", F.col("m").alias("pm"), F.col("s").alias("ps"))
    return own.join(F.broadcast(pooled), ["mode", "dim"]).withColumn("rescaled", (F.col("js") >= LEAST_SD) & (F.col("n") >= LEAST_ROWS))  # modes x dims rows


def calibrated(grades: DataFrame) -> DataFrame:
    """Run-0 ratings with each dimension rescaled to the pooled distribution of its mode."""
    params = calibration(grades)
    wide = params.groupBy("judge", "mode").agg(*[F.max(F.when(F.col("dim") == d, F.struct("jm", "js", "pm", "ps", "rescaled"))).alias(f"c_{d}") for d in DIMENSIONS])
    rows = grades.where("run = 0").join(F.broadcast(wide), ["judge", "mode"])  # judges x modes rows

    def scaled(d: str) -> Column:
        c = F.col(f"c_{d}")
        moved = c["pm"] + (F.col(d) - c["jm"]) * c["ps"] / c["js"]
        return F.when(c["rescaled"], F.least(F.lit(100.0), F.greatest(F.lit(1.0), moved))).otherwise(F.col(d))

    return rows.select("person", "rec", "judge", "mode", "coverage", "venue", "day", *[scaled(d).alias(d) for d in DIMENSIONS])


def consensus(rows: DataFrame) -> DataFrame:
    """Per (person, rec, mode): mean dimensions, overall, coverage, judges, spread of d1."""
    per = rows.groupBy("person", "rec", "mode").agg(
        *[F.avg(d).alias(d) for d in DIMENSIONS], F.avg("coverage").alias("coverage"), F.count_distinct("judge").alias("judges"), (F.max("d1") - F.min("d1")).alias("spread")
    )
    return per.withColumn("overall", sum((F.col(d) * w for d, w in WEIGHTS.items()), F.lit(0.0)))


def weighted_mean(value: str, weight: str = "coverage") -> Column:
    w = F.greatest(F.col(weight), F.lit(LEAST_COVERAGE))
    return F.sum(F.col(value) * w) / F.nullif(F.sum(w), F.lit(0.0))


def board(recordings: DataFrame, floor: int = RANK_FLOOR) -> DataFrame:
    """Coverage-weighted person means, ranked where there are ``floor`` recordings.

    The window is over the board: a row for each person.
    """
    people = recordings.groupBy("person").agg(F.count("*").alias("n"), r6(weighted_mean("overall")).alias("overall"))
    order = Window.partitionBy(F.col("n") >= floor).orderBy(F.desc("overall"), "person")
    return people.withColumn("rank", F.when(F.col("n") >= floor, F.row_number().over(order)))


def venue_vote(grades: DataFrame) -> DataFrame:
    """(rec, venue, votes, agreed): most votes, ties to the first name; agreed unless tied."""
    votes = grades.where("run = 0").groupBy("rec", "venue").agg(F.count("*").alias("votes"))
    best = votes.groupBy("rec").agg(F.min(F.struct((-F.col("votes")).alias("less"), "venue")).alias("b"), F.max("votes").alias("votes"), F.array_agg("votes").alias("all"))
    return best.select("rec", "b.venue", "votes", (F.size(F.filter("all", lambda v: v == F.col("votes"))) == 1).alias("agreed"))


def judge_pairs(recordings: DataFrame, value: str = "d1") -> DataFrame:
    """Agreement of each pair of judges over recordings: n, Pearson r (null under 3), mean gap."""
    per = recordings.groupBy("rec", "judge").agg(F.avg(value).alias("v"))
    a, b = per.select("rec", F.col("judge").alias("judge_a"), F.col("v").alias("x")), per.select("rec", F.col("judge").alias("judge_b"), F.col("v").alias("y"))
    both = a.join(b, "rec").where("judge_a < judge_b").groupBy("judge_a", "judge_b")
    return both.agg(F.count("*").alias("n"), r6(F.when(F.count("*") >= 3, F.corr("x", "y"))).alias("r"), r6(F.avg(F.abs(F.col("x") - F.col("y")))).alias("gap"))


def one_way_icc(rows: DataFrame, group: str, value: str) -> DataFrame:
    """One-way unbalanced ANOVA: groups, n, sd, ICC(1) not below 0; sums per group, then one row."""
    g = rows.groupBy(group).agg(F.count(value).alias("k"), F.sum(value).alias("s"), F.sum(F.col(value) * F.col(value)).alias("q"))
    t = g.agg(F.count("*").alias("m"), F.sum("k").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum(F.col("s") * F.col("s") / F.col("k")).alias("b"), F.sum(F.col("k") * F.col("k")).alias("kk"))
    msb, msw = "(b - s * s / n) / (m - 1)", "(q - b) / (n - m)"
    n0 = "(n - kk / n) / (m - 1)"
    return t.select(F.col("m").alias("groups"), "n", r6(F.expr("sqrt((q - s * s / n) / (n - 1))")).alias("sd"), r6(F.expr(f"greatest(0.0D, ({msb} - {msw}) / ({msb} + ({n0} - 1) * {msw}))")).alias("icc"))


def venue_effects(rows: DataFrame, value: str, least: int = 8, most_venues: int = 1000) -> DataFrame:
    """Points that a venue adds with the person held fixed: least squares of person + venue, centred, 3 places.

    Spark sums (person, venue) cells and reduces them to one row for each pair of venues, person
    effects eliminated; the driver solves that system, of at most `most_venues` squared. With more
    venues Spark alternates between the means of persons and of venues instead, to the same places.
    A venue of under `least` rows has no effect.
    """
    per = stored(rows.groupBy("person", "venue").agg(F.count("*").alias("n"), F.sum(value).alias("s")), "cells")
    size = per.groupBy("venue").agg(F.sum("n").alias("rows"), F.count("*").alias("people"))
    cells = per.join(size.where(F.col("rows") >= least).select("venue"), "venue")
    whole = Window.partitionBy("person")
    cells = cells.select("person", "venue", "n", F.col("n").cast("double").alias("x"), "s", F.sum("n").over(whole).alias("pn"), F.sum("s").over(whole).alias("ps"))
    right = cells.groupBy("venue").agg(F.sum("n").alias("n"), F.sum(F.col("s") - F.col("x") * F.col("ps") / F.col("pn")).alias("b"))
    names = [r["venue"] for r in right.select("venue").orderBy("venue").limit(most_venues + 1).collect()]
    if len(names) > most_venues:
        return size.join(_alternated(cells), "venue", "left").select("venue", F.col("rows").alias("n"), "people", F.coalesce("effect", F.lit(0.0)).alias("effect"))
    pairs = cells.select("person", "venue", "x", "pn").join(cells.select("person", F.col("venue").alias("other"), F.col("x").alias("y")), "person")
    at = {v: k for k, v in enumerate(names)}
    a, b = np.zeros((len(names), len(names))), np.zeros(len(names))
    for r in right.collect():
        a[at[r["venue"]], at[r["venue"]]] += r["n"]
        b[at[r["venue"]]] = r["b"]
    for r in pairs.groupBy("venue", "other").agg(F.sum(F.col("x") * F.col("y") / F.col("pn")).alias("c")).collect():
        a[at[r["venue"]], at[r["other"]]] -= r["c"]
    found = np.linalg.lstsq(a, b, rcond=None)[0] if len(names) > 1 else b * 0
    effects = rows.sparkSession.createDataFrame([(v, round(float(e - found.mean()), 3)) for v, e in zip(names, found, strict=True)], "venue string, effect double")
    return size.join(effects, "venue", "left").select("venue", F.col("rows").alias("n"), "people", F.coalesce("effect", F.lit(0.0)).alias("effect"))


def _alternated(cells: DataFrame, rounds: int = 1000, enough: float = 1e-5) -> DataFrame:
    """(venue, effect) of cells (person, venue, x, s) by alternating means, each round a table in the shared folder."""
    spark = cells.sparkSession
    folder = shared_folder(spark, "venues")

    def stored(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    cells = stored("cells", cells.select("person", "venue", "x", "s"))
    effects = stored("effects-0", cells.select("venue").distinct().withColumn("e", F.lit(0.0)))
    for turn in range(1, rounds + 1):
        people = cells.join(effects, "venue").groupBy("person").agg((F.sum(F.col("s") - F.col("x") * F.col("e")) / F.sum("x")).alias("p"))
        new = stored(f"effects-{turn}", cells.join(people, "person").groupBy("venue").agg((F.sum(F.col("s") - F.col("x") * F.col("p")) / F.sum("x")).alias("e")))
        moved = new.join(effects.withColumnRenamed("e", "before"), "venue").agg(F.max(F.abs(F.col("e") - F.col("before")))).first()[0]
        effects = new
        if moved is None or moved < enough:
            break
    centre = effects.agg(F.avg("e").alias("m"))  # one row
    return effects.crossJoin(F.broadcast(centre)).select("venue", F.round(F.col("e") - F.col("m"), 3).alias("effect"))


#: Critical t at 95 % by degrees of freedom; 1.96 beyond.
T_CRITICAL = {1: 12.706, 2: 4.303, 3: 3.182, 4: 2.776, 5: 2.571, 6: 2.447, 7: 2.365}


def ols(rows: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """key, n, slope, intercept, r2, se, t, p, lo, hi of y on x in each group.

    The error, t, its two-sided probability and the 95 % interval are null with two rows or fewer; without
    variation in x all are null. Sums combine before the shuffle.
    """
    s = rows.groupBy(key).agg(F.count("*").alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"), F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"), F.regr_sxy(y, x).alias("sxy"))
    s = s.withColumn("freedom", F.col("n") - 2)
    left = F.greatest(F.lit(0.0), F.col("syy") - F.col("sxy") * F.col("sxy") / F.nullif(F.col("sxx"), F.lit(0.0)))
    s = s.withColumn("se", F.when(F.col("freedom") > 0, F.sqrt(left / F.col("freedom") / F.nullif(F.col("sxx"), F.lit(0.0)))))
    critical = F.coalesce(F.create_map(*[F.lit(v) for pair in T_CRITICAL.items() for v in pair])[F.col("freedom").cast("int")], F.lit(1.96))
    s = s.withColumns({"t": F.col("slope") / F.nullif(F.col("se"), F.lit(0.0)), "lo": F.col("slope") - critical * F.col("se"), "hi": F.col("slope") + critical * F.col("se")})
    return s.withColumn("p", two_sided_t(F.col("t"), F.col("freedom"))).select(key, "n", "slope", "intercept", "r2", "se", "t", "p", "lo", "hi")


def venue_gate(recordings: DataFrame, least: int = 8, least_people: int = 3, least_mixed: float = 0.80) -> DataFrame:
    """One row (ok, venues, people, mixed_share, reasons): whether the corpus bears an adjustment for venues.

    ``recordings``: person and venue, null where unknown or disputed. Every venue needs ``least`` recordings and
    ``least_people`` people, and ``least_mixed`` of all people two venues or more. Reasons are sorted;
    without any known venue the only one is no_agreed_venue.
    """
    known = recordings.where("venue is not null")
    per = known.groupBy("venue").agg(F.count("*").alias("n"), F.count_distinct("person").alias("people"))
    thin = F.array_compact(F.array(F.when(F.col("n") < least, F.format_string("%s:rows", "venue")), F.when(F.col("people") < least_people, F.format_string("%s:people", "venue"))))
    venues = per.agg(F.count("*").alias("venues"), F.flatten(F.collect_list(thin)).alias("thin"))  # two reasons at most for each venue
    mixed = known.groupBy("person").agg(F.count_distinct("venue").alias("k")).agg(F.count("*").alias("people"), F.count_if(F.col("k") >= 2).alias("mixed"))
    one = venues.crossJoin(F.broadcast(mixed)).withColumn("mixed_share", r6(F.col("mixed") / F.nullif(F.col("people"), F.lit(0))))  # one row each
    short = F.when(F.col("mixed") < least_mixed * F.col("people"), F.array(F.lit("mixed_share"))).otherwise(F.array().cast("array<string>"))
    reasons = F.when(F.col("venues") == 0, F.array(F.lit("no_agreed_venue"))).otherwise(F.array_sort(F.concat("thin", short)))
    return one.select((F.size(reasons) == 0).alias("ok"), "venues", "people", "mixed_share", F.array_join(reasons, ",").alias("reasons"))


def venue_sensitivity(recordings: DataFrame, floor: int = RANK_FLOOR) -> DataFrame:
    """Per venue: what happens to the board without its recordings.

    ``recordings``: person, overall, coverage and venue (null where unknown or disputed: these stay in
    every run). dropped recordings of ranked people, people who had some, people still ranked, those
    below the floor, those whose rank changes, Spearman's correlation of the ranks (null under three
    people), the largest shift and whose it is, the mean shift. Ties keep the full board's order. Sums less a
    venue's own stand for a rescoring, so recordings are read once.
    """
    w = F.greatest("coverage", F.lit(LEAST_COVERAGE))
    rows = recordings.select("person", "venue", (F.col("overall") * w).alias("num"), w.alias("den"))
    whole = board(recordings, floor).where("rank is not null").select("person", "rank", F.col("overall").alias("full"), F.col("n").alias("all"))
    cells = stored(rows.groupBy("person", "venue").agg(F.count("*").alias("n"), F.sum("num").alias("num"), F.sum("den").alias("den")), "cells")
    totals = cells.groupBy("person").agg(F.sum("num").alias("t_num"), F.sum("den").alias("t_den")).join(whole, "person")
    names = cells.join(whole.select("person"), "person", "left_semi").where("venue is not null").agg(F.array_sort(F.collect_set("venue")).alias("venues"))  # one row
    each = totals.crossJoin(F.broadcast(names)).select("*", F.explode("venues").alias("venue")).drop("venues")
    each = each.join(cells.select("person", "venue", "n", "num", "den"), ["person", "venue"], "left").na.fill(0, ["n", "num", "den"])
    each = each.withColumns({"left": F.col("all") - F.col("n"), "without": r6((F.col("t_num") - F.col("num")) / F.nullif(F.col("t_den") - F.col("den"), F.lit(0.0)))}).withColumn("still", F.col("left") >= floor)
    placed = each.withColumns({
        "before": F.row_number().over(Window.partitionBy("venue", "still").orderBy("rank")),
        "after": F.row_number().over(Window.partitionBy("venue", "still").orderBy(F.desc("without"), "rank")),
        "shift": F.round(F.abs(F.col("without") - F.col("full")), 1),
    })
    on = lambda c: F.when(F.col("still"), c)
    m, gap = F.count_if("still"), on(F.pow(F.col("before") - F.col("after"), F.lit(2)))
    return placed.groupBy("venue").agg(
        F.sum("n").alias("dropped"), F.count_if(F.col("n") > 0).alias("people"), m.alias("still_ranked"), F.count_if(~F.col("still")).alias("below_floor"), F.count_if(F.col("still") & (F.col("before") != F.col("after"))).alias("changing"),
        F.when(m >= 3, F.round(1 - 6 * F.sum(gap) / (m * (m * m - 1)), 3)).alias("rho"), F.max(on(F.col("shift"))).alias("max_shift"), F.min_by("person", on(F.struct((-F.col("shift")).alias("s"), "rank"))).alias("max_shift_person"), F.round(F.avg(on(F.col("shift"))), 2).alias("mean_shift"),
    )


#: Fixed value: how many times another judge's rate makes a filter skewed.
SKEW = 3.0


def rejection_skew(rows: DataFrame, judge: str, rejected: Column) -> DataFrame:
    """One row (skewed, highest, lowest, high_rate, low_rate, ratio): whether a filter rejects judges unlike each other.

    Rates of a judge's own attempts, to four places. Skewed where one judge is never rejected and
    another is, or one three times as often as another; the first name stands for equal rates. With fewer than two judges, or no rejection, nothing is.
    """
    per = rows.groupBy(judge).agg(F.round(F.count_if(rejected) / F.count("*"), 4).alias("rate"))
    one = per.agg(F.count("*").alias("judges"), F.min(F.struct((-F.col("rate")).alias("r"), F.col(judge).alias("j"))).alias("hi"), F.min(F.struct(F.col("rate").alias("r"), F.col(judge).alias("j"))).alias("lo"))
    high, low = -F.col("hi.r"), F.col("lo.r")
    ratio = F.when(low > 0, F.round(high / low, 1))
    skewed = (F.col("judges") >= 2) & (high > 0) & ((low == 0) | (high / F.nullif(low, F.lit(0.0)) >= SKEW))
    return one.select(F.coalesce(skewed, F.lit(False)).alias("skewed"), F.col("hi.j").alias("highest"), F.col("lo.j").alias("lowest"), high.alias("high_rate"), low.alias("low_rate"), ratio.alias("ratio"))


def gaps_to_others(rows: DataFrame) -> DataFrame:
    """person, rec, judge, x: each judge's score (x) less the mean of the other judges', of recordings that the whole panel has judged."""
    w = Window.partitionBy("rec")
    panel = rows.agg(F.count_distinct("judge").alias("panel"))  # one row
    whole = rows.withColumns({"s": F.sum("x").over(w), "k": F.count("*").over(w)}).crossJoin(F.broadcast(panel)).where("k = panel and k > 1")
    return whole.select("person", "rec", "judge", (F.col("x") - (F.col("s") - F.col("x")) / (F.col("k") - 1)).alias("x"))
