"""Forecasts: eligibility, log scores, reliability, per-person ranking, as-of joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillboard.operators.rater import r6

LEAST_LEAD = 60
CLAMP_LOW, CLAMP_HIGH = 0.01, 0.99
BINS = 5  # of equal width; the last one holds 1 as well


def flags(rows: DataFrame) -> DataFrame:
    """Adds lead, before, spec_ok, lead_ok, eligible and the first failing clause."""
    out = rows.withColumn("lead", F.datediff("deadline", "said")).withColumn("before", F.col("deadline") < F.col("said")).withColumn("spec_ok", F.col("kind") != "error").withColumn("lead_ok", F.col("lead") >= LEAST_LEAD)
    out = out.withColumn("eligible", F.coalesce(~F.col("before") & F.col("spec_ok") & F.col("lead_ok"), F.lit(False)))
    return out.withColumn("reason", F.when(F.col("before"), "deadline_before_statement").when(~F.col("spec_ok"), "specificity").when(F.col("deadline").isNull(), "undated").when(~F.col("lead_ok"), "lead_under_floor").otherwise("eligible"))


def points(occurred: Column, p: Column, q: Column) -> Column:
    """Log score against the baseline p of a forecast of q: log2 of the ratio of what came true."""
    clamp = lambda c: F.least(F.lit(CLAMP_HIGH), F.greatest(F.lit(CLAMP_LOW), c))
    p, q = clamp(p), clamp(q)
    return F.when(occurred, F.log2(q / p)).otherwise(F.log2((1 - q) / (1 - p)))


def scored(rows: DataFrame) -> DataFrame:
    """Resolved forecasts with q, occurred and points: a purchase is a hit, an error unresolved."""
    rows = rows.where("kind <> 'error'").withColumn("occurred", F.col("kind") == "purchase").withColumn("q", F.least(F.lit(0.99), F.col("p") + 0.1))
    return rows.withColumn("points", points(F.col("occurred"), F.col("p"), F.col("q")))


def person_scores(rows: DataFrame, floor: int = 3) -> DataFrame:
    per = rows.groupBy("person").agg(F.count("*").alias("n_scored"), r6(F.avg("points")).alias("mean_points"), r6(F.sum("points")).alias("sum_points"), r6(F.avg(F.col("occurred").cast("double"))).alias("hit_rate"), r6(F.avg("p")).alias("mean_p"))
    order = Window.partitionBy(F.col("n_scored") >= floor).orderBy(F.desc("mean_points"), "person")
    return per.withColumn("rank", F.when(F.col("n_scored") >= floor, F.row_number().over(order)))


def reliability(rows: DataFrame) -> DataFrame:
    """A row for each bin of p, empty ones too."""
    edge = lambda k: k / BINS
    bins = rows.sparkSession.range(BINS).select(F.col("id").cast("int").alias("bin"), (F.col("id") / BINS).alias("lo"), ((F.col("id") + 1) / BINS).alias("hi"))
    binned = rows.withColumn("bin", sum((F.when(F.col("p") >= edge(k), 1).otherwise(0) for k in range(1, BINS)), F.lit(0)).cast("int"))
    per = binned.groupBy("bin").agg(F.count("*").alias("n"), r6(F.avg("p")).alias("mean_p"), r6(F.avg(F.col("occurred").cast("double"))).alias("hit_rate"), r6(F.avg("points")).alias("mean_points"))
    return bins.join(per, "bin", "left").select("bin", "lo", "hi", F.coalesce("n", F.lit(0)).alias("n"), "mean_p", "hit_rate", r6(F.col("hit_rate") - F.col("mean_p")).alias("gap"), "mean_points")


def latest_before(rows: DataFrame) -> DataFrame:
    """Each row with the value of the same person's last row strictly before it (the first on equal times).

    A range window over one person's rows; no join.
    """
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    earlier = Window.partitionBy("person").orderBy(micros).rangeBetween(Window.unboundedPreceding, -1)
    least = F.max(F.struct(F.col("ts"), (-F.col("id")).alias("k"), F.col("value").alias("v"))).over(earlier)
    return rows.select("id", "person", F.round(least["v"], 6).alias("prior_value"), (-least["k"]).alias("prior_id"))


def join_outcomes(rows: DataFrame, resolutions: DataFrame, priors: DataFrame, withdrawn: DataFrame, restated: DataFrame, stale_before: Column) -> DataFrame:
    """Each forecast with its resolution, its prior and the first reason why it does not score.

    All sides meet on id by equi joins. Precedence: withdrawn, restated, not eligible, stale,
    no resolution, already public, unresolvable, no prior; else scored.
    """
    out = rows.join(resolutions, "id", "left").join(priors, "id", "left")
    out = out.join(withdrawn.select("id").distinct().withColumn("withdrawn", F.lit(True)), "id", "left").join(restated.select("id").distinct().withColumn("restated", F.lit(True)), "id", "left")
    why = F.when(F.col("withdrawn"), "withdrawn").when(F.col("restated"), "restated").when(~F.col("eligible"), F.concat(F.lit("not_eligible:"), F.col("reason")))
    why = why.when(F.col("judged") < stale_before, "stale").when(F.col("outcome").isNull(), "no_resolution").when(F.col("public"), "already_public")
    return out.withColumn("state", why.when(F.col("outcome") == "unresolvable", "unresolvable").when(F.col("prior").isNull(), "no_prior").otherwise("scored"))
