"""Records of claims: what accepts them, which state they are in, what they add up to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: The gates of a record.
GATES = ("forecast", "subject", "resolvable", "dated", "material")


def all_true(gates: Column) -> Column:
    """Every gate of a struct or map of booleans is true; a null gate is not."""
    return F.forall(F.map_values(gates), lambda g: F.coalesce(g, F.lit(False)))


def extraction_qualifies(gates: Column, criteria: Column) -> Column:
    return all_true(gates) & (F.coalesce(F.trim(criteria), F.lit("")) != "")


def verification_qualifies(status: Column, gates: Column, attribution: Column, faithful: Column) -> Column:
    """Null unless the verifier answered."""
    return F.when(status == "ok", F.coalesce(all_true(gates) & (attribution == "subject") & faithful, F.lit(False)))


def accepted(extraction: Column, verification: Column, holds: Column) -> Column:
    """Both qualify and nothing holds the date; a record without a list of holds is judged without."""
    return extraction & F.coalesce(verification, F.lit(False)) & (F.coalesce(F.size(holds), F.lit(0)) <= 0)


def date_precision(earliest: Column, latest: Column) -> Column:
    """day, days, months or years by how far apart both are; a range that ends before it starts stops the job."""
    gap = F.datediff(latest, earliest)
    wrong = F.raise_error(F.lit("a range that ends before it starts")).cast("string")
    return F.when(gap < 0, wrong).when(gap == 0, "day").when(gap <= 31, "days").when(gap <= 366, "months").otherwise("years")


def upload_date(raw: Column) -> Column:
    """A date of YYYYMMDD; a malformed one stops the job, null stays."""
    day = F.try_to_timestamp(raw, F.lit("yyyyMMdd")).cast("date")
    bad = F.raise_error(F.concat(F.lit("malformed upload date: "), raw)).cast("date")
    return F.when(raw.isNull(), F.lit(None).cast("date")).when(~raw.rlike(r"^\d{8}$") | day.isNull(), bad).otherwise(day)


def to_utc(raw: Column) -> Column:
    """A moment in UTC of several spellings: with Z, with an offset, without one, a day alone; else null."""
    z = F.regexp_replace(raw, r"[zZ]$", "+00:00")
    forms = ("yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")
    at = F.coalesce(*[F.try_to_timestamp(z, F.lit(f)) for f in forms])
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def years_since_one(day: Column) -> Column:
    """The proleptic day number of a date in years of 365.25 days."""
    return (F.datediff(day, F.lit("0001-01-01").cast("date")) + 1) / 365.25


def yearless(month: Column, day: Column, anchor: Column) -> Column:
    """The latest such day of a year that is not after the anchor; 29 February only where the year has one."""
    at = lambda back: F.try_to_timestamp(F.format_string("%04d-%02d-%02d", F.year(anchor) - back, month, day), F.lit("yyyy-MM-dd")).cast("date")
    return F.coalesce(*[F.when(at(b) <= anchor, at(b)) for b in range(9)])


def expected_points(p: Column, q: Column) -> Column:
    """What a forecast of q may expect under the prior p: nothing for q = p, else a loss."""
    clamp = lambda c: F.least(F.lit(0.99), F.greatest(F.lit(0.01), c))
    p, q = clamp(p), clamp(q)
    return p * F.log2(q / p) + (1 - p) * F.log2((1 - q) / (1 - p))


def state(withdrawn: Column, restated: Column, deadline: Column, as_of: Column, testable: Column, resolved: Column, scored: Column) -> Column:
    """The first that holds of a record: withdrawn, restated, no_deadline, not_due, not_testable, awaiting, unresolvable, scored.

    A score without a resolution stops the job.
    """
    bad = F.raise_error(F.lit("scored without a resolution")).cast("string")
    out = F.when(withdrawn, "withdrawn").when(restated, "restated").when(deadline.isNull(), "no_deadline").when(deadline > as_of, "not_due").when(~testable, "not_testable")
    return out.when(resolved.isNull() & scored, bad).when(resolved.isNull(), "awaiting").when(scored, "scored").otherwise("unresolvable")


def year_axis(rows: DataFrame, by: str, day: str, least: int) -> DataFrame:
    """(by, year, n): counts by year without gaps, from the first year with ``least`` rows in all to the last.

    Rows before are in the year -1, rows without a day in the year null. Years of a calendar are few.
    """
    dated = rows.groupBy(by, F.year(day).alias("y")).agg(F.count("*").alias("c"))
    years = dated.where("y is not null").groupBy("y").agg(F.sum("c").alias("c"))
    ends = years.agg(F.min(F.when(F.col("c") >= least, F.col("y"))).alias("lo"), F.max("y").alias("hi"))  # one row
    axis = ends.select(F.explode(F.sequence("lo", "hi")).alias("year"))
    groups = rows.select(by).distinct()
    spread = dated.crossJoin(F.broadcast(ends)).withColumn("year", F.when(F.col("y") < F.col("lo"), -1).otherwise(F.col("y"))).groupBy(by, "year").agg(F.sum("c").alias("c"))
    full = groups.crossJoin(F.broadcast(axis))  # a row for each year
    shown = full.join(spread, [by, "year"], "left").select(by, "year", F.coalesce("c", F.lit(0)).alias("n"))
    return shown.unionByName(spread.where("year is null or year = -1").select(by, "year", F.col("c").alias("n")))


def digest_of(lines: Column) -> Column:
    """SHA-256 of a group's lines in their order."""
    return F.sha2(F.array_join(F.array_sort(F.collect_list(lines)), "\n"), 256)


def reconciled(total: Column, parts: Column) -> Column:
    """The total; parts that do not add up to it stop the job."""
    return F.when(total != parts, F.raise_error(F.lit("the parts do not add up")).cast("long")).otherwise(total)
