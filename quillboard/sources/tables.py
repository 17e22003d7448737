"""Readers, and the roles that the test tables play: ratings, forecasts, transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quillboard.sources.shared import stored


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per rating: person, rec, judge, mode, run, three dimensions, coverage, share, venue, day.

    The run counts repeats of a (recording, judge, mode) cell; the window is over a cell, so
    no key gathers more than a cell's repeats.
    """
    cell = Window.partitionBy("l_partkey", "l_returnflag", "l_linestatus").orderBy("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    rows = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(
        F.col("p_brand").alias("person"),
        F.col("l_partkey").alias("rec"),
        F.col("l_returnflag").alias("judge"),
        F.col("l_linestatus").alias("mode"),
        (F.row_number().over(cell) - 1).alias("run"),
        F.col("l_quantity").alias("d1"),
        (F.col("l_discount") * 1000).alias("d2"),
        (F.col("l_tax") * 1000).alias("d3"),
        (F.col("l_discount") * 10).alias("coverage"),
        F.col("l_quantity").alias("share"),
        F.concat(F.lit("v"), (F.col("l_suppkey") % 5).cast("string")).alias("venue"),
        F.to_date("l_shipdate").alias("day"),
    )


def first_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings of run 0, numbered once for all that is made of them."""
    return stored(ratings(spark, sf_dir).where("run = 0"), "first")


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per forecast: id, person, said, horizon days, deadline, p, outcome."""
    e = read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("person"),
        "ts",
        F.to_date("ts").alias("said"),
        k.alias("horizon"),
        F.date_add(F.to_date("ts"), k).alias("deadline"),
        F.least(F.lit(0.99), F.greatest(F.lit(0.01), F.col("value") / 500)).alias("p"),
        F.col("event_type").alias("kind"),
        F.col("value").alias("value"),
    )


#: How the claims of the test tables name their time; {n} and {m} are numbers of the row.
PHRASES = [
    "in {n} years", "{n} to {m} months", "every year for {n} years", "{n} or more years", "within a few weeks", "next year", "over the next year",
    "by the first half of next year", "by the end of this year", "when the merger closes", "before 2031", None, "in the coming weeks", "soon",
    "a couple more months", "{n} days", "someday", "in my lifetime", "at least {n} years", "in the coming months, soon",
]
CLAIMS = ["if rates fall, sales will grow", "sales will grow", "it ships before the rival does", "it is paid annually", "prices stay higher", "the plant opens before the end of the year"]
FORMS = [None, "simple", "simple", None, "conditional", "ordering", None, "recurring"]
CATEGORIES = ["company_business", "technology_product", "policy_regulation", "economy", "science"]


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per claim: id, person, said, the first day it may have been said, and how it names its time.

    target is a stated year, month or day, malformed, or null; years a horizon that was inferred.
    """
    o = read(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    pick = lambda of, at: F.element_at(F.array(*[F.lit(x) for x in of]), (at % len(of) + 1).cast("int"))
    said, n = F.to_date("o_orderdate"), c % 15 + 1
    phrase = F.replace(F.replace(pick(PHRASES, k), F.lit("{n}"), n.cast("string")), F.lit("{m}"), (n + c % 7).cast("string"))
    form = F.substring("o_orderpriority", 1, 1)
    day = F.add_months(said, (c % 30).cast("int"))
    target = F.when(form == "1", F.date_format(day, "yyyy")).when(form == "2", F.date_format(day, "yyyy-MM")).when(form == "3", F.date_format(day, "yyyy-MM-dd")).otherwise("by then")
    return o.select(
        k.alias("id"),
        c.alias("person"),
        said.alias("said"),
        F.when(k % 4 == 0, F.date_sub(said, (c % 40).cast("int"))).alias("earliest"),
        phrase.alias("phrase"),
        F.when(k % 3 == 0, target).alias("target"),
        F.when(k % 11 == 0, n * 0.5).cast("double").alias("years"),
        F.when(k % 9 == 0, F.lit("we expect that shortly")).otherwise("we expect that").alias("quote"),
        pick(CLAIMS, k + c).alias("claim"),
        F.when(k % 13 == 0, F.lit("holds over decades")).otherwise(F.lit("holds")).alias("criteria"),
        pick(FORMS, c).alias("form"),
        pick(CATEGORIES, c).alias("category"),
        F.when(F.col("o_orderstatus") == "F", "own").when(F.col("o_orderstatus") == "O", "other").alias("control"),
        F.when(c % 4 == 0, "high").when(c % 4 == 1, "medium").when(c % 4 == 2, "low").alias("specificity"),
    )


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per turn of a conversation: key, place from 0, speaker and its words with the mark of its minute in front."""
    c = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.trim(F.regexp_replace("text", r"\s+", " ")).alias("words"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "words")
    c = c.withColumn("k", F.row_number().over(order) - 1)
    return c.select("conv_id", "k", "role", "words", F.format_string("[%02d:%02d:00]", F.floor(F.col("k") / 60).cast("int"), (F.col("k") % 60).cast("int")).alias("mark"))


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation: its turns as one text with marks."""
    per = turns(spark, sf_dir).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("k", F.concat_ws(" ", "mark", "words").alias("t")))).alias("t"))
    return per.select("conv_id", F.array_join("t.t", "\n").alias("text"))
