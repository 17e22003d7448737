"""Checks before anything is published: contracts, releases, schemas, dates that hold a record, and who speaks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from quillboard.operators import deadlines as dl
from quillboard.operators.vocabulary import parts

#: Fixed value: words that stand for a year that nobody named.
PLACEHOLDER = r"\b(?:statement\s+year|the\s+(?:calendar\s+)?year\s+(?:following|after|of)\s+the\s+(?:recording|statement))\b"
KEYWORDS = {"type", "const", "enum", "required", "properties", "items", "minimum", "maximum", "minLength", "maxLength", "title", "description"}


def incompatible(rows: DataFrame, key: str, wanted: dict[str, str], people: DataFrame) -> DataFrame:
    """(problem, n, example): rows of another study, contract or identity, or of an unknown person; the example is the smallest key."""
    rows = rows.join(people.select("person").distinct().withColumn("known", F.lit(True)), "person", "left")
    found = [F.when(~F.col(c).eqNullSafe(F.lit(v)), c) for c, v in wanted.items()] + [F.when(F.col("known").isNull(), "person")]
    return rows.select(key, F.explode(F.array_compact(F.array(*found))).alias("problem")).groupBy("problem").agg(F.count("*").alias("n"), F.min(key).alias("example"))


def one_contract(rows: DataFrame, contract: str, allow: bool = False) -> DataFrame:
    """The rows; more than one known contract among them stops the job unless allowed. A null contract is none."""
    n = rows.agg(F.count_distinct(contract).alias("contracts"))  # one row
    bad = F.when((F.col("contracts") > 1) & F.lit(not allow), F.raise_error(F.lit("more than one contract")).cast("boolean")).otherwise(F.lit(True))
    return rows.crossJoin(F.broadcast(n)).where(bad).drop("contracts")


def releases(rows: DataFrame, stage: str, release: str, allowed: list[str]) -> DataFrame:
    """(stage, release, n); a release that is not listed, or none, stops the job."""
    listed = F.when(F.coalesce(F.col(release).isin(*allowed), F.lit(False)), F.col(release)).otherwise(F.raise_error(F.concat(F.lit("unlisted release: "), F.coalesce(F.col(release), F.lit("none")))).cast("string"))
    return rows.groupBy(stage, listed.alias(release)).agg(F.count("*").alias("n"))


def date_holds(said: Column, earliest: Column, phrase: Column, target: Column, texts: dict[str, Column], doubts: dict[str, Column], read: Column) -> Column:
    """Why a record's date must be settled first: doubts, placeholder years, and a year that its words don't give.

    ``read`` is the deadline that the words give. A target of an earlier year was resolved against
    another date; more than a year later "this year" and "next year" have no excuse.
    """
    named = phrase.rlike(dl.YEAR_NAMED)
    years = phrase.rlike(f"(?i){dl.THIS_YEAR}") | phrase.rlike(f"(?i){dl.NEXT_YEAR}")
    gap = F.substring(target, 1, 4).try_cast("int") - F.year(read)
    crossing = dl.crosses_new_year(said, earliest, phrase)
    rules = [F.when(d == "recording_older", f"statement_date_doubt:{s}") for s, d in doubts.items()]
    rules += [F.when(said.isNotNull() & ~t.rlike(dl.YEAR_NAMED) & t.rlike(f"(?i){PLACEHOLDER}"), f"placeholder_date:{n}") for n, t in texts.items()]
    rules.append(F.when(crossing, "relative_year_on_ambiguous_range").when(~named & (years | phrase.rlike(f"(?i){dl.NUMBER}")) & ((gap < 0) | (years & (gap > 1))), "relative_year_mismatch"))
    return F.array_compact(F.array(*rules))


def exact_statement_date(basis: Column, ranged: Column, publication_only: Column, two_agents: Column) -> Column:
    """Whether a statement's day is known itself: from its page, or sourced without a range and not from publication or agreement alone."""
    return F.coalesce((basis == "stated_in_page") | ((basis == "sourced_override") & ~ranged & ~publication_only & ~two_agents), F.lit(False))


def identity_verdict(named: Column, alone: Column, about: Column, voice: Column) -> Column:
    """reject where the text is about the person or another speaks; review where another signal fails; an unknown voice is none."""
    return F.when(~about | ~F.coalesce(voice, F.lit(True)), "reject").when(~named | ~alone, "review").otherwise("pass")


def year_evidence(rows: DataFrame, key: str) -> DataFrame:
    """(key, verdict, year, votes): the year that a recording's sources (source, text) name, each source once for each year.

    agreed with two votes for the only leading year, single with one, conflict where years tie, none without any.
    """
    found = rows.select(key, "source", F.explode_outer(F.array_distinct(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"(?<!\d)((?:19|20)\d{2})(?!\d)"), 1))).alias("year")).distinct()
    votes = found.groupBy(key, "year").agg(F.count("*").alias("votes"))
    per = votes.groupBy(key).agg(F.max(F.when(F.col("year").isNotNull(), F.col("votes"))).alias("top"), F.array_sort(F.collect_list(F.when(F.col("year").isNotNull(), F.struct("votes", "year")))).alias("all"))
    lead = F.filter("all", lambda v: v["votes"] == F.col("top"))
    verdict = F.when(F.col("top").isNull(), "none").when(F.size(lead) > 1, "conflict").when(F.col("top") >= 2, "agreed").otherwise("single")
    return per.select(key, verdict.alias("verdict"), F.when(F.size(lead) == 1, F.get(lead, F.lit(0))["year"].cast("int")).alias("year"), F.coalesce("top", F.lit(0)).alias("votes"))


def in_dictionary(words: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(word, known): as it stands, or without -ies (for y), -es or -s."""
    forms = F.array_compact(F.array(F.col("word"), F.when(F.col("word").endswith("ies"), F.concat(F.expr("left(word, length(word) - 3)"), F.lit("y"))), F.when(F.col("word").endswith("es"), F.expr("left(word, length(word) - 2)")), F.when(F.col("word").endswith("s"), F.expr("left(word, length(word) - 1)"))))
    n = parts(words.sparkSession)
    spelt = words.select("word").distinct().select("word", F.explode(forms).alias("form")).repartition(n, "form")
    told = spelt.join(dictionary.select(F.col("word").alias("form")).distinct().withColumn("hit", F.lit(True)), "form", "left")
    return told.select("word", "hit").repartition(n, "word").groupBy("word").agg(F.coalesce(F.bool_or("hit"), F.lit(False)).alias("known"))


def schema_errors(value: Column, schema: dict, path: str = "$") -> Column:
    """Errors of a nested value against a subset of JSON Schema, as an array of texts; an unknown keyword is an error of the schema.

    Types are those of Spark's schema; null stands for a missing property.
    """
    if unknown := set(schema) - KEYWORDS:
        raise ValueError(f"{path}: unsupported keywords {sorted(unknown)}")
    rules: list[Column] = []
    say = lambda bad, what: F.when(F.coalesce(bad, F.lit(False)), f"{path}: {what}")
    if "const" in schema:
        rules.append(say(value != schema["const"], "const"))
    if "enum" in schema:
        rules.append(say(~value.isin(*schema["enum"]), "enum"))
    for word, of, test in (("minimum", value, lambda a, b: a < b), ("maximum", value, lambda a, b: a > b), ("minLength", F.length(value), lambda a, b: a < b), ("maxLength", F.length(value), lambda a, b: a > b)):
        if word in schema:
            rules.append(say(test(of, schema[word]), word))
    for name in schema.get("required", []):
        rules.append(say(value.isNotNull() & value[name].isNull(), f"missing required {name}"))
    out = F.array_compact(F.array(*rules)) if rules else F.array().cast("array<string>")
    below = [schema_errors(value[n], s, f"{path}.{n}") for n, s in schema.get("properties", {}).items()]
    if "items" in schema:
        below.append(F.flatten(F.transform(F.coalesce(value, F.array().cast("array<string>") if schema["items"].get("type") == "string" else value), lambda x: schema_errors(x, schema["items"], f"{path}[]"))))
    return reduce(F.concat, [F.coalesce(b, F.array().cast("array<string>")) for b in below], out)


def publication_floor(count: Column, previous: Column) -> Column:
    """A board may not shrink: publish where it holds as many as the last one, or there was none."""
    return F.when(previous.isNull() | (count >= previous), "publish").otherwise("refuse")


#: The share of what is there that may go at once, and the number from which that share is looked at.
MOST_PRUNED, GUARDED_FROM = 0.25, 10


def prune_orphans(derived: DataFrame, grades: DataFrame, written: DataFrame, shelf: DataFrame, rejected: DataFrame, key: list[str], mode: str, most: float = MOST_PRUNED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(derived, grades, report): what stays of derived rows and what becomes of their grades.

    A derived row goes if this run did not write it and it is ``rejected`` or no longer on the
    ``shelf``. Grades of this ``mode`` for rows that go are kept, marked orphaned. If ten rows or more and
    over ``most`` of all would go, nothing does: the report says refused and how many there would have been.
    The counts are one row, worked out before anything is taken away.
    """
    keys = lambda df, name: df.select(*key).distinct().withColumn(name, F.lit(True))
    seen = derived.join(keys(written, "w"), key, "left").join(keys(shelf, "s"), key, "left").join(keys(rejected, "r"), key, "left")
    stale = F.col("w").isNull() & (F.col("r").isNotNull() | F.col("s").isNull())
    seen = seen.withColumn("stale", stale).drop("w", "s", "r")
    count = seen.agg(F.count("*").alias("examined"), F.count_if("stale").alias("withdrawn"))
    count = count.withColumn("refused", (F.col("withdrawn") >= GUARDED_FROM) & (F.col("withdrawn") > F.col("examined") * most))
    told = seen.crossJoin(F.broadcast(count.select("refused")))  # one row
    gone = told.where("stale and not refused").select(*key).distinct().withColumn("gone", F.lit(True))
    left = told.where("not stale or refused").drop("stale", "refused")
    marked = grades.join(gone, key, "left").withColumn("orphaned", F.coalesce(F.col("gone") & (F.col("mode") == mode), F.lit(False))).drop("gone")
    orphans = marked.agg(F.count_if("orphaned").alias("orphaned_grades"))
    report = count.crossJoin(F.broadcast(orphans)).select(F.lit(mode).alias("mode"), "examined", F.when(F.col("refused"), 0).otherwise(F.col("withdrawn")).alias("pruned"), "refused", F.when(F.col("refused"), F.col("withdrawn")).alias("would_have_pruned"), "orphaned_grades")
    return left, marked, report


def contract_id(components: Column) -> Column:
    """Sixteen hex digits of the SHA-256 of a JSON text in canonical form: keys in order, no spaces, letters as they are.

    A text that is no JSON has no id.
    """
    return F.substring(F.sha2(F.to_json(F.try_parse_json(components)).cast("binary"), 256), 1, 16)
