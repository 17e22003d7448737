"""Pages: dates and bodies that a page's own data name, excerpts, labels, days of moments."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quillboard.functions import text as tx

LD = r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"
NEXT = r"(?is)<script[^>]*id=\"__NEXT_DATA__\"[^>]*>(.*?)</script>"


def owned_dates(page: Column) -> Column:
    """(published, uploaded, state) of the page's linked data: of the one object that has a transcript.

    state: ok, none without such an object, ambiguous with several; moments are in UTC, broken
    data count as none.
    """
    kind = "struct<transcript: string, datePublished: string, uploadDate: string>"
    objects = F.filter(F.transform(F.regexp_extract_all(F.coalesce(page, F.lit("")), F.lit(LD), 1), lambda t: F.from_json(t, kind)), lambda o: o["transcript"].isNotNull())
    utc = lambda t: F.date_format(F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd")]), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    one = F.when(F.size(objects) == 1, F.get(objects, F.lit(0)))
    state = F.when(F.size(objects) == 0, "none").when(F.size(objects) > 1, "ambiguous").otherwise("ok")
    return F.struct(utc(one["datePublished"]).alias("published"), utc(one["uploadDate"]).alias("uploaded"), state.alias("state"))


def block_text(page: Column) -> Column:
    """The text of the blocks of a page's embedded rich text, a line each; null where the page embeds none."""
    kind = "struct<blocks: array<struct<children: array<struct<text: string>>>>>"
    doc = F.from_json(F.nullif(F.regexp_extract(page, NEXT, 1), F.lit("")), kind)
    return F.array_join(F.transform(doc["blocks"], lambda b: F.array_join(b["children"]["text"], "")), "\n")


def excerpt_place(page_text: Column, excerpt: Column) -> Column:
    """Where an excerpt stands among a page's words, both normalised; 0 where it does not."""
    padded = lambda t: F.concat(F.lit(" "), tx.normalised(t), F.lit(" "))
    return F.when(tx.normalised(excerpt) == "", 0).otherwise(F.locate("\u0000", F.replace(padded(page_text), padded(excerpt), F.lit("\u0000"))))


def zone_day(at: Column, zone: Column, spoken: Column) -> Column:
    """The day of a moment: where it was spoken, or in UTC for a publication."""
    return F.to_date(F.when(spoken, F.from_utc_timestamp(at, zone)).otherwise(at))


def consensus_errors(cutoff: Column, observed: Column, age: Column, yes: Column, claim: Column, inverse: Column) -> Column:
    """Rules of a stored market price: seen before the cutoff, its age right, turned around where it must be."""
    rules = [("after_cutoff", observed >= cutoff), ("age", age != F.unix_timestamp(cutoff) - F.unix_timestamp(observed)), ("direction", F.abs(claim - F.when(inverse, 1 - yes).otherwise(yes)) > 1e-6), ("range", ~yes.between(0, 1))]
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), n) for n, c in rules]))
