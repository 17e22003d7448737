"""Texts without what names their subject: names, handles and affiliations in one longest-first pass.

The forms of a person are few and made by column expressions. Texts come sorted by subject, so a
task builds one automaton over a subject's forms and runs each of its texts through it once; of
matches that overlap the longest form goes first.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: What a blinded study writes, legal and generic words of company names, tails of spoken initials, and given names that are words as well.
SUBJECT, AFFILIATION = "[SUBJECT]", "[AFFILIATION]"
LEGAL = r"(?i)\b(inc|corp|corporation|technologies|technology|labs|group|holdings|plc|ltd|llc|co)\b\.?"
GENERIC = {
    "cloud", "platform", "platforms", "systems", "group", "holdings", "labs", "technologies", "technology", "software", "digital", "solutions", "networks", "the", "and", "inc", "corp", "corporation", "company", "ai",
    "data", "global", "international", "services", "products", "works", "studio", "studios", "media",
}
TAILS = ("Platform", "Services", "Systems")
NO_GIVEN_NAMES = {
    "will", "may", "mark", "grant", "frank", "guy", "jack", "art", "rich", "rob", "don", "pat", "ray", "max", "earl", "dean", "miles", "june", "the", "no", "sir", "lord", "grace", "king", "duke",
}
FORM = "struct<place: int, form: string, role: string, any_case: boolean, surname: boolean>"


def _words(text: Column, at: str = r"\s+") -> Column:
    return F.filter(F.split(F.btrim(text), at), lambda w: w != "")


def name_forms(name: Column) -> Column:
    """A name, its last two words, its last and its first: those of three letters or more."""
    w = _words(name)
    several = F.array(F.array_join(F.slice(w, -2, 2), " "), F.element_at(w, -1), F.element_at(w, 1))
    return F.filter(F.array_distinct(F.concat(F.array(F.btrim(name)), F.when(F.size(w) >= 2, several).otherwise(F.array().cast("array<string>")))), lambda v: F.length(v) > 2)


def company_forms(company: Column) -> Column:
    """A company's name, the name without legal words, those of its words that tell it, and initials that are spoken for it."""
    bare = F.btrim(F.regexp_replace(company, LEGAL, ""), F.lit(" ,."))
    parts = F.filter(_words(bare, r"[\s/&-]+"), lambda p: (F.length(p) >= 4) & ~F.lower(p).isin(*sorted(GENERIC)))
    forms = F.concat(F.array(F.btrim(company)), F.when(F.length(bare) > 2, F.array(bare)).otherwise(F.array().cast("array<string>")), parts)
    main = F.filter(_words(company, r"[\s/&-]+"), lambda p: ~F.lower(p).isin("the", "and", "of"))
    initials = F.upper(F.array_join(F.transform(main, lambda p: F.substring(p, 1, 1)), ""))
    spoken = F.when(F.size(main) >= 3, F.array(initials)).when(F.size(main) == 2, F.array(*[F.concat(initials, F.lit(t[0])) for t in TAILS])).otherwise(F.array().cast("array<string>"))
    return F.filter(F.array_distinct(F.concat(forms, spoken)), lambda v: F.length(v) > 2)


def ordinary(word: Column) -> Column:
    """The spellings under which a dictionary may know a word: itself and without the ends of plurals."""
    w = F.lower(word)
    stems = [w, F.when(w.endswith("ies"), F.regexp_replace(w, "ies$", "y")), F.when(w.endswith("es"), F.regexp_replace(w, "es$", "")), F.when(w.endswith("s"), F.regexp_replace(w, "s$", ""))]
    return F.array_compact(F.array(*stems))


def person_forms(people: DataFrame, dictionary: DataFrame) -> DataFrame:
    """subject, forms (FORM): all that names each person, in order of precedence.

    ``people``: subject, name, and arrays handles, affiliations and aliases. Names and handles
    are the subject's, affiliations and aliases with a word of one are affiliations, other
    aliases the subject's; a form that is both is the subject's. A form of one word that the
    ``dictionary`` (word) knows goes only where it is capitalised, a handle in any case.
    """
    none = F.array().cast("array<string>")
    each = lambda c: F.filter(F.transform(F.coalesce(c, none), lambda x: F.btrim(x)), lambda x: F.coalesce(x != "", F.lit(False)))
    p = people.select("subject", F.coalesce("name", F.lit("")).alias("name"), each("handles").alias("handles"), each("affiliations").alias("affiliations"), each("aliases").alias("aliases"))
    told = F.filter(F.flatten(F.transform("affiliations", lambda a: _words(F.lower(a), r"[\s/&-]+"))), lambda w: F.length(w) >= 4)
    p = p.withColumn("told", told)
    role = lambda forms, r: F.transform(forms, lambda f: F.struct(f.alias("form"), F.lit(r).alias("role")))
    of_alias = F.transform("aliases", lambda a: F.struct(a.alias("form"), F.when(F.arrays_overlap(_words(F.lower(a)), F.col("told")), "affiliation").otherwise("subject").alias("role")))
    forms = F.concat(role(name_forms(F.col("name")), "subject"), role(F.array_sort("handles"), "subject"), role(F.flatten(F.transform("affiliations", company_forms)), "affiliation"), of_alias)
    rows = p.select("subject", "name", "handles", F.posexplode(forms).alias("place", "f")).select("subject", "name", "handles", "place", "f.form", "f.role")
    rows = rows.groupBy("subject", "form").agg(F.min_by(F.struct("place", "role", "name", "handles"), "place").alias("x")).select("subject", "form", "x.*")
    stems = rows.where(~F.contains("form", F.lit(" "))).select("form", F.explode(ordinary(F.col("form"))).alias("word")).distinct()
    known = stems.join(dictionary.select(F.lower("word").alias("word")).distinct(), "word", "left_semi").select("form").distinct().withColumn("known", F.lit(True))
    rows = rows.join(known, "form", "left")
    surname = (F.col("role") == "subject") & F.array_contains(F.slice(F.transform(_words("name"), F.lower), 2, 1000), F.lower("form"))
    form = F.struct(F.col("place").cast("int").alias("place"), "form", "role", (F.col("known").isNull() | F.array_contains("handles", F.col("form"))).alias("any_case"), F.coalesce(surname, F.lit(False)).alias("surname"))
    return rows.groupBy("subject").agg(F.array_sort(F.collect_list(form)).alias("forms"), F.first("name").alias("name"))


class Blinder:
    """One subject's forms as an automaton over lower-case letters."""

    def __init__(self, forms: list[dict], name: str, given_names: frozenset[str]):
        import ahocorasick

        self.automaton, self.given, self.name = ahocorasick.Automaton(), given_names, name.split()
        by: dict[str, list[dict]] = {}
        for f in forms:
            by.setdefault(lowered(f["form"]), []).append(f)
        for low, fs in by.items():
            self.automaton.add_word(low, (len(low), fs))
        self.empty = not by
        if by:
            self.automaton.make_automaton()

    def someone_else(self, text: str, start: int, taken: bytearray) -> str | None:
        """The given name of another person right before a place."""
        end = start
        while end and text[end - 1] in " \t":
            end -= 1
        at = end
        while at and text[at - 1].isalpha():
            at -= 1
        word = text[at:end]
        if end == start or start - at > 40 or not word or taken[at] or not (word[0].isupper() and word[1:].islower() and word.isascii()) or (at and _in_word(text[at - 1])):
            return None
        low = word.lower()
        own = {p.lower() for p in self.name}
        return None if low not in self.given or low in NO_GIVEN_NAMES or low in own or (self.name and _own_form(low, self.name[0].lower())) else word

    def blind(self, text: str, heard: list[dict]) -> tuple[str, Counter]:
        found = []
        if not self.empty:
            for end, (size, forms) in self.automaton.iter(lowered(text)):
                found += [(0, -size, f["place"], end + 1 - size, f) for f in forms]
        for k, h in enumerate(heard):  # after all exact forms, in order
            low, word = lowered(text), lowered(h["form"])
            at = low.find(word)
            while at >= 0:
                found.append((1, k, 0, at, h))
                at = low.find(word, at + 1)
        taken, spans, counts = bytearray(len(text) + 1), [], Counter()
        for late, _, _, start, f in sorted(found, key=lambda x: x[:4]):
            end = start + len(f["form"])
            if not _edge(text, start) or (not f["any_case"] and text[start:end] != f["form"][:1].upper() + f["form"][1:]):
                continue
            owner = text[end : end + 2].lower() if f["any_case"] else text[end : end + 2]
            end = next((e for e in (end + 2 * (owner in ("'s", "s'")), end) if _edge(text, e)), None)
            if end is None or any(taken[start:end]):
                continue
            other = self.someone_else(text, start, taken) if f["surname"] or late else None
            if other is not None:
                counts["kept"] += 1
                continue
            taken[start:end] = b"\x01" * (end - start)
            spans.append((start, end, SUBJECT if f["role"] == "subject" else AFFILIATION))
            counts[f["role"]] += 1
        out, at = [], 0
        for start, end, token in sorted(spans):
            out += [text[at:start], token]
            at = end
        return _single("".join([*out, text[at:]])), counts


def lowered(text: str) -> str:
    """Lower case, letter by letter where a letter would become two."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _in_word(c: str) -> bool:
    return c.isalnum() or c == "_"


def _edge(text: str, at: int) -> bool:
    return (at > 0 and _in_word(text[at - 1])) != (at < len(text) and _in_word(text[at]))


def _own_form(word: str, first: str) -> bool:
    """Whether a given name is a form of the subject's own: Matt and Matthew, Steven and Stephen."""
    import os
    from difflib import SequenceMatcher

    return len(os.path.commonprefix([word, first])) >= 3 or SequenceMatcher(None, word, first).ratio() >= 0.75


def _single(text: str) -> str:
    """One token for several on end."""
    import re

    return reduce(lambda t, token: re.sub(rf"(?:{re.escape(token)}\s+){{2,}}", f"{token} ", t), (SUBJECT, AFFILIATION), text)


def blind_texts(texts: DataFrame, forms: DataFrame, given_names: tuple[str, ...] = (), heard: DataFrame | None = None) -> DataFrame:
    """key, text, subjects, affiliations, kept: texts (key, subject, text) without their subject's forms, and how many went.

    A possessive goes with its form. A surname behind the given name of somebody else stays and
    counts as kept; ``given_names`` is a list that the caller bounds. ``heard`` (key, word, role) names
    words of a text that are a form heard wrongly; they go after the exact ones. Several tokens on end
    become one. A text of an unknown subject stays as it is, a null text stays null.
    """
    given = frozenset(g.lower() for g in given_names)
    rows = texts.select("key", "subject", "text").join(forms, "subject", "left")
    if heard is not None:
        word = F.struct(F.lit(0).alias("place"), F.col("word").alias("form"), "role", F.lit(True).alias("any_case"), F.lit(True).alias("surname"))
        rows = rows.join(heard.groupBy("key").agg(F.array_sort(F.collect_set(word)).cast(f"array<{FORM}>").alias("heard")), "key", "left")
    else:
        rows = rows.withColumn("heard", F.lit(None).cast(f"array<{FORM}>"))
    kind = f"key {dict(texts.dtypes)['key']}, text string, subjects long, affiliations long, kept long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, blinder = None, None
        for b in batches:
            out = []
            for subject, text, fs, name, hs in zip(*(b.column(c).to_pylist() for c in ("subject", "text", "forms", "name", "heard")), strict=True):
                if blinder is None or subject != last:
                    last, blinder = subject, Blinder(fs or [], name or "", given)
                done, counts = blinder.blind(text, hs or []) if text is not None else (None, Counter())
                out.append((done, counts["subject"], counts["affiliation"], counts["kept"]))
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])], names=["key", "text", "subjects", "affiliations", "kept"])

    return rows.select("key", "subject", "text", "forms", "name", "heard").sortWithinPartitions("subject").mapInArrow(run, kind)
