"""Names that were heard wrongly: a similarity join of words and names by spelling and by sound.

Each pair of a distinct word and a distinct name is judged once, however many texts hold it.
Pairs meet by their consonants only: if matching blocks cover a share s of two strings, s * (a + b) / 2
letters are common, so one of the rarer letters at the front of each string's sorted bag is.
Lengths and bags of letters bound the likeness from above before it is worked out. Texts are read
in Arrow tasks, once for their capitalised words and once for the few that are like a name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillboard.functions import text as tx
from quillboard.functions.dategrammar import let
from quillboard.operators.vocabulary import counted, vocabulary
from quillboard.sources.shared import stored

#: How like a name a misheard word must be in spelling and in sound, how rare, and how much longer or shorter it may be.
SPELLING, SOUND, MOST_TIMES, MOST_LONGER = 0.64, 0.80, 25, 3
#: Characters of which all versions of Unicode say alike whether they are letters; a bound stands as in Java, between a letter, digit or underline and none.
SETTLED = re.compile("[^\\x00-\\x7F\u00A1-\u0233\u2010-\u2027\u2030-\u205E\u20AC]")
_LETTER = "0-9A-Z_a-z\u00AA\u00B5\u00BA\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u0233"
WORD = re.compile(f"(?<![{_LETTER}])[A-Za-z][A-Za-z'\u2019-]{{3,}}(?:(?<=[A-Za-z])(?![{_LETTER}])|(?<=['\u2019-])(?=[{_LETTER}]))")
ANY_WORD = r"(?<!_|[\p{L}\p{Nd}]\p{Mn}*)[A-Za-z][A-Za-z'\u2019-]{3,}(?:(?<=[A-Za-z])(?![\p{L}\p{Nd}\p{Mn}_])|(?<=['\u2019-])(?=[\p{L}\p{Nd}_]))"
_RARE = "zqxjkvbpgfwymcudlhrsnioate'-"  # letters of English from rare to common; any order is right


def _letters(word: Column) -> Column:
    return F.filter(F.split(word, ""), lambda c: c != "")


def bag(word: Column) -> Column:
    """The letters of a word with the number of each occurrence, so that bags meet as sets."""
    return let(_letters(word), lambda cs: F.transform(cs, lambda c, i: F.concat(c, F.size(F.filter(F.slice(cs, 1, i), lambda x: x == c)).cast("string"))))


def common_letters(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(bag(a), bag(b)))


def block_length(a: Column, b: Column) -> Column:
    """Letters in matching blocks: the longest common stretch (the first in a, then in b), then the same before and behind it."""
    kind = "array<struct<a: string, b: string>>"

    def longest(p: Column) -> Column:
        """(size, -place in a) of the longest stretch of a pair's first string that its second holds."""
        starts = F.sequence(F.lit(1), F.length(p["a"]))
        best = F.transform(starts, lambda i: F.struct(F.coalesce(F.array_max(F.filter(F.sequence(F.lit(1), F.length(p["a"]) - i + 1), lambda n: F.instr(p["b"], F.substr(p["a"], i, n)) > 0)), F.lit(0)).alias("size"), (-i).alias("i")))
        return F.array_max(best)

    def step(s: Column, _: Column) -> Column:
        def split(p: Column) -> Column:
            def around(m: Column) -> Column:
                i, size = -m["i"], m["size"]
                j = F.instr(p["b"], F.substr(p["a"], i, size))
                sides = F.array(F.struct(F.substr(p["a"], F.lit(1), i - 1).alias("a"), F.substr(p["b"], F.lit(1), j - 1).alias("b")), F.struct(F.substr(p["a"], i + size).alias("a"), F.substr(p["b"], j + size).alias("b")))
                some = F.filter(sides, lambda x: (x["a"] != "") & (x["b"] != ""))
                return F.struct((s["n"] + size).alias("n"), F.when(size > 0, F.concat(some, F.slice(s["open"], 2, F.size(s["open"])))).otherwise(F.slice(s["open"], 2, F.size(s["open"]))).alias("open"))

            return let(longest(p), around)

        return F.when(F.size(s["open"]) == 0, s).otherwise(let(F.get(s["open"], F.lit(0)), split))

    start = F.struct(F.lit(0).alias("n"), F.filter(F.array(F.struct(a.alias("a"), b.alias("b"))), lambda x: (x["a"] != "") & (x["b"] != "")).cast(kind).alias("open"))
    # each step takes one pair; there are at most twice as many pairs, and one, as letters
    return F.aggregate(F.sequence(F.lit(0), 2 * F.least(F.length(a), F.length(b))), start, step)["n"]


def likeness(a: Column, b: Column) -> Column:
    """Share of two words that matching blocks cover, 1 for two empty ones."""
    size = F.length(a) + F.length(b)
    return F.when(size == 0, 1.0).otherwise(2.0 * block_length(a, b) / size)


@lru_cache(1 << 14)
def _counts(word: str) -> Counter:
    return Counter(word)


@lru_cache(1 << 14)
def _front(skeleton: str, least: float) -> list[str]:
    """The rarest letters of a bag: two strings that are alike by ``least`` or more have one of them in common."""
    most = least / (2 - least)  # letters in common are this share of either string, or more
    ranked = sorted((_RARE.find(c), f"{c}{k}") for c, n in _counts(skeleton).items() for k in range(1, n + 1))
    return [c for _, c in ranked[: len(skeleton) - math.ceil(len(skeleton) * most - 1e-9) + 1]]


def _dealt(rows: DataFrame, word: str, skeleton: str, least: float) -> DataFrame:
    """A row for each letter at the front of a word's skeleton."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, heard = b.column(0).to_pylist(), b.column(1).to_pylist()
            out = [(w, s, c) for w, s in zip(words, heard, strict=True) for c in _front(s, least)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.string()) for k in range(3)], names=[word, skeleton, "letter"])

    return rows.select(word, tx.consonant_skeleton(F.col(word)).alias(skeleton)).mapInArrow(run, f"{word} string, {skeleton} string, letter string")


def heard_words(text: str) -> list[str]:
    """Words of four characters or more between bounds: letters of a-z, apostrophes and hyphens. A mark belongs to the letter before it."""
    if SETTLED.search(text) is None:
        return WORD.findall(text)
    return _any_word().findall(text)


@lru_cache(1)
def _any_word():
    import regex

    return regex.compile(ANY_WORD)


def capitals(text: str) -> Iterable[str]:
    return (w.lower() for w in set(heard_words(text)) if w[0] <= "Z" and "'" not in w and "\u2019" not in w)


def alike(words: DataFrame, names: DataFrame, spelling: float = SPELLING, sound: float = SOUND, longer: int = MOST_LONGER) -> DataFrame:
    """(word, name): the distinct lower-case words and names that are alike in spelling and in sound, but not the same.

    A pair is judged where the first of the letters at both fronts is dealt, so once. The tasks
    judge it as ``likeness`` does.
    """
    met = _dealt(words.select("word").distinct(), "word", "ws", sound).join(_dealt(names.select("name").distinct(), "name", "ns", sound), "letter")
    met = met.where((F.abs(F.length("word") - F.length("name")) <= longer) & (F.col("word") != F.col("name")))

    def first(a: str, b: str) -> str:
        y = _front(b, sound)
        return next(c for c in _front(a, sound) if c in y)

    def reached(a: str, b: str, least: float) -> bool:
        size = len(a) + len(b)
        if not size:
            return least <= 1
        x, y = _counts(a), _counts(b)
        return 2 * sum(min(k, y[c]) for c, k in x.items() if c in y) / size >= least

    def close(a: str, b: str, least: float) -> bool:
        size = len(a) + len(b)
        return 2.0 * sum(m.size for m in SequenceMatcher(None, a, b, False).get_matching_blocks()) / size >= least if size else least <= 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = [
                (word, name)
                for letter, word, ws, name, ns in zip(*(c.to_pylist() for c in b.columns), strict=True)
                if first(ws, ns) == letter and reached(ws, ns, sound) and reached(word, name, spelling) and close(ws, ns, sound) and close(word, name, spelling)
            ]
            yield pa.RecordBatch.from_arrays([pa.array([g[k] for g in good], pa.string()) for k in (0, 1)], names=["word", "name"])

    return met.select("letter", "word", "ws", "name", "ns").mapInArrow(run, "word string, name string")


def misheard(texts: DataFrame, key: str, anchors: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(key, word, anchor): capitalised words of a text (key, text) that are a name (key, anchor) misheard.

    A word that the dictionary knows, that holds an apostrophe, stands often, or is the name itself
    is none. It must resemble the name in spelling and in consonants; of several names the first.
    """
    names = anchors.select(key, "anchor", F.lower("anchor").alias("name")).where(F.length("anchor") >= 4)
    seen = vocabulary(texts.select("text"), capitals).join(dictionary.select("word").distinct(), "word", "left_anti")
    near = stored(alike(seen, names), "near")  # so that its size is known, and the words of texts need no shuffle where it is small
    words = counted(texts, key, heard_words).join(near, "word")
    per = words.groupBy(key, "word", "name").agg(F.sum("n").alias("n"), F.bool_or("capital").alias("capital")).where(f"capital and n <= {MOST_TIMES}")
    return per.join(names, [key, "name"]).groupBy(key, "word").agg(F.min("anchor").alias("anchor"))
