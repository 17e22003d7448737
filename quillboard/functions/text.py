"""Column expressions over texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def tokens(text: Column) -> Column:
    """Lower-case words of a-z and apostrophes."""
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z']+)"), 1)


def normalised(text: Column) -> Column:
    """Lower-case letters and digits with single spaces, for quote search."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def type_token_ratio(words: Column) -> Column:
    return F.size(F.array_distinct(words)) / F.nullif(F.size(words), F.lit(0))


def rounded_share(part: Column, whole: Column, places: int) -> Column:
    """part / whole of whole numbers, rounded half up by whole-number arithmetic, so that every engine rounds alike."""
    unit = 10**places
    p, w = part.cast("long"), F.nullif(whole.cast("long"), F.lit(0).cast("long"))
    return F.floor((2 * unit * p + w) / (2 * w)) / unit


def moving_kinds(words: Column, window: int, step: int) -> Column:
    """(kinds, words) summed over the windows that fit; of the whole where none does."""
    n = F.size(words)
    kinds = F.transform(F.sequence(F.lit(0), n - window, F.lit(step)), lambda i: F.size(F.array_distinct(F.slice(words, i + 1, F.lit(window)))))
    summed = F.struct(F.aggregate(kinds, F.lit(0), lambda a, x: a + x).alias("kinds"), (F.size(kinds) * window).alias("words"))
    return F.when(n <= window, F.struct(F.size(F.array_distinct(words)).alias("kinds"), n.alias("words"))).otherwise(summed)


def moving_ttr(words: Column, window: int, step: int) -> Column:
    """Mean type-token ratio of the windows that fit; of the whole where none does."""
    n = F.size(words)
    starts = F.sequence(F.lit(0), n - window, F.lit(step))
    ratios = F.transform(starts, lambda i: F.size(F.array_distinct(F.slice(words, i + 1, F.lit(window)))) / window)
    mean = F.aggregate(ratios, F.lit(0.0), lambda a, x: a + x) / F.size(ratios)
    return F.when(n <= window, type_token_ratio(words)).otherwise(mean)


def words(text: Column) -> Column:
    """Runs of other than white space."""
    return F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " ")


#: Spellings of two letters, or of two sounds, and letters that sound like another.
TWO_LETTERS, LIKE, SOUNDS = {"ph": "f", "x": "ks"}, "cqz", "kks"


def consonant_skeleton(word: Column) -> Column:
    """The consonants of a word by their sound, with the first letter whatever it is; letters in a row count once."""
    letters = F.regexp_replace(F.lower(word), "[^a-z]+", "")
    for spelt, sound in TWO_LETTERS.items():
        letters = F.replace(letters, F.lit(spelt), F.lit(sound))
    heard = F.filter(F.split(F.translate(letters, LIKE, SOUNDS), ""), lambda c, i: (i == 0) | ~c.isin(*"aeiouy"))
    return F.array_join(F.filter(F.zip_with(heard, F.concat(F.array(F.lit("")), heard), lambda c, before: F.when(c != before, c)), lambda c: c.isNotNull()), "")
