"""Places of words in a token list: where turns begin, and where a quote of blinded text stands.

A turn brings a marker and its first words; the words are looked for in the band of tokens
from the marker on, marks of time and of turns left out. A quote may hold tokens that stand for
some words of a name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillboard.functions.dategrammar import let

#: Tokens from a marker on that are searched, first words that count, spare tokens for marks between them, and what marks look like.
AHEAD, FIRST, SPARE = 40, 5, 3
MARK = r"^(?:\[\d{2}:\d{2}:\d{2}\]|>{2,})$"
#: Words that a blinding token may stand for, and the least words of a quote.
WILD = {"[subject]": 3, "[company]": 3, "[affiliation]": 5}
LEAST_WORDS = 4
_SPACE = r"(?U)[\s\x1c-\x1f]+"


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, _SPACE), lambda t: t != "")


def plain_word(token: Column) -> Column:
    """A token's letters, digits and apostrophes in lower case; '' for a mark."""
    return F.when(token.rlike(MARK), "").otherwise(F.regexp_replace(F.lower(token), r"(?U)[^\w']", ""))


def first_place(normed: Column, want: Column, marker: Column, ahead: int = AHEAD) -> Column:
    """The first place from the marker on where the wanted words stand, with at most three empty tokens among them; null without one."""
    n = F.size(want)

    def fits(i: Column) -> Column:
        got = F.slice(F.filter(F.slice(normed, i + 1, n + SPARE), lambda w: w != ""), 1, n)
        return (F.get(normed, i) != "") & (got == want)

    band = F.sequence(marker, F.least(marker + ahead, F.size(normed)) - 1)
    return F.when((n > 0) & (marker < F.size(normed)), F.get(F.filter(band, fits), F.lit(0)))


def anchored_turns(recordings: DataFrame, turns: DataFrame, key: str) -> DataFrame:
    """key, n (of the turn), start, end, speaker, found: the turns of each recording (key, tokens) as ranges of tokens.

    ``turns``: key, n, marker, first_words, speaker. A turn begins where its first words do, or, not ``found``,
    at its marker, which is brought into the text. A range ends where the next begins; turns that share a place leave
    all but the last without a range. Recordings without tokens have no ranges.
    """
    one = F.struct("n", F.col("marker").cast("int").alias("marker"), "first_words", "speaker")
    rows = recordings.select(key, "tokens").join(turns.groupBy(key).agg(F.array_sort(F.collect_list(one)).alias("turns")), key)
    rows = rows.select(key, F.size("tokens").alias("size"), "turns", F.explode(F.array(F.transform("tokens", plain_word))).alias("normed")).where("size > 0")

    def placed(t: Column) -> Column:
        marker = F.greatest(F.lit(0), F.least(t["marker"], F.col("size") - 1))
        want = F.slice(F.filter(F.transform(tokens(F.coalesce(t["first_words"], F.lit(""))), plain_word), lambda w: w != ""), 1, FIRST)
        at = let(want, lambda w: first_place(F.col("normed"), w, marker))
        return let(at, lambda a: F.struct(F.coalesce(a, marker).alias("start"), t["n"].alias("n"), t["speaker"].alias("speaker"), a.isNotNull().alias("found")))

    rows = rows.select(key, "size", F.explode(F.array(F.array_sort(F.transform("turns", placed)))).alias("s"))
    ends = F.transform("s", lambda x, k: F.struct(x["n"].alias("n"), x["start"].alias("start"), F.coalesce(F.get(F.col("s"), k + 1)["start"], F.col("size")).alias("end"), x["speaker"].alias("speaker"), x["found"].alias("found")))
    return rows.select(key, F.explode(ends).alias("r")).select(key, "r.*").where("end > start")


def quote_word(token: Column) -> Column:
    """A token of a quote as its word: straight apostrophes, none at the edges; blinding tokens and marks of turns stay."""
    low = F.lower(token)
    bare = F.btrim(F.regexp_replace(F.translate(low, "\u2019\u2018", "''"), r"(?U)[^\w']", ""), F.lit("'"))
    return F.when(low.isin(*WILD), low).when(low == ">>", "").otherwise(bare)


def quote_span(raw: Column, quote: Column) -> Column:
    """(first, last) token of a raw text that a quote covers; null if it is not there or has under four words.

    Of a quote with an ellipsis its longest piece counts. Marks of time and of turns are passed over.
    A blinding token stands for one to three words, for a show or outlet up to five, as few as
    fit; one in front stands for a single word.
    """
    toks = F.transform(tokens(raw), lambda t, i: F.struct(F.when(t.rlike(MARK), "").otherwise(quote_word(t)).alias("w"), i.alias("i")))
    pieces = F.transform(F.split(quote, r"\.\.\.|\u2026"), lambda p, k: F.struct(F.size(tokens(p)).alias("n"), (-k).alias("k"), p.alias("p")))
    words = F.filter(F.transform(tokens(F.array_max(pieces)["p"]), quote_word), lambda w: w != "")

    def found(s: Column) -> Column:
        text = F.concat(F.lit(" "), F.array_join(s["text"]["w"], " "), F.lit(" "))
        wild = lambda w: w.isin(*WILD)
        lead = F.size(s["q"]) - F.size(F.filter(s["q"], lambda w, k: F.exists(F.slice(s["q"], 1, k + 1), lambda x: ~wild(x))))  # blinding tokens in front
        body = F.transform(F.slice(s["q"], lead + 1, F.size(s["q"])), lambda w: F.when(w == "[affiliation]", r"\S+(?: \S+){0,4}?").when(wild(w), r"\S+(?: \S+){0,2}?").otherwise(w))
        pattern = F.concat(F.repeat(F.lit(r" \S+"), lead), F.lit(" ("), F.array_join(body, " "), F.lit(")(?= )"))

        def span(p: Column) -> Column:
            at = F.regexp_instr(text, p)
            skipped = F.length(F.substr(text, F.lit(1), at - 1)) - F.length(F.replace(F.substr(text, F.lit(1), at - 1), F.lit(" "), F.lit("")))
            n = F.size(F.split(F.regexp_substr(text, p), " ")) - 1
            return F.when(at > 0, F.struct(F.get(s["text"], skipped)["i"].alias("first"), F.get(s["text"], skipped + n - 1)["i"].alias("last")))

        usable = (F.size(s["q"]) >= LEAST_WORDS) & F.exists(s["q"], lambda w: ~wild(w))
        return F.when(usable, let(pattern, span))

    return let(F.struct(F.filter(toks, lambda t: t["w"] != "").alias("text"), words.alias("q")), found)
