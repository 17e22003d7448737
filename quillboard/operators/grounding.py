"""Quotes and spans in transcripts: where they stand, what is around them, who speaks, how they match."""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Fixed value: a mark of time in a transcript.
MARK = r"\[(\d{1,2}):(\d{2}):(\d{2})\]"
_MARK, _WORD, _TOKEN = re.compile(MARK), re.compile(r"[^\W_]+"), re.compile(r"\S+")
CONTEXT = 400


class Located:
    """A transcript's words, lower-cased, with their places in the text; marks are no words."""

    def __init__(self, text: str):
        self.text = text
        marks = list(_MARK.finditer(text))
        self.marks, self.mark_at = [m.group(0) for m in marks], [m.start() for m in marks]
        bare = _MARK.sub(lambda m: " " * len(m.group(0)), text)
        found = list(_WORD.finditer(bare))
        self.words, self.start, self.end = [m.group(0).lower() for m in found], [m.start() for m in found], [m.end() for m in found]
        self.places: dict[str, list[int]] = {}
        for k, w in enumerate(self.words):
            self.places.setdefault(w, []).append(k)

    def mark(self, at: int) -> str:
        """The last mark at or before a place."""
        k = bisect.bisect_right(self.mark_at, at)
        return self.marks[k - 1] if k else "unmarked"

    def find(self, quote: list[str]) -> list[int]:
        """Word places of a quote; its rarest word is looked up first."""
        least = min(range(len(quote)), key=lambda k: len(self.places.get(quote[k], ())))
        return [p - least for p in self.places.get(quote[least], ()) if p >= least and self.words[p - least : p - least + len(quote)] == quote]

    def locate(self, quote: str, hint: str | None) -> tuple[int | None, int | None, int, str | None, str | None]:
        """Start, end, occurrences, error and mark of a quote; of several, the only one with the hinted mark."""
        wanted = [w.lower() for w in _WORD.findall(_MARK.sub(" ", quote))]
        if not wanted:
            return None, None, 0, "empty_quote", None
        hits = self.find(wanted)
        if not hits:
            return None, None, 0, "not_found", None
        near = hits if len(hits) == 1 else [k for k in hits if hint and self.mark(self.start[k]) == hint.strip()]
        if len(near) != 1:
            return None, None, len(hits), "ambiguous_no_hint", None
        start = self.start[near[0]]
        return start, self.end[near[0] + len(wanted) - 1], len(hits), None, self.mark(start)


def locate_quotes(transcripts: DataFrame, quotes: DataFrame, key: str) -> DataFrame:
    """Each quote (key, quote_id, quote, hint) with start, end, occurrences, error and the mark before it.

    Offsets are of the original text; nothing is matched loosely. Quotes of no transcript have
    the error no_transcript. Rows of one transcript stand together, so its words are read once
    for each batch of them.
    """
    kind = f"{key} {dict(quotes.dtypes)[key]}, quote_id {dict(quotes.dtypes)['quote_id']}, start long, end long, occurrences long, error string, mark string"
    rows = quotes.select(key, "quote_id", "quote", "hint").join(transcripts.select(key, "text"), key, "left").sortWithinPartitions(key)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out, last = [], None
            for k, q, quote, hint, text in zip(b[key], b["quote_id"], b["quote"], b["hint"], b["text"], strict=True):
                if not isinstance(text, str):
                    out.append((k, q, None, None, 0, "no_transcript", None))
                    continue
                if last is None or last.text != text:
                    last = Located(text)
                out.append((k, q, *last.locate(quote if isinstance(quote, str) else "", hint if isinstance(hint, str) else None)))
            got = pd.DataFrame(out, columns=[key, "quote_id", "start", "end", "occurrences", "error", "mark"])
            yield got.astype({"start": "Int64", "end": "Int64"})

    return rows.mapInPandas(run, kind)


def mark_seconds(mark: Column) -> Column:
    """Seconds of a [hh:mm:ss] mark; null for anything else."""
    part = lambda k: F.regexp_extract(F.trim(mark), f"^{MARK}$", k).cast("int")
    return F.when(F.trim(mark).rlike(f"^{MARK}$"), part(1) * 3600 + part(2) * 60 + part(3))


def quote_words(quote: Column) -> Column:
    """How many words a quote has; marks are none."""
    return F.size(F.regexp_extract_all(F.regexp_replace(quote, MARK, " "), F.lit(r"(\S+)"), 1))


def context(text: Column, start: Column, end: Column, words: int = CONTEXT) -> tuple[Column, Column]:
    """Up to ``words`` words before and after a place; a word that the place cuts stays cut."""
    before, after = F.rtrim(F.substring(text, F.lit(1), start)), F.substring(text, end + 1, F.length(text))
    return F.trim(F.regexp_extract(before, rf"((?:\S+\s+){{0,{words - 1}}}\S+)$", 1)), F.trim(F.regexp_extract(after, rf"^(\s*(?:\S+\s+){{0,{words - 1}}}\S+)", 1))


def best_overlap(spans: DataFrame, gold: DataFrame, key: str, least: float = 0.5) -> DataFrame:
    """Each span (key, id, start, end) with the gold span of its text that it covers best, if it covers ``least`` of it.

    Ties go to the gold span that comes first. A range join within a text.
    """
    g = gold.select(F.col(key).alias("g_key"), F.col("id").alias("gold_id"), F.col("start").alias("g_start"), F.col("end").alias("g_end"))
    shared = F.least("end", "g_end") - F.greatest("start", "g_start")
    share = shared / F.greatest(F.col("g_end") - F.col("g_start"), F.lit(1))
    met = spans.join(g, (F.col(key) == F.col("g_key")) & (F.col("start") < F.col("g_end")) & (F.col("g_start") < F.col("end"))).withColumn("share", share).where(F.col("share") >= least)
    best = met.groupBy(key, "id").agg(F.max_by(F.struct("gold_id", "share"), F.struct("share", -F.col("g_start"))).alias("b"))
    return spans.join(best, [key, "id"], "left").select(key, "id", "start", "end", "b.gold_id", "b.share")


def token_kinds(text: Column) -> Column:
    """timestamp, turn, gap, punctuation or speech for each token of a text."""
    kind = lambda t: F.when(t.rlike(f"^{MARK}$"), "timestamp").when(t == ">>", "turn").when(t.rlike(r"^\[[^\]]*\]$"), "gap").when(~t.rlike(r"[\p{L}\p{N}]"), "punctuation").otherwise("speech")
    return F.transform(F.filter(F.split(text, r"\s+"), lambda t: t != ""), kind)


def speaker_of(spans: DataFrame, ranges: DataFrame, key: str) -> DataFrame:
    """Who speaks in each span (key, id, a, z) by labelled word ranges (key, start, end, speaker).

    unlabelled where some word of the span has no label, unclear where one is unclear, both
    for several speakers.
    """
    r = ranges.select(F.col(key).alias("r_key"), "start", "end", "speaker")
    met = spans.join(r, (F.col(key) == F.col("r_key")) & (F.col("a") < F.col("end")) & (F.col("start") < F.col("z")), "left")
    per = met.groupBy(key, "id", "a", "z").agg(F.coalesce(F.sum(F.least("z", "end") - F.greatest("a", "start")), F.lit(0)).alias("covered"), F.collect_set("speaker").alias("who"))
    label = F.when(F.col("covered") < F.col("z") - F.col("a"), "unlabelled").when(F.array_contains("who", "unclear"), "unclear").when(F.size("who") > 1, "both").otherwise(F.get("who", F.lit(0)))
    return per.select(key, "id", "a", "z", F.when(F.col("a") >= F.col("z"), "unlabelled").otherwise(label).alias("speaker"))


def segmentation(labels: DataFrame, human: DataFrame, key: list[str]) -> DataFrame:
    """Share of words whose label agrees with the human's, per arm; a recording that an arm misses counts for none.

    labels: (arm, key, word, label); human: (key, word, label).
    """
    arms = labels.select("arm").distinct().agg(F.count("*").alias("arms"))
    have = labels.groupBy(*key).agg(F.count_distinct("arm").alias("have")).crossJoin(F.broadcast(arms)).where("have = arms").select(*key)  # one row
    both = labels.join(have, key, "left_semi").join(human.withColumnRenamed("label", "truth"), [*key, "word"])
    return both.groupBy("arm").agg(F.count("*").alias("words"), F.round(F.avg((F.col("label") == F.col("truth")).cast("double")), 6).alias("accuracy"))


def play_second(marks: DataFrame, words: DataFrame, key: str) -> DataFrame:
    """The second at which each word (key, word) is said: interpolated between the marks (key, word, second) around it.

    Before the first mark and behind the last there is nothing to interpolate; the nearest mark stands.
    """
    both = words.select(key, "word", F.lit(None).cast("double").alias("second"), F.lit(1).alias("is_word")).unionByName(marks.select(key, "word", F.col("second").cast("double"), F.lit(0).alias("is_word")))
    before = Window.partitionBy(key).orderBy("word", "is_word").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(key).orderBy("word", F.desc("is_word")).rowsBetween(0, Window.unboundedFollowing)
    at = F.when(F.col("is_word") == 0, F.struct("word", "second"))
    rows = both.select(key, "word", "is_word", F.last(at, True).over(before).alias("p"), F.first(at, True).over(after).alias("n"))
    between = F.col("p.second") + (F.col("n.second") - F.col("p.second")) * (F.col("word") - F.col("p.word")) / F.nullif(F.col("n.word") - F.col("p.word"), F.lit(0))
    return rows.where("is_word = 1").select(key, "word", F.coalesce(between, F.col("p.second"), F.col("n.second")).alias("second"))
