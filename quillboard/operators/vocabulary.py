"""Words of texts, found in Arrow tasks: each task tells a word once, and a text each of its words once."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Words that a task remembers as told, and rows of one batch of its output.
MOST_HELD, BATCH = 1 << 18, 1 << 16
TOKEN = re.compile("[a-z']+")


def parts(spark: SparkSession) -> int:
    """Partitions to name in a shuffle of short rows, which would else be merged by their few bytes, however many they are."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tokens(text: str) -> Iterable[str]:
    """As functions.text.tokens: lower-case words of a-z and apostrophes."""
    return TOKEN.findall(text.lower())


def vocabulary(texts: DataFrame, find: Callable[[str], Iterable[str]]) -> DataFrame:
    """word: the distinct words that ``find`` sees in the first column, spread by their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[str] = set()
        for b in batches:
            for text in b.column(0):
                if text.is_valid:
                    new = set(find(text.as_py())).difference(told)
                    if new:
                        yield pa.RecordBatch.from_arrays([pa.array(new, pa.string())], names=["word"])
                        if len(told) > MOST_HELD:
                            told.clear()
                        told.update(new)

    return texts.select(texts.columns[0]).mapInArrow(run, "word string").repartition(parts(texts.sparkSession), "word").distinct()


def counted(texts: DataFrame, key: str, find: Callable[[str], Iterable[str]]) -> DataFrame:
    """key, word, n, capital: the lower-case words of each row of texts (key, text), how often they stand there, and whether one is capitalised."""
    kind = f"{key} {dict(texts.dtypes)[key]}, word string, n long, capital boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, words, times, capital = [], [], [], []

            def out():
                columns = [b.column(0).take(pa.array(row, pa.int64())), pa.array(words, pa.string()), pa.array(times, pa.int64()), pa.array(capital, pa.bool_())]
                for c in (row, words, times, capital):
                    c.clear()
                return pa.RecordBatch.from_arrays(columns, names=[key, "word", "n", "capital"])

            for k, text in enumerate(b.column(1)):
                if not text.is_valid:
                    continue
                n: dict[str, int] = {}
                upper = set()
                for raw, c in Counter(find(text.as_py())).items():
                    low = raw.lower()
                    n[low] = n.get(low, 0) + c
                    if raw[0] <= "Z":
                        upper.add(low)
                row += [k] * len(n)
                words += n
                times += n.values()
                capital += [w in upper for w in n]
                if len(row) > BATCH:
                    yield out()
            if row:
                yield out()

    return texts.select(key, "text").mapInArrow(run, kind)
