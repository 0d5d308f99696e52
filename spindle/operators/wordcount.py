"""Word counts over lines of text.

`explode` + `groupBy().agg(count)` plans as a partial (map-side) HashAggregate,
a shuffle of one row per distinct word per task, and a final aggregate, so a
word holding a third of all tokens costs no more shuffle than a rare one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.functions.text import java_split, lines_of


def text_to_lines(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per line of each text (column `line`)."""
    return df.select(*(keep or []), F.explode(lines_of(F.col(text))).alias("line"))


def line_words(df: DataFrame, line: str = "line", delimiter: str = " ",
               keep: list[str] | None = None) -> DataFrame:
    """One row per word, Java-style split (an empty word is a word)."""
    return df.select(*(keep or []), F.explode(java_split(F.col(line), delimiter)).alias("word"))


def word_counts(words: DataFrame, word: str = "word", by: list[str] | None = None) -> DataFrame:
    keys = list(by or []) + [word]
    return words.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def top_words(counts: DataFrame, k: int, word: str = "word", n: str = "n") -> DataFrame:
    """Top-k by count, ties broken by word; plans as TakeOrderedAndProject
    (per-task top-k, then a k-row merge), never a full sort."""
    return counts.orderBy(F.col(n).desc(), F.col(word).asc()).limit(k)


def sorted_counts(counts: DataFrame, word: str = "word", n: str = "n") -> DataFrame:
    """Every word, swapped to (n, word) and sorted by count descending
    (range-partitioned sort)."""
    return counts.select(n, word).orderBy(F.col(n).desc(), F.col(word).asc())
