"""Running word count over a line stream (every key's total so far).

`complete` mode re-emits every word each batch, like the original per-batch
state dump, and allows the sort by count; `update` mode emits only words
touched in the batch (same totals, output proportional to the batch).
State is Spark's streaming aggregate state, partitioned by word, with a
partial aggregate before the state store (like a map-side reduce).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.operators.wordcount import line_words


def running_word_counts(lines: DataFrame, line: str = "value", delimiter: str = " ",
                        sort: bool = False) -> DataFrame:
    counts = line_words(lines, line, delimiter).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    if sort:  # legal on a stream only after an aggregate, in complete mode
        counts = counts.orderBy(F.col("n").desc(), F.col("word").asc())
    return counts
