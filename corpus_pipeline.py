"""Corpus pipeline: quality rules, near-dedup, benchmark decontamination, secret
scans and source mixing, in this order.

Each stage takes (spark, docs, data_dir) and returns a DataFrame; its rows are
written as Parquet in the session's shared checkpoint folder and read again as
the next stage's docs. All stages but the last return the columns of their docs;
the last adds size, source_size, target and taken, the words that the mix takes
of a document, and drops documents of which it takes none.

Nulls and edge cases are those of the operators: a null text fails the quality
rules, so later stages meet none from here, but each of them handles it. An
empty table gives an empty result at every stage.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm.common import recording, release, stage, table
from spindle.llm.decontaminate import decontaminate
from spindle.llm.mix import RESULT as MIXED
from spindle.llm.mix import mix
from spindle.llm.neardup import keep_one
from spindle.llm.quality import judge
from spindle.llm.secrets import redact


OWN = ("doc_id", "text", "source")


def _plain(docs: DataFrame) -> DataFrame:
    """`docs` with all columns but OWN under names that no operator uses, so that
    extra columns survive whatever they are called."""
    return docs.toDF(*[c if c in OWN else f"__column_{i}" for i, c in enumerate(docs.columns)])


def _named(result: DataFrame, docs: DataFrame, text: str = "text") -> list:
    """The columns of `docs` from a result over `_plain(docs)`, with the text
    taken from column `text` and its length in n_chars."""
    new = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return [(new[c] if c in new else F.col(p)).alias(c) for c, p in zip(docs.columns, _plain(docs).columns)]


_working: list[str] = []


def _pipeline_stage(function: Callable) -> Callable:
    """A stage is called when the one before it has been written, so the working
    tables of that one are deleted. The first stage starts anew and deletes
    nothing, nor does anything delete those of a last one."""

    @wraps(function)
    def call(spark: SparkSession, docs: DataFrame, data_dir: str) -> DataFrame:
        if function.__name__ == STAGES[0][1].__name__:
            _working.clear()
        release(spark, _working)
        with recording(_working):
            return function(spark, docs, data_dir)

    return call


@_pipeline_stage
def quality_stage(spark: SparkSession, docs: DataFrame, data_dir: str) -> DataFrame:
    """Rejected documents go; failing lines go from the others. The verdicts are
    written first: a filter right above them would be pushed into the rules and
    evaluate them again for every use of a count."""
    judged = judge(_plain(docs))
    judged = stage(judged.select(*_named(judged, docs, "clean_text"), F.col("kept").alias("__kept")), "pipeline-judged")
    return judged.where("__kept").drop("__kept")


@_pipeline_stage
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, data_dir: str) -> DataFrame:
    """One document of each group stays (five-word shingles, similarity 0.8 or more)."""
    kept = keep_one(_plain(docs), width=5, percent=80)
    return kept.select(*_named(kept, docs))


@_pipeline_stage
def decontamination_stage(spark: SparkSession, docs: DataFrame, data_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    items = table(spark, data_dir, "benchmark", "item_id", "text")
    found = decontaminate(_plain(docs), items).where("NOT contaminated")
    return found.select(*_named(found, docs))


@_pipeline_stage
def secrets_stage(spark: SparkSession, docs: DataFrame, data_dir: str) -> DataFrame:
    """Reported secrets are masked in the text."""
    masked = redact(_plain(docs))
    return masked.select(*_named(masked, docs))


@_pipeline_stage
def mixing_stage(spark: SparkSession, docs: DataFrame, data_dir: str) -> DataFrame:
    """The documents that the mix takes, and how many of their words."""
    mixed = mix(_plain(docs)).where("taken > 0")
    taken = {c.lower() for c in MIXED}
    kept = [F.col(p).alias(c) for c, p in zip(docs.columns, _plain(docs).columns) if c.lower() not in taken]
    return mixed.select(*kept, *MIXED)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
]

# MinHash candidates and connected groups have no plain SQL form; the stages are
# tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
