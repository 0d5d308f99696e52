"""Line-oriented sources: labelled CSV / TSV layouts, one-class text, LIBSVM.

Every parser is a Column expression over a `value` (line) column, so it runs in
whole-stage codegen and works the same on a batch scan (`spark.read.text`) and
on a stream (`spark.readStream.text`). Rows whose label cannot be read go to a
reject output instead of failing the job or vanishing silently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.functions.scalars import binarize_label
from spindle.functions.text import java_split, strip_quotes

SENTENCE_SCHEMA = T.StructType([
    T.StructField("label", T.DoubleType(), False),
    T.StructField("sentence", T.StringType(), False),
])


def sentences(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """In-memory `(label, sentence)` rows with the declared schema (small
    literal inputs such as examples; real inputs come from scans)."""
    return spark.createDataFrame(rows, SENTENCE_SCHEMA)


def read_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """Text-file scan, one row per line in column `value`."""
    df = spark.read.text(path)
    if min_partitions and df.rdd.getNumPartitions() < min_partitions:
        df = df.repartition(min_partitions)
    return df


def _labelled(df: DataFrame, label_raw: Column, sentence: Column, keep: list[str], line: str) -> DataFrame:
    num = label_raw.try_cast("double")
    return df.select(*keep, binarize_label(num).alias("label"), sentence.alias("sentence"),
                     (num.isNull() | sentence.isNull()).alias("_rejected"), F.col(line).alias("_line"))


def _split_result(df: DataFrame, with_rejects: bool):
    """Good rows; with `with_rejects` also the rejected raw lines (`line`)."""
    good = df.filter(~F.col("_rejected")).drop("_rejected", "_line")
    if not with_rejects:
        return good
    keep = [c for c in df.columns if c not in ("label", "sentence", "_rejected", "_line")]
    return good, df.filter(F.col("_rejected")).select(*keep, F.col("_line").alias("line"))


def parse_csv_layout_a(df: DataFrame, line: str = "value", keep: list[str] | None = None,
                       with_rejects: bool = False):
    """Layout A, split on every comma (quotes ignored, as the original job did):
    label = field 0 with quotes removed, sentence = field 5."""
    parts = java_split(F.col(line), ",")
    out = _labelled(df, strip_quotes(F.get(parts, 0)), F.get(parts, 5), keep or [], line)
    return _split_result(out, with_rejects)


def parse_csv_layout_b(df: DataFrame, line: str = "value", keep: list[str] | None = None,
                       with_rejects: bool = False):
    """Layout B, split on every comma: label = field 1, sentence = field 3."""
    parts = java_split(F.col(line), ",")
    out = _labelled(df, F.get(parts, 1), F.get(parts, 3), keep or [], line)
    return _split_result(out, with_rejects)


def parse_csv_quoted(df: DataFrame, line: str = "value", n_fields: int = 6, label_field: int = 0,
                     text_field: int = 5, keep: list[str] | None = None, with_rejects: bool = False):
    """Quote-aware CSV (RFC 4180: `"` quotes, `""` escapes a quote)."""
    names = [f"f{i}" for i in range(n_fields)]
    schema = ", ".join(f"{n} string" for n in names)
    rec = F.from_csv(F.col(line), schema, {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    out = _labelled(df, rec[names[label_field]], rec[names[text_field]], keep or [], line)
    return _split_result(out, with_rejects)


def parse_tsv_label_first(df: DataFrame, line: str = "value", keep: list[str] | None = None,
                          with_rejects: bool = False):
    """`label <TAB> text`; the label is used as is (not binarized)."""
    parts = java_split(F.col(line), "\t")
    num = F.get(parts, 0).try_cast("double")
    out = df.select(*(keep or []), num.alias("label"), F.get(parts, 1).alias("sentence"),
                    (num.isNull() | F.get(parts, 1).isNull()).alias("_rejected"), F.col(line).alias("_line"))
    return _split_result(out, with_rejects)


def parse_tsv_text_first(df: DataFrame, line: str = "value", default_label: float = 1.0,
                         keep: list[str] | None = None, with_rejects: bool = False):
    """`text [<TAB> label]`: only a *missing* label takes `default_label`; an
    unreadable one is rejected. An empty last field counts as missing, because
    trailing empty fields are dropped by the split."""
    parts = java_split(F.col(line), "\t")
    raw = F.get(parts, 1)
    num = raw.try_cast("double")
    label = F.when(F.size(parts) < 2, F.lit(default_label)).otherwise(num)
    out = df.select(*(keep or []), label.alias("label"), F.get(parts, 0).alias("sentence"),
                    ((F.size(parts) >= 2) & num.isNull()).alias("_rejected"), F.col(line).alias("_line"))
    return _split_result(out, with_rejects)


def one_class_text(df: DataFrame, label: float, line: str = "value",
                   keep: list[str] | None = None) -> DataFrame:
    """Every line of a one-class file gets the same constant label."""
    return df.select(*(keep or []), F.lit(float(label)).alias("label"), F.col(line).alias("sentence"))


def write_libsvm(df: DataFrame, path: str, label: str = "label", features: str = "features",
                 mode: str = "overwrite") -> None:
    df.select(F.col(label).alias("label"), F.col(features).alias("features")) \
        .write.mode(mode).format("libsvm").save(path)


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """LIBSVM load. Without `num_features` Spark infers it (an extra pass)."""
    reader = spark.read.format("libsvm")
    if num_features:
        reader = reader.option("numFeatures", str(num_features))
    return reader.load(path)
