"""Split / line / token semantics (golden cases from FIXTURES.md)."""

from pyspark.ml.feature import Tokenizer
from pyspark.sql import functions as F

from spindle.functions.scalars import binarize_label, int_div, is_uuid, parse_sensor_line
from spindle.functions.text import java_split, lines_of, tokenize


def _split(spark, values, delim=" "):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r.w for r in df.select(java_split("s", delim).alias("w")).collect()]


def test_java_split_goldens(spark):
    assert _split(spark, ["a  b  ", "", "   ", " x"]) == [["a", "", "b"], [""], [], ["", "x"]]


def test_java_split_other_delimiters(spark):
    assert _split(spark, ["a,b,,", ",a", ",,"], ",") == [["a", "b"], ["", "a"], []]
    assert _split(spark, ["t\t1", "t\t"], "\t") == [["t", "1"], ["t"]]


def test_lines_of(spark):
    df = spark.createDataFrame([("a\nb",), ("a\r\nb\n",), ("",), ("\n",), ("x\n\ny",)], "t string")
    got = [r.l for r in df.select(lines_of("t").alias("l")).collect()]
    assert got == [["a", "b"], ["a", "b"], [], [""], ["x", "", "y"]]


def test_tokenize_matches_ml_tokenizer(spark):
    rows = [("Hi I heard about Spark",), ("a  B\tc  ",), ("",), ("   ",), (" X\x0bY\fz\r",), ("ÉCOLE Straße",)]
    df = spark.createDataFrame(rows, "sentence string")
    ours = [r.t for r in df.select(tokenize("sentence").alias("t")).collect()]
    ml = [r.words for r in Tokenizer(inputCol="sentence", outputCol="words").transform(df).collect()]
    assert ours == ml


def test_label_rule_and_int_div(spark):
    df = spark.createDataFrame([(0.0, -5, 2), (4.0, 7, 2), (2.0, -3, -2), (1.0, 4, 0)], "l double, a long, b long")
    got = df.select(binarize_label("l").alias("y"), int_div("a", "b").alias("q")).collect()
    assert [r.y for r in got] == [0.0, 1.0, 1.0, 1.0]
    assert [r.q for r in got] == [-2, 3, 1, None]


def test_sensor_line_parse(spark):
    df = spark.createDataFrame([("11111111-1111-1111-1111-111111111111,72,5",), ("bad,x,1",)], "v string")
    got = df.select(parse_sensor_line("v").alias("r")).select("r.*", is_uuid(F.col("r.session_id")).alias("ok")).collect()
    assert (got[0].heart_rate, got[0].calorie, got[0].ok) == (72, 5, True)
    assert (got[1].heart_rate, got[1].calorie, got[1].ok) == (None, 1, False)
