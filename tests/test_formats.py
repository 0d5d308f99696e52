"""CSV / TSV / one-class / LIBSVM / JSON / Kafka-shaped sources."""

import os

from pyspark.sql import functions as F

from spindle.operators.offsets import offset_ranges
from spindle.sources.json import project_json
from spindle.sources.kafka import kafka_options
from spindle.sources.text import (one_class_text, parse_csv_layout_a, parse_csv_layout_b, parse_csv_quoted,
                                  parse_tsv_label_first, parse_tsv_text_first, read_libsvm, write_libsvm)


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_csv_layout_a_naive_and_quoted(spark):
    df = _lines(spark, ['"4","1","d","NQ","u","hi, there"', '"2","1","d","NQ","u","meh"',
                        '"0","1","d","NQ","u","bad ""day"""', 'label,a,b,c,d,text'])
    naive, rej = parse_csv_layout_a(df, with_rejects=True)
    got = [(r.label, r.sentence) for r in naive.collect()]
    assert got == [(1.0, '"hi'), (1.0, '"meh"'), (0.0, '"bad ""day"""')]
    assert rej.count() == 1  # the header line is rejected, not dropped silently
    quoted = [(r.label, r.sentence) for r in parse_csv_quoted(df).collect()]
    assert quoted == [(1.0, "hi, there"), (1.0, "meh"), (0.0, 'bad "day"')]


def test_csv_layout_b(spark):
    df = _lines(spark, ["7,0,s,so sad today", "8,4,s,yay, fun"])
    assert [(r.label, r.sentence) for r in parse_csv_layout_b(df).collect()] == [(0.0, "so sad today"), (1.0, "yay")]


def test_tsv_layouts(spark):
    df = _lines(spark, ["good phone\t1", "no label here", "empty label\t", "bad\tx"])
    out, rej = parse_tsv_text_first(df, with_rejects=True)
    assert [(r.label, r.sentence) for r in out.collect()] == [(1.0, "good phone"), (1.0, "no label here"),
                                                              (1.0, "empty label")]
    assert [r.line for r in rej.collect()] == ["bad\tx"]
    lf = parse_tsv_label_first(_lines(spark, ["1\tgreat film", "0\tbad"]))
    assert [(r.label, r.sentence) for r in lf.collect()] == [(1.0, "great film"), (0.0, "bad")]


def test_one_class(spark):
    out = one_class_text(_lines(spark, ["a joy to watch"]), 1.0)
    assert [tuple(r) for r in out.collect()] == [(1.0, "a joy to watch")]


def test_libsvm_roundtrip(spark, scratch):
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql.types import DoubleType, StructField, StructType
    schema = StructType([StructField("label", DoubleType()), StructField("features", VectorUDT())])
    df = spark.createDataFrame([(1.0, Vectors.sparse(10, [2, 8], [0.5, 1.0])), (0.0, Vectors.sparse(10, [0], [2.0]))],
                               schema)
    path = os.path.join(scratch, "svm")
    write_libsvm(df, path)
    back = read_libsvm(spark, path, num_features=10).orderBy("label").collect()
    assert back[1].features.toArray()[2] == 0.5 and back[0].label == 0.0


def test_json_and_offsets(spark):
    recs = spark.createDataFrame(
        [("u1", '{"id_str":"1","created_at":"Mon","text":"hi","extra":3}', "t", 0, 5),
         ("u1", '{"id_str":"2","created_at":"Tue","text":"yo"}', "t", 0, 6),
         ("u2", 'not json', "t", 1, 9)], "key string, value string, topic string, partition int, offset long")
    out = project_json(recs, "value").collect()
    assert [(r.id_str, r.created_at, r.text) for r in out] == [("1", "Mon", "hi"), ("2", "Tue", "yo"),
                                                               (None, None, None)]
    rng = {(r.partition): (r.from_offset, r.until_offset) for r in offset_ranges(recs).collect()}
    assert rng == {0: (5, 7), 1: (9, 10)}


def test_kafka_options():
    o = kafka_options("b1:9092,b2:9092", ["a", "b"], security_protocol="SASL_PLAINTEXT",
                      kerberos_service_name="kafka", min_partitions=4)
    assert o["subscribe"] == "a,b" and o["startingOffsets"] == "earliest"
    assert o["kafka.security.protocol"] == "SASL_PLAINTEXT" and o["minPartitions"] == "4"
    assert o["kafka.sasl.kerberos.service.name"] == "kafka"


def test_jdbc_properties_never_carry_a_password_unless_given():
    from spindle.sources.jdbc import jdbc_properties
    assert jdbc_properties("app") == {"user": "app", "fetchsize": "10000"}
    p = jdbc_properties("app", "pw", driver="com.mysql.cj.jdbc.Driver")
    assert p["password"] == "pw" and p["driver"] == "com.mysql.cj.jdbc.Driver"


def test_console_sink_prints_batches(spark, scratch, capfd):
    from spindle.streaming.control import start
    from spindle.streaming.wordcount import running_word_counts
    src = os.path.join(scratch, "c")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("hello world hello\n")
    q = start(running_word_counts(spark.readStream.text(src), sort=True), "console_t", "complete",
              sink="console", trigger={"availableNow": True}, checkpoint_location=os.path.join(scratch, "ck"))
    q.awaitTermination(120)
    assert q.lastProgress["numInputRows"] == 1


def test_contiguous_offset_ranges(spark):
    recs = spark.createDataFrame([("t", 0, 5, 1), ("t", 0, 9, 1), ("t", 0, 12, 2), ("t", 0, 20, 3)],
                                 "topic string, partition int, offset long, batch int")
    got = [(r.batch, r.from_offset, r.until_offset) for r in
           offset_ranges(recs, by=["batch"], contiguous=True).orderBy("batch").collect()]
    assert got == [(1, 5, 10), (2, 10, 13), (3, 13, 21)]
