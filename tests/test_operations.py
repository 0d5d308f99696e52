"""Keyed table upkeep, reject outputs and stops of streams."""

import os
import signal
import time


from spindle import jobs
from spindle.sinks.keyed_table import KeyedTable
from spindle.streaming.control import start, stop_on_exit


def batch(spark, rows):
    return spark.createDataFrame(rows, "k string, o long, v string")


def parts(path):
    return sorted(os.path.basename(f) for f in os.listdir(path) if "=" in f)


def test_late_records_do_not_replace_newer_ones(spark, scratch):
    table = KeyedTable(f"{scratch}/t", "k", ["o"], ["v"])
    table.write_batch(batch(spark, [("a", 10, "new"), ("b", 1, "b1"), (None, 1, "x")]), 0)
    table.write_batch(batch(spark, [("a", 5, "late"), ("b", 1, "again"), ("c", 3, "c")]), 1)
    assert {r.k: r.v for r in table.read(spark).collect()} == {"a": "new", "b": "again", "c": "c"}


def test_compaction_replaces_the_files_that_reads_use(spark, scratch):
    table = KeyedTable(f"{scratch}/t", "k", ["o"], ["v"])
    for i in range(4):
        table.write_batch(batch(spark, [("a", i, f"a{i}"), (f"k{i}", i, "x")]), i)
    before = sorted(tuple(r) for r in table.read(spark).collect())
    table.compact(spark, 2)
    used = {os.path.relpath(f.replace("file:", ""), f"{scratch}/t").split("/")[0:2][1] for f in table._rows(spark).inputFiles()}
    assert used == {"upto=2", "batch_id=3"}
    assert sorted(tuple(r) for r in table.read(spark).collect()) == before
    table.write_batch(batch(spark, [("a", 2, "a2"), ("k2", 2, "x")]), 2)  # a replay of a compacted batch
    assert sorted(tuple(r) for r in table.read(spark).collect()) == before
    table.compact(spark, 3)
    table.vacuum(spark)
    assert parts(f"{scratch}/t/data") == [] and parts(f"{scratch}/t/snapshots") == ["upto=3"]
    assert sorted(tuple(r) for r in table.read(spark).collect()) == before
    table.write_batch(batch(spark, [("a", 9, "a9")]), 4)
    assert {r.k: r.v for r in table.read(spark).collect()}["a"] == "a9"


def test_jobs_write_rejects(spark, scratch):
    with open(f"{scratch}/train.csv", "w") as f:
        f.write("id,label,source,text\n" + "".join(f"{i},{i % 2},s,{'good film' if i % 2 else 'sad story'} {i}\n" for i in range(40)) + "9,x,s,bad label\n")
    out = jobs.sentiment_job(spark, f"{scratch}/train.csv", f"{scratch}/train.csv", "b", "b", iterations=5, rejects_path=f"{scratch}/rejects")
    assert out["accuracy"].first().n_test == 40
    assert spark.read.text(f"{scratch}/rejects").count() == 4  # header and bad label, of both reads


def test_sensor_stream_keeps_bad_lines(spark, scratch):
    os.makedirs(f"{scratch}/in")
    good = "11111111-1111-1111-1111-111111111111"
    with open(f"{scratch}/in/a.txt", "w") as f:
        f.write(f"{good},70,2\n{good},60,1\nnot-a-uuid,1,1\n{good},x,1\n\n")
    q = jobs.sensor_stream(spark.readStream.text(f"{scratch}/in"), "sensor_rej", sink="memory", trigger={"availableNow": True},
                           checkpoint_location=f"{scratch}/ck", rejects_path=f"{scratch}/rejects")
    other = [x for x in spark.streams.active if x.name == "sensor_rej_rejects"]
    q.awaitTermination(120)
    for x in other:
        x.awaitTermination(120)
    assert [(r.total_hr, r.total_cal, r.total_n) for r in spark.sql("select * from sensor_rej").collect()] == [(130, 3, 2)]
    assert spark.read.text(f"{scratch}/rejects").count() == 3


def test_sigterm_lets_the_running_batch_end(spark, scratch):
    os.makedirs(f"{scratch}/in")
    with open(f"{scratch}/in/a.txt", "w") as f:
        f.write("x\n")
    seen = []

    def slow(df, batch_id):
        seen.append("begun")
        time.sleep(4)
        df.write.mode("overwrite").parquet(f"{scratch}/out/{batch_id}")
        seen.append("ended")

    old = signal.getsignal(signal.SIGTERM)
    q = start(spark.readStream.text(f"{scratch}/in"), "slow_t", "append", foreach_batch=slow, trigger={"processingTime": "1 second"},
              checkpoint_location=f"{scratch}/ck")
    try:
        stop_on_exit(q, timeout=60)
        while not seen:
            time.sleep(0.1)
        os.kill(os.getpid(), signal.SIGTERM)
        assert not q.isActive
    finally:
        signal.signal(signal.SIGTERM, old)
        q.stop()
    assert seen[:2] == ["begun", "ended"] and q.exception() is None
    assert spark.read.parquet(f"{scratch}/out/0").count() == 1
    assert os.path.exists(f"{scratch}/ck/commits/0")


def test_sorted_word_count_is_in_order(spark):
    from spindle.plans.queries import QUERIES
    from tests.conftest import SF001
    rows = [(r.n, r.word) for r in QUERIES["word_count_sorted"](spark, SF001).collect()]
    assert rows == sorted(rows, key=lambda r: (-r[0], r[1].encode()))
