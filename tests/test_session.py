"""Cluster sizing settings, and a stateful stream on the RocksDB state store."""

import os

from spindle.session import cluster_settings, stream_settings
from spindle.streaming.control import start
from spindle.streaming.wordcount import running_word_counts


def test_cluster_settings_scale_with_input():
    small = cluster_settings(10 * 1024 ** 3, 64)
    big = cluster_settings(100 * 1024 ** 4, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 128          # floor: 2 per core
    assert int(big["spark.sql.shuffle.partitions"]) == 40960           # a tenth of 100 TB / 256 MB
    assert int(cluster_settings(100 * 1024 ** 4, 8000, 1024 ** 4)["spark.sql.shuffle.partitions"]) == 16000
    assert int(stream_settings(500)["spark.sql.shuffle.partitions"]) == 500
    assert big["spark.sql.autoBroadcastJoinThreshold"] == "-1"         # no static broadcast of unknown sizes


def test_stream_on_rocksdb_state_store(spark, scratch):
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, cluster_settings(1, 1)[key])
    try:
        src = os.path.join(scratch, "l")
        os.makedirs(src)
        with open(os.path.join(src, "a.txt"), "w") as f:
            f.write("x y x\n")
        q = start(running_word_counts(spark.readStream.text(src)), "wc_rocks", "update",
                  trigger={"availableNow": True}, checkpoint_location=os.path.join(scratch, "ck"))
        q.awaitTermination(120)
        assert {r.word: r.n for r in spark.sql("select * from wc_rocks").collect()} == {"x": 2, "y": 1}
        assert os.path.isdir(os.path.join(scratch, "ck", "state"))
    finally:
        spark.conf.set(key, old)
