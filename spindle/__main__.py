"""Command line for the jobs (`python -m spindle <job> ...` or spark-submit).

The master, memory and checkpoint folder come from spark-submit / spark
defaults; nothing here sets them.

  sentiment   --train PATH [--test PATH] [--train-layout b] [--test-layout a] [--buckets 65]
  word-count  --input DIR [--socket HOST:PORT] [--interval "10 seconds"] [--seconds N]
  sensor      --input DIR [--socket HOST:PORT] [--totals-only] [--interval "5 seconds"] [--seconds N]
  tweets      --bootstrap HOSTS --topics a,b --table PATH [--audit PATH] [--interval "10 seconds"]
              [--security-protocol SASL_PLAINTEXT --kerberos-service-name kafka] [--group-id G]
              [--min-partitions N] [--seconds N]
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from spindle import jobs
from spindle.sources.kafka import kafka_options, read_kafka
from spindle.sources.socket import file_lines, socket_lines
from spindle.streaming.control import stop_gracefully, stop_on_exit


def _lines(spark, args):
    if args.socket:
        host, port = args.socket.rsplit(":", 1)
        return socket_lines(spark, host, int(port))
    return file_lines(spark, args.input)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="spindle")
    sub = p.add_subparsers(dest="job", required=True)
    s = sub.add_parser("sentiment")
    s.add_argument("--train", required=True)
    s.add_argument("--test")
    s.add_argument("--train-layout", default="b", choices=["a", "b", "a_quoted"])
    s.add_argument("--test-layout", default="a", choices=["a", "b", "a_quoted"])
    s.add_argument("--buckets", type=int, default=65)
    s.add_argument("--iterations", type=int, default=100)
    for name in ("word-count", "sensor"):
        w = sub.add_parser(name)
        w.add_argument("--input")
        w.add_argument("--socket")
        w.add_argument("--interval", default="10 seconds" if name == "word-count" else "5 seconds")
        w.add_argument("--seconds", type=float, help="bounded run: stop gracefully after this long")
        w.add_argument("--checkpoint", help="checkpoint folder (default: under spark.checkpoint.dir)")
        if name == "sensor":
            w.add_argument("--totals-only", action="store_true")
    t = sub.add_parser("tweets")
    t.add_argument("--bootstrap", required=True)
    t.add_argument("--topics", required=True)
    t.add_argument("--table", required=True)
    t.add_argument("--audit")
    t.add_argument("--interval", default="10 seconds")
    t.add_argument("--seconds", type=float, help="bounded run: stop gracefully after this long")
    t.add_argument("--checkpoint", help="checkpoint folder (default: under spark.checkpoint.dir)")
    t.add_argument("--security-protocol")
    t.add_argument("--kerberos-service-name")
    t.add_argument("--group-id")
    t.add_argument("--min-partitions", type=int)
    t.add_argument("--key", default="id_str", choices=["id_str", "key"], help="row key: tweet id or record key")
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"spindle-{args.job}").getOrCreate()
    if args.job == "sentiment":
        out = jobs.sentiment_job(spark, args.train, args.test, args.train_layout, args.test_layout,
                                 args.buckets, args.iterations)
        print(json.dumps({"auc": out["auc"].first().asDict(), "accuracy": out["accuracy"].first().asDict()}))
        return
    trigger = {"processingTime": args.interval}
    if args.job == "word-count":
        q = jobs.word_count_stream(_lines(spark, args), trigger=trigger, checkpoint_location=args.checkpoint)
    elif args.job == "sensor":
        q = jobs.sensor_stream(_lines(spark, args), track_count=not args.totals_only, trigger=trigger,
                               checkpoint_location=args.checkpoint)
    else:
        records = read_kafka(spark, kafka_options(
            args.bootstrap, args.topics, security_protocol=args.security_protocol,
            kerberos_service_name=args.kerberos_service_name, group_id=args.group_id,
            min_partitions=args.min_partitions))
        q = jobs.tweets_to_table(records, args.table, args.audit, trigger=trigger,
                                 checkpoint_location=args.checkpoint, key=args.key)
    active = [x for x in spark.streams.active if x.name.startswith(q.name)]
    stop_on_exit(*active)
    if args.seconds:
        q.awaitTermination(args.seconds)
        for x in active:
            stop_gracefully(x)
    else:
        q.awaitTermination()


if __name__ == "__main__":
    main()
