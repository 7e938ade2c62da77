"""Command line: run the warehouse build, or one registered query.

    python -m martline build --sf-dir DIR --out DIR [--stream] [--enforce]
    python -m martline query NAME --sf-dir DIR [--show N]
    python -m martline consume ENTITY --target DIR --checkpoint DIR
        (--kafka SERVERS TOPIC | --messages DIR) [--policy first|last]
        [--continuous [--interval "10 seconds"]] [--rejects DIR]
        [--starting-offsets JSON] [--max-offsets N] [--min-partitions N]
    python -m martline produce ENTITY --sf-dir DIR --kafka SERVERS TOPIC
    python -m martline runs --out DIR [--run-id ID]

On a cluster, submit with spark-submit (the session then comes from the
submit configuration, and ``spark.checkpoint.dir`` must name a shared
folder); without a master it runs in local mode.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    from martline.session import DEFAULT_CONF, ensure_checkpoint_dir
    builder = SparkSession.builder.appName("martline")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="martline")
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="staging, dimensions, facts, quality")
    b.add_argument("--sf-dir", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--stream", action="store_true", help="stage through the streaming consumers")
    b.add_argument("--messages", help="with --stream: folder with each entity's message files")
    b.add_argument("--enforce", action="store_true", help="fail on any quality check")
    q = sub.add_parser("query", help="run one registered query")
    q.add_argument("name")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--show", type=int, default=20)
    c = sub.add_parser("consume", help="stream one entity into its keyed staging table")
    c.add_argument("entity", choices=["orders", "items", "payments"])
    c.add_argument("--target", required=True)
    c.add_argument("--checkpoint", required=True)
    src = c.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", nargs=2, metavar=("SERVERS", "TOPIC"))
    src.add_argument("--messages", help="folder of folders of message files (key, value, timestamp)")
    c.add_argument("--policy", choices=["first", "last"], default="first")
    c.add_argument("--continuous", action="store_true", help="keep polling (default: drain and stop)")
    c.add_argument("--interval", default="10 seconds")
    c.add_argument("--rejects", help="folder for messages that break a rule or can't be parsed")
    c.add_argument("--starting-offsets", default="earliest")
    c.add_argument("--max-offsets", type=int, help="offsets per micro-batch")
    c.add_argument("--min-partitions", type=int, help="tasks of a micro-batch, at least")
    pr = sub.add_parser("produce", help="publish one entity's cleaned rows as keyed messages")
    pr.add_argument("entity", choices=["orders", "items", "payments"])
    pr.add_argument("--sf-dir", required=True)
    pr.add_argument("--kafka", nargs=2, metavar=("SERVERS", "TOPIC"), required=True)
    r = sub.add_parser("runs", help="summary of one run of the log, the latest by default")
    r.add_argument("--out", required=True)
    r.add_argument("--run-id")
    args = p.parse_args(argv)

    spark = _session()
    if args.cmd == "build":
        from martline.jobs import build_warehouse
        from martline.plans import runlog
        run = build_warehouse(spark, args.sf_dir, args.out, via_stream=args.stream,
                              enforce=args.enforce, messages=args.messages)
        for table, rows in run.rows_written.items():
            print(f"{table}: {rows} rows")
        runlog.summary(run.read("runlog").filter(f"run_id = '{run.run_id}'")).show(truncate=False)
    elif args.cmd == "consume":
        from martline.streaming import consumer
        from martline.streaming.sources import kafka_stream, message_file_stream
        messages = (kafka_stream(spark, *args.kafka, starting_offsets=args.starting_offsets,
                                 max_offsets_per_trigger=args.max_offsets,
                                 min_partitions=args.min_partitions) if args.kafka
                    else message_file_stream(spark, args.messages))
        q = consumer.run(args.entity, messages, args.target, args.checkpoint, args.policy,
                         available_now=not args.continuous, interval=args.interval,
                         rejects=args.rejects)
        q.awaitTermination()
        print(f"{args.entity}: {consumer.staged_table(spark, args.entity, args.target, args.policy).count()} rows staged")
    elif args.cmd == "produce":
        from martline.plans import stage
        from martline.plans import warehouse as wh
        from martline.streaming.sources import kafka_publish
        kafka_publish(stage.encode(args.entity, wh.cleaned(spark, args.sf_dir, args.entity)), *args.kafka)
    elif args.cmd == "runs":
        from martline.plans import runlog
        log = spark.read.parquet(f"{args.out.rstrip('/')}/runlog")
        runlog.summary(runlog.one_run(log, args.run_id)).show(truncate=False)
    else:
        from martline.catalog import QUERIES
        QUERIES[args.name](spark, args.sf_dir).show(args.show, truncate=False)


if __name__ == "__main__":
    main()
