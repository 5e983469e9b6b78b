"""Command line: the batch, speed and serving jobs, the producer and the
triage consumer.

    python -m riverwatch batch   --kafka HOST:PORT --topic T --out DIR
    python -m riverwatch batch   --messages DIR --out DIR
    python -m riverwatch incremental (--kafka HOST:PORT --topic T | --messages DIR) --out DIR
    python -m riverwatch speed   --kafka HOST:PORT --topic T --out DIR [--event-time]
                                 [--raw] [--alert-time] [--shared] [--stats-memory] [--once]
    python -m riverwatch serve   --batch DIR [--alerts DIR] QUERY [--location ID]
    python -m riverwatch produce --csv FILE (--kafka HOST:PORT --topic T | --messages DIR)
                                 [--missing-as-nan]
    python -m riverwatch triage  (--kafka HOST:PORT --topic T | --messages DIR) [--out DIR] [--once]

Folders may be any Hadoop path (hdfs://, s3a://, abfss://). A stream's
checkpoints belong to its output: they go below --out unless --checkpoint is
given. ``triage`` without --out prints and starts anew each time.
``--once`` processes what is available and stops (availableNow trigger).
``incremental`` takes what arrived since its last run and prints the analytics of all so far.
"""

from __future__ import annotations

import argparse
import sys

from riverwatch.session import build_session, work_path


def _source(spark, args, stream: bool):
    from riverwatch.sources.messages import read_messages

    return read_messages(spark, args.kafka, args.topic, args.messages, stream=stream,
                         min_partitions=args.min_partitions,
                         max_offsets_per_trigger=args.max_offsets if stream else None,
                         max_files_per_trigger=args.max_files if stream else None,
                         starting_offsets=args.starting_offsets,
                         ending_offsets=None if stream else args.ending_offsets)


def _show(df, limit: int | None = None) -> None:
    """Print every row (or the first ``limit``) as one JSON line, partition by partition."""
    df = df.limit(limit) if limit else df
    for line in df.toJSON().toLocalIterator():
        print(line)


def cmd_batch(spark, args) -> int:
    from pyspark.sql import functions as F

    from riverwatch.operators.decode import decode_kafka_batch
    from riverwatch.plans.batch import for_display, run_batch

    results = run_batch(spark, decode_kafka_batch(_source(spark, args, False), keep_nan=args.keep_nan),
                        args.out, run_id=args.run_id, materialize=not args.persist)
    if results is None:
        print("no messages in the source; nothing written")
        return 0
    # counted from the small risk distribution, not by another pass over the input
    total = results["risk_distribution"].agg(F.sum("count")).first()[0]
    print(f"loaded {total} records")
    _report(for_display(results), args.limit)
    return 0


def _report(results, limit: int | None) -> None:
    for name in ("location_stats", "risk_distribution", "hourly_patterns", "correlation",
                 "extreme_events"):
        print(f"== {name}")
        _show(results[name], limit)


def cmd_incremental(spark, args) -> int:
    from riverwatch.operators.decode import decode_kafka_batch
    from riverwatch.plans.batch import for_display
    from riverwatch.plans.incremental import IncrementalBatch

    layer = IncrementalBatch(spark, args.out, decode=lambda df: decode_kafka_batch(df, keep_nan=args.keep_nan))
    print(f"took {layer.run(_source(spark, args, True))} new messages")
    views = layer.views()
    if views is not None:
        _report(for_display(views), args.limit)
    return 0


def cmd_speed(spark, args) -> int:
    from riverwatch.streaming.speed import SpeedConfig, await_all, start_speed_layer

    out = args.out.rstrip("/")
    cfg = SpeedConfig(
        checkpoint_root=args.checkpoint or f"{out}/_checkpoints",
        alerts_path=f"{out}/flood_alerts",
        raw_path=f"{out}/raw_messages" if args.raw else None,
        stats_path=None if args.stats_memory else f"{out}/windowed_stats", stats_memory=args.stats_memory,
        time_col="event" if args.event_time else "processing_time",
        console=args.console,
        keep_nan=args.keep_nan,
        alerts_with_processing_time=args.alert_time,
        shared_stateless=args.shared,
        available_now=args.once,
        state_partitions=args.state_partitions,
        stats_mode=args.stats_mode,
        compact_every=args.compact_every,
        alerts_top_path=f"{out}/alerts_top" if args.alerts_top else None,
    )
    await_all(spark, start_speed_layer(_source(spark, args, True), cfg))
    return 0


def cmd_serve(spark, args) -> int:
    from riverwatch.plans.serving import ServingLayer

    df = ServingLayer(spark, args.batch, args.alerts, args.alerts_top).query(
        args.query, location_id=args.location, n=args.n)
    if df is None:
        print("view not available")
        return 1
    if args.out:
        df.write.mode("overwrite").json(args.out)
    else:
        _show(df, args.limit)
    return 0


def cmd_produce(spark, args) -> int:
    from riverwatch.sinks.batch import publish_kafka, write_message_files
    from riverwatch.sources.files import read_readings_csv

    df = read_readings_csv(spark, args.csv)
    if args.kafka:
        publish_kafka(df, args.kafka, args.topic, missing_as_nan=args.missing_as_nan)
    else:
        write_message_files(df, args.messages, mode="append", missing_as_nan=args.missing_as_nan)
    return 0


def cmd_triage(spark, args) -> int:
    from riverwatch.operators.decode import triage

    tagged = triage(_source(spark, args, True), keep_nan=args.keep_nan).writeStream
    if args.out:
        out = args.out.rstrip("/")
        w = (tagged.format("json").option("path", out)
             .option("checkpointLocation", args.checkpoint or f"{out}/_checkpoint"))
    else:  # every row of every micro-batch, printed here
        w = tagged.foreachBatch(lambda batch, _: _show(batch)).option(
            "checkpointLocation", args.checkpoint or work_path(spark, "triage"))
    if args.once:
        w = w.trigger(availableNow=True)
    w.start().awaitTermination()
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="riverwatch")
    sub = p.add_subparsers(dest="cmd", required=True)

    def src(sp, stream: bool, first: str = "earliest"):
        sp.add_argument("--kafka", help="bootstrap servers")
        sp.add_argument("--topic", help="topic the producer writes to (needed with --kafka)")
        sp.add_argument("--messages", help="folder of JSON message files instead of Kafka")
        sp.add_argument("--min-partitions", type=int, default=None, help="Kafka: least read tasks")
        sp.add_argument("--starting-offsets", default=None,
                        help=f"Kafka: earliest, latest or JSON ({first})")
        sp.add_argument("--keep-nan", action="store_true")
        if stream:
            sp.add_argument("--max-offsets", type=int, default=None,
                            help="Kafka: most records of a micro-batch")
            sp.add_argument("--max-files", type=int, default=None,
                            help="message files: most files of a micro-batch")
            sp.add_argument("--checkpoint", default=None)
            sp.add_argument("--once", action="store_true",
                            help="process what is available, then stop")

    b = sub.add_parser("batch"); src(b, False)
    b.add_argument("--out", required=True)
    b.add_argument("--run-id", default=None)
    b.add_argument("--limit", type=int, default=None, help="rows printed of each view (all)")
    b.add_argument("--persist", action="store_true", help="cache instead of materializing")
    b.add_argument("--ending-offsets", default=None,
                   help="Kafka: JSON offsets, the same for all scans (latest, looked up by each)")
    i = sub.add_parser("incremental"); src(i, True)
    i.add_argument("--out", required=True)
    i.add_argument("--limit", type=int, default=None, help="rows printed of each view (all)")
    s = sub.add_parser("speed"); src(s, True, "latest")
    s.add_argument("--out", required=True)
    s.add_argument("--raw", action="store_true", help="also archive raw messages")
    s.add_argument("--alert-time", action="store_true", help="alerts with the time they were processed")
    s.add_argument("--compact-every", type=int, default=None,
                   help="update mode: merge the batch folders each so many micro-batches")
    s.add_argument("--stats-memory", action="store_true",
                   help="stats to an in-memory table of this process (small state only) "
                        "instead of a parquet table under --out")
    s.add_argument("--event-time", action="store_true")
    s.add_argument("--shared", action="store_true",
                   help="one source read for alerts and raw archive (foreachBatch)")
    s.add_argument("--console", choices=["parsed", "raw"], default=None)
    s.add_argument("--alerts-top", action="store_true",
                   help="also keep an index of the ten latest alerts under --out/alerts_top")
    s.add_argument("--stats-mode", choices=["complete", "update", "append"], default="complete",
                   help="output mode of the windowed stats (complete = the reference's)")
    s.add_argument("--state-partitions", type=int, default=None,
                   help="state partitions of the windowed stats (fixed at first start)")
    v = sub.add_parser("serve")
    v.add_argument("--batch", required=True)
    v.add_argument("--alerts", default=None)
    v.add_argument("--alerts-top", default=None, help="the speed layer's alert top-k index")
    v.add_argument("query", choices=["alerts", "location", "risk_summary", "high_risk"])
    v.add_argument("--location", default=None)
    v.add_argument("-n", type=int, default=10, help="alerts: how many of the latest")
    v.add_argument("--limit", type=int, default=None, help="rows printed (all)")
    v.add_argument("--out", default=None, help="write the rows as JSON files instead")
    r = sub.add_parser("produce")
    r.add_argument("--csv", required=True)
    r.add_argument("--kafka"); r.add_argument("--topic")
    r.add_argument("--messages")
    r.add_argument("--missing-as-nan", action="store_true",
                   help="send empty numeric cells as NaN (as a pandas-based producer does)")
    t = sub.add_parser("triage"); src(t, True)
    t.add_argument("--out", default=None, help="append the tagged messages as JSON files")
    return p


COMMANDS = {"batch": cmd_batch, "speed": cmd_speed, "serve": cmd_serve,
            "produce": cmd_produce, "triage": cmd_triage, "incremental": cmd_incremental}


def _parse(argv: list[str]) -> argparse.Namespace:
    p = parser()
    args = p.parse_args(argv)
    if getattr(args, "kafka", None) and not getattr(args, "topic", None):
        p.error("--kafka needs --topic")
    kafka_only = ("min_partitions", "starting_offsets", "ending_offsets", "max_offsets")
    unused = kafka_only if not getattr(args, "kafka", None) else ("max_files",)
    for name in unused:
        if getattr(args, name, None) is not None:
            p.error(f"--{name.replace('_', '-')} has no meaning for this source")
    if args.cmd in ("triage", "incremental") and args.kafka and not args.starting_offsets:
        args.starting_offsets = "earliest"  # the consumer's: all there is, at its first start
    if args.cmd in ("batch", "incremental", "speed", "triage", "produce") and not (args.kafka or args.messages):
        p.error("give --kafka HOST:PORT --topic T, or --messages DIR")
    return args


def run(spark, argv: list[str]) -> int:
    """Parse and run one command on an existing session."""
    args = _parse(argv)
    return COMMANDS[args.cmd](spark, args)


def main(argv: list[str] | None = None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    args = _parse(argv)
    spark = build_session(app_name=f"riverwatch-{args.cmd}")
    try:
        return COMMANDS[args.cmd](spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
