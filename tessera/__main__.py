"""Run the pipeline's jobs from the command line.

    python -m tessera publish  --events DIR | --tickets DIR [--format parquet|json|csv] --log DIR
    python -m tessera export   --log DIR | --kafka HOST:PORT [--topic T]
                               --parquet DIR --json DIR --checkpoint DIR
                               [--mode dual|foreach_batch] [--trigger "15 seconds" | --available-now]
                               [--run-seconds N] [--from-now] [--progress DIR]
    python -m tessera replay   --log DIR | --kafka HOST:PORT --checkpoint DIR [--out DIR | --preview] [--follow]
    python -m tessera analyse  --parquet DIR --json DIR --out DIR [--date-mode lenient|strict|skip|inferred]
    python -m tessera load-relational --parquet DIR (--path DIR [--catalog] | --jdbc-url URL [--jdbc-option k=v ...])
    python -m tessera load-columnar   --parquet DIR (--path DIR [--catalog] [--load-id ID] | --jdbc-url URL [--jdbc-option k=v ...])
    python -m tessera dashboard       --parquet DIR --cube DIR [--name tickets_by_team]

The session comes from ``SparkSession.builder.getOrCreate()``, so
``spark-submit`` settings (master, shared checkpoint folder, object-store
credentials) apply unchanged.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from tessera.schemas import DEFAULT_TABLE, DEFAULT_TOPIC
from tessera.sources.kafka import FILES_PER_BATCH, MESSAGES_PER_BATCH


def _source(spark: SparkSession, args, starting_offsets: str):
    from tessera.sources.kafka import read_message_log, read_message_text_log, read_topic

    if args.kafka:
        return read_topic(
            spark,
            args.kafka,
            args.topic,
            starting_offsets,
            max_offsets_per_trigger=args.max_offsets_per_trigger,
            min_partitions=args.min_partitions,
        )
    if args.log:
        return read_message_log(spark, args.log, args.max_files_per_trigger)
    if args.text_log:
        return read_message_text_log(spark, args.text_log, args.max_files_per_trigger)
    raise SystemExit("give --log, --text-log or --kafka")


def _jdbc(args) -> dict | None:
    if not args.jdbc_url:
        return None
    options = {"url": args.jdbc_url}
    for item in args.jdbc_option or []:
        key, _, value = item.partition("=")
        options[key] = value
    return options


def _tickets(spark: SparkSession, args):
    """The tickets to publish: a table of them, or those derived from events."""
    if args.events:
        from tessera.plans.fixtures import read_table, tickets_from_events

        return tickets_from_events(read_table(spark, args.events, "events"))
    from tessera.operators.quality import require_columns
    from tessera.schemas import MESSAGE_FIELDS, MESSAGE_SCHEMA
    from tessera.sinks.files import read_csv
    from tessera.sources.files import read_json_dir, read_parquet_dir

    if args.format == "parquet":
        return require_columns(read_parquet_dir(spark, args.tickets), MESSAGE_FIELDS)
    read = read_json_dir if args.format == "json" else read_csv
    return read(spark, args.tickets, MESSAGE_SCHEMA)


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tessera")
    parser.add_argument("--ui", action="store_true", help="start Spark's web UI (off by default)")
    parser.add_argument("--input-bytes", type=int, help="expected input size: sizes the shuffle for it")
    sub = parser.add_subparsers(dest="command", required=True)

    p = sub.add_parser("publish", help="publish tickets derived from an events table")
    what = p.add_mutually_exclusive_group(required=True)
    what.add_argument("--tickets", help="folder of tickets to publish, with the message fields as columns")
    what.add_argument("--events", help="folder holding events.parquet, to derive tickets from")
    p.add_argument("--format", choices=["parquet", "json", "csv"], default="parquet", help="of the --tickets files")
    p.add_argument("--log", help="message-log folder to append to")
    p.add_argument("--kafka", help="Kafka bootstrap servers")
    p.add_argument("--topic", default=DEFAULT_TOPIC)

    for name, start in (("export", "latest"), ("replay", "earliest")):
        p = sub.add_parser(name)
        p.add_argument("--log", help="message-log folder (Parquet: key, value bytes)")
        p.add_argument("--text-log", help="folder of JSON-lines message files")
        p.add_argument("--kafka")
        p.add_argument("--topic", default=DEFAULT_TOPIC)
        p.add_argument("--max-files-per-trigger", type=int, default=FILES_PER_BATCH, help="log folders: bound each micro-batch")
        p.add_argument("--max-offsets-per-trigger", type=int, default=MESSAGES_PER_BATCH, help="Kafka: bound each micro-batch")
        p.add_argument("--min-partitions", type=int, help="Kafka: split topic partitions into more tasks")
        p.add_argument("--checkpoint", required=True)
        p.add_argument("--run-seconds", type=float)
        p.set_defaults(starting_offsets=start)
    export = sub.choices["export"]
    export.add_argument("--parquet", required=True)
    export.add_argument("--json", required=True)
    export.add_argument("--mode", choices=["dual", "foreach_batch"], default="dual")
    export.add_argument("--trigger", default="15 seconds")
    export.add_argument("--available-now", action="store_true")
    export.add_argument("--from-now", action="store_true", help="log folders: only messages that come after the first start")
    export.add_argument("--progress", help="folder for a table of each micro-batch's progress")
    export.add_argument("--files-per-batch", type=int, help="foreach_batch mode: files per format per micro-batch")
    replay = sub.choices["replay"]
    replay.add_argument("--out", help="folder for the replayed tickets (default: CHECKPOINT_records)")
    replay.add_argument("--preview", action="store_true", help="print the first rows of each micro-batch instead of keeping all")
    replay.add_argument("--follow", action="store_true", help="keep listening for new messages")
    replay.add_argument("--trigger", help="micro-batch interval when following, e.g. '5 seconds'")

    p = sub.add_parser("analyse")
    p.add_argument("--parquet", required=True)
    p.add_argument("--json", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--date-mode", choices=["lenient", "strict", "skip", "inferred"], default="lenient")
    p.add_argument("--priorities", nargs="+", help="also write the team and priority table with these columns")

    for name in ("load-relational", "load-columnar"):
        p = sub.add_parser(name)
        p.add_argument("--parquet", required=True)
        p.add_argument("--path")
        p.add_argument("--jdbc-url")
        p.add_argument("--jdbc-option", action="append")
        p.add_argument("--table", default=DEFAULT_TABLE)
        p.add_argument("--catalog", action="store_true", help="a table of Spark's catalog, with its files under --path")
    sub.choices["load-columnar"].add_argument("--load-id", help="name of this load: a second run under it replaces the first one's rows")

    p = sub.add_parser("dashboard", help="count the part files that came since the last time, then print a dashboard statement")
    p.add_argument("--parquet", required=True)
    p.add_argument("--cube", required=True, help="folder of the counts")
    p.add_argument("--name", default="tickets_by_team")
    return parser


def _object_store_paths(args) -> list[str]:
    names = ("log", "text_log", "tickets", "parquet", "json", "checkpoint", "out", "path", "events", "cube", "progress")
    return [v for v in (getattr(args, n, None) for n in names) if isinstance(v, str) and v.startswith("s3a://")]


def run(args, spark: SparkSession) -> dict:
    from tessera.session import apply_settings, ensure_shared_dir, scale_settings
    from tessera.sources.objectstore import require_endpoint

    if args.input_bytes:
        apply_settings(spark, scale_settings(args.input_bytes))
    if _object_store_paths(args):
        require_endpoint(spark)  # S7: fail early, before any query starts
    ensure_shared_dir(spark)
    if args.command == "publish":
        from tessera.streaming.publish import publish_tickets

        publish_tickets(_tickets(spark, args), log_path=args.log, bootstrap_servers=args.kafka, topic=args.topic)
        return {"published": True}
    if args.command == "export":
        from tessera.streaming.export import run_export

        finished = run_export(
            _source(spark, args, args.starting_offsets),
            args.parquet,
            args.json,
            args.checkpoint,
            mode=args.mode,
            trigger=args.trigger,
            available_now=args.available_now,
            run_seconds=args.run_seconds,
            files_per_batch=args.files_per_batch,
            starting="latest" if args.from_now else "earliest",
            progress_path=args.progress,
        )
        return {"finished": finished}
    if args.command == "replay":
        from tessera.streaming.replay import run_replay

        sink = "console" if args.preview else "parquet"
        finished = run_replay(
            _source(spark, args, args.starting_offsets),
            args.checkpoint,
            sink=sink,
            path=args.out or f"{args.checkpoint.rstrip('/')}_records",
            run_seconds=args.run_seconds,
            follow=args.follow,
            trigger=args.trigger,
        )
        return {"finished": finished}
    if args.command == "analyse":
        from tessera.plans.analyse import analyse

        result = analyse(spark, args.parquet, args.json, args.out, date_mode=args.date_mode, priorities=args.priorities)
        return {
            "audit": result.audit,
            "columns": result.columns,
            "null_report": result.null_report,
            "daily_skipped": result.daily_skipped,
            "paths": result.paths,
        }
    if args.command in ("load-relational", "load-columnar"):
        from tessera.plans.loads import load_columnar, load_relational

        load = load_relational if args.command == "load-relational" else load_columnar
        extra = {"load_id": args.load_id} if args.command == "load-columnar" else {}
        loaded = load(spark, args.parquet, path=args.path, jdbc=_jdbc(args), table=args.table, catalog=args.catalog, **extra)
        return {"rows": loaded.rows, "files": loaded.files}
    if args.command == "dashboard":
        from tessera.plans.cube import dashboard_from_cube, update_cube

        new = update_cube(spark, args.parquet, args.cube)
        return {"new_files": len(new), args.name: [row.asDict() for row in dashboard_from_cube(spark, args.cube, args.name).collect()]}
    raise SystemExit(f"unknown command {args.command}")


def main(argv=None) -> int:
    args = build_parser().parse_args(argv)
    builder = SparkSession.builder.appName(f"tessera-{args.command}")
    if not args.ui:
        builder = builder.config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    print(json.dumps(run(args, spark), ensure_ascii=False, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
