"""Command line: run the pipeline, query the lake, drain or tail a stream.

    python -m frostlake pipeline RAW_JSON LAKE [--format parquet] [--gold-form shared]
    python -m frostlake tables LAKE
    python -m frostlake page LAKE LAYER [TABLE] [--page 1] [--limit 50]
    python -m frostlake sql LAKE "SELECT ..." [--cap 1000]
    python -m frostlake dashboard LAKE
    python -m frostlake export LAKE LAYER [TABLE] --out DIR [--format csv|json] [--page 1] [--limit 50]
    python -m frostlake drain (--files DIR | --kafka SERVERS --topic T) --out OUT --checkpoint CK [--rejects DIR]
    python -m frostlake live (--files DIR | --kafka SERVERS --topic T) --root ROOT --checkpoint CK [--once]

Serving commands print JSON. On a cluster, run through spark-submit and let
the cluster set ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import json
import sys


def _json_default(o):
    if isinstance(o, (dt.datetime, dt.date)):
        return o.isoformat()
    if isinstance(o, decimal.Decimal):
        return float(o)
    return str(o)


def _print(obj) -> None:
    json.dump(obj, sys.stdout, default=_json_default, indent=2)
    sys.stdout.write("\n")


def _values(spark, args):
    """The messages, undecoded."""
    from frostlake.sources import topics as TP

    if args.kafka:
        return TP.kafka_stream(spark, args.kafka, args.topic, args.starting_offsets)
    return TP.file_value_stream(spark, args.files, max_files_per_trigger=args.max_files_per_trigger)


def _stream_source(spark, args):
    from frostlake.sources import topics as TP

    values = _values(spark, args)
    if args.kafka:
        return TP.decode_topic(values)
    return TP.accepted(TP.decode_json_values(values, TP.live_schema_with_seq()))


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="frostlake")
    sub = p.add_subparsers(dest="cmd", required=True)

    a = sub.add_parser("pipeline", help="raw JSON -> batch -> staging -> silver -> gold")
    a.add_argument("raw")
    a.add_argument("lake")
    a.add_argument("--format", default="auto", help="parquet, delta, or auto (delta when installed)")
    a.add_argument("--gold-form", default="shared", choices=("shared", "direct"))
    a.add_argument("--overwrite-schema", action="store_true")
    a.add_argument("--partition-silver-by-date", action="store_true")

    a = sub.add_parser("tables", help="catalogue of the lake")
    a.add_argument("lake")

    a = sub.add_parser("page", help="one page of a layer or gold table")
    a.add_argument("lake")
    a.add_argument("layer")
    a.add_argument("table", nargs="?")
    a.add_argument("--page", type=int, default=1)
    a.add_argument("--limit", type=int, default=50)

    a = sub.add_parser("sql", help="read-only free SQL over the lake views")
    a.add_argument("lake")
    a.add_argument("query")
    a.add_argument("--cap", type=int, default=1000)

    a = sub.add_parser("dashboard", help="dashboard metrics and totals")
    a.add_argument("lake")

    a = sub.add_parser("export", help="export one page of a layer or gold table as CSV or JSON")
    a.add_argument("lake")
    a.add_argument("layer")
    a.add_argument("table", nargs="?")
    a.add_argument("--out", required=True)
    a.add_argument("--format", default="csv", choices=("csv", "json"))
    a.add_argument("--page", type=int, default=1)
    a.add_argument("--limit", type=int, default=50)

    for name, help_ in (("drain", "drain a topic/folder into JSON lines"), ("live", "keep the live views current")):
        a = sub.add_parser(name, help=help_)
        src = a.add_mutually_exclusive_group(required=True)
        src.add_argument("--files")
        src.add_argument("--kafka")
        a.add_argument("--topic")
        a.add_argument("--starting-offsets", default="earliest" if name == "drain" else "latest")
        a.add_argument("--max-files-per-trigger", type=int, default=None)
        a.add_argument("--checkpoint", required=True)
        if name == "drain":
            a.add_argument("--out", required=True)
            a.add_argument("--rejects", help="folder for messages that are no JSON object")
            a.add_argument("--quiet-polls", type=int, default=3, help="end after so many runs that find nothing new")
            a.add_argument("--pause", type=float, default=1.0, help="seconds between runs")
            a.add_argument("--timeout", type=float, default=300.0, help="start no run after so many seconds")
        else:
            a.add_argument("--archive", help="folder for every decoded message, as JSON lines")
            a.add_argument("--once", action="store_true", help="process what is available, then stop")

    args = p.parse_args(argv)

    from pyspark.sql import SparkSession

    from frostlake.plans import serving as S
    from frostlake.session import build_session
    from frostlake.sources.lake import lake_format

    owned = SparkSession.getActiveSession() is None
    spark = build_session()
    if args.cmd == "pipeline":
        from frostlake.plans.medallion import PipelineConfig, run_pipeline

        from frostlake.sources.lake import resolve_format

        cfg = PipelineConfig(
            fmt=resolve_format(spark, args.format),
            gold_form=args.gold_form,
            overwrite_schema=args.overwrite_schema,
            silver_partition_by=("Date",) if args.partition_silver_by_date else (),
        )
        log = run_pipeline(spark, args.raw, args.lake, cfg)
        _print({"run_id": log.run_id, "seconds": log.as_dict()})
    elif args.cmd == "tables":
        _print([r.asDict() for r in S.list_tables(spark, args.lake).collect()])
    elif args.cmd == "page":
        fmt = lake_format(spark, args.lake)
        _print(S.table_page_response(spark, args.lake, args.layer, args.table, args.page, args.limit, fmt=fmt))
    elif args.cmd == "sql":
        _print(S.query_response(spark, args.lake, args.query, args.cap, fmt=lake_format(spark, args.lake)))
    elif args.cmd == "dashboard":
        _print(S.dashboard_response(spark, args.lake, fmt=lake_format(spark, args.lake)))
    elif args.cmd == "export":
        from frostlake.sinks.files import export_csv, export_json
        from frostlake.sources.lake import read_layer

        fmt = lake_format(spark, args.lake)
        df = read_layer(spark, args.lake, args.layer, args.table if args.layer == "gold" else None, fmt)
        page = S.page_table(df, args.page, args.limit)
        (export_csv if args.format == "csv" else export_json)(page, args.out, single_file=True)
        _print({"exported": args.out, "format": args.format, "page": args.page, "limit": args.limit})
    elif args.cmd == "drain":
        from dataclasses import asdict

        from frostlake.streaming.live import drain_until_quiet, start_dump_json, start_dump_rejects

        run = lambda: start_dump_json(_stream_source(spark, args), args.out, args.checkpoint)
        found = drain_until_quiet(run, args.quiet_polls, args.pause, args.timeout)
        if args.rejects:
            start_dump_rejects(_values(spark, args), args.rejects, f"{args.checkpoint.rstrip('/')}-rejects").awaitTermination()
        _print(asdict(found))
    elif args.cmd == "live":
        from frostlake.streaming.live import start_live_views

        q = start_live_views(_stream_source(spark, args), args.checkpoint, archive=args.archive, available_now=args.once)
        q.awaitTermination()
    if owned:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
