"""Jobs for spark-submit.

``batch``   load landed pages, save the final checkpoint, export the sorted ids
``stream``  load what has landed since the last run
``report``  count, latest time, checkpoint and progress of the event table
``layout``  compact the event table, or write it by time or by session
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import SparkSession

from eventmill.operators import reports
from eventmill.plans.load import load_checkpoint, run_batch
from eventmill.session import configure
from eventmill.sinks import layout
from eventmill.sinks.tables import create_tables
from eventmill.sources.page_log import read_pages, stream_pages
from eventmill.streaming.ingest import run_stream


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="eventmill", description=__doc__)
    parser.add_argument("job", choices=["batch", "stream", "report", "layout"])
    parser.add_argument("--database", required=True)
    parser.add_argument("--location", required=True, help="folder of the tables, shared by all executors")
    parser.add_argument("--buckets", type=int, help="of a new event table; default: shuffle partitions")
    parser.add_argument("--pages", help="folder of the landed page log")
    parser.add_argument("--export", help="folder for the sorted ids")
    parser.add_argument("--target", type=int, help="batch: load nothing beyond it; report: events wanted")
    parser.add_argument("--offsets", help="streaming checkpoint folder; default: below the location")
    parser.add_argument("--max-files", type=int, help="page files per micro-batch")
    parser.add_argument("--max-bytes", type=int, help="bytes of page files per micro-batch")
    parser.add_argument("--every", help="keep streaming at this interval, such as '1 minute'")
    parser.add_argument("--narrow-by-id", action="store_true", help="ids grow over time")
    parser.add_argument("--start-ms", type=int, help="start of the run, for the rate")
    parser.add_argument("--by", choices=["id", "time", "session"], default="id")
    parser.add_argument("--out", help="folder for the layout by time or session")
    args = parser.parse_args(argv)
    needed = {"batch": ["pages", "export"], "stream": ["pages"], "report": [], "layout": []}[args.job]
    if args.job == "layout" and args.by != "id":
        needed = ["out"]
    missing = [f"--{name}" for name in needed if getattr(args, name) is None]
    if missing:
        parser.error(f"{args.job} needs {' and '.join(missing)}")
    return args


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    configure(spark)
    tables = create_tables(spark, args.database, args.location, args.buckets)
    if args.job == "batch":
        done = run_batch(spark, read_pages(spark, args.pages), tables, args.export, args.target)
        print(f"inserted {done.inserted}, rejected {done.rejected}, pages skipped {done.skipped}")
    elif args.job == "stream":
        pages = stream_pages(spark, args.pages, args.max_files, args.max_bytes)
        offsets = args.offsets or f"{tables.location}/offsets"
        query = run_stream(
            spark, pages, tables, offsets, narrow_by_id=args.narrow_by_id, every=args.every
        )
        query.awaitTermination()
    elif args.job == "layout" and args.by == "id":
        print(layout.compact_events(spark, tables))
    elif args.job == "layout":
        write = layout.write_by_time if args.by == "time" else layout.write_by_session
        write(spark.table(tables.events), args.out)
    if args.job != "layout":
        report(spark, tables, args)


def report(spark: SparkSession, tables, args: argparse.Namespace) -> None:
    spark.catalog.refreshTable(tables.events)
    events = spark.table(tables.events)
    now = int(time.time() * 1000)
    start = args.start_ms if args.start_ms is not None else now
    line = reports.progress(reports.event_count(events), start, now, args.target or reports.TARGET)
    line.withColumn("max_ts", reports.max_event_ms(events).scalar()).show(truncate=False)
    load_checkpoint(spark, tables).show(truncate=False)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = SparkSession.builder.appName(f"eventmill-{args.job}").getOrCreate()
    run(spark, args)
    spark.stop()


if __name__ == "__main__":
    main()
