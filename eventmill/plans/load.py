"""One load: landed pages to the event table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventmill.operators.dedup import STARTED
from eventmill.operators.normalize import loadable, normalize, rejected
from eventmill.operators.pagectl import keep_until, stop_points
from eventmill.operators.reports import latest_checkpoint
from eventmill.schemas import CORRUPT
from eventmill.session import splits_of
from eventmill.sinks.export import export_ids
from eventmill.sinks.tables import (
    Tables,
    append_rejects,
    events_saved,
    insert_if_absent,
    overwrite_stage,
    save_checkpoint,
)
from eventmill.sources.envelope import bad_bodies, bad_lines, decode, flatten, headers

#: Staged pages that a task unpacks.  In memory, where a task sorts them, their events take some 20 times the room.
SPLIT = "16m"


@dataclass(frozen=True)
class LoadResult:
    """``skipped``: pages that were landed but not loaded, because the named target was met."""

    inserted: int
    rejected: int
    skipped: int = 0


def as_column(ingest_ts: datetime | Column | None) -> Column:
    """The load stamp: read once, so that it is the same in every job of a load."""
    if isinstance(ingest_ts, Column):
        return ingest_ts
    return F.lit(ingest_ts or datetime.now(timezone.utc))


def typed_events(pages: DataFrame, ingest_ts: datetime | Column | None = None) -> DataFrame:
    """Landed pages to typed event rows, with ``reason`` on those that cannot be loaded."""
    return normalize(flatten(decode(pages)), as_column(ingest_ts))


def stage_pages(
    spark: SparkSession, pages: DataFrame, tables: Tables, stamp: Column
) -> tuple[DataFrame, int]:
    """Parses landed pages once, into the staging folder, and reads them back decoded.

    The folder is partitioned by source, so each source is loaded without reading the other,
    and its header columns are read without the events.  Log lines that could not be read go to
    the reject table; the second result is their number.
    """
    torn = Observation()
    bad = F.col(CORRUPT).isNotNull() if CORRUPT in pages.columns else F.lit(False)
    decoded = decode(pages.observe(torn, F.count_if(bad).alias("n")))
    staged = overwrite_stage(decoded, f"{tables.stage}/pages", partition_by="source")
    lines = append_rejects(spark, bad_lines(pages), tables, stamp) if torn.get.get("n", 0) else 0
    return staged, lines


def load_pages(
    spark: SparkSession,
    pages: DataFrame,
    tables: Tables,
    ingest_ts: datetime | Column | None = None,
    apply_stop_rules: bool = False,
    narrow_by_id: bool = False,
) -> LoadResult:
    """Loads landed pages, each id once; what cannot be loaded goes to the reject table."""
    stamp = as_column(ingest_ts)
    staged, lines = stage_pages(spark, pages, tables, stamp)
    loaded = load_staged(spark, staged, tables, stamp, apply_stop_rules, narrow_by_id)
    return LoadResult(loaded.inserted, loaded.rejected + lines)


def load_staged(
    spark: SparkSession,
    staged: DataFrame,
    tables: Tables,
    stamp: Column,
    apply_stop_rules: bool = False,
    narrow_by_id: bool = False,
    batch: str | None = None,
    filter_from: int | None = None,
) -> LoadResult:
    """Loads decoded pages from the staging folder.

    Of several copies in the same load the first to arrive wins, by the start of their runs.
    Stop rules tell a fetcher when to end; a page that was landed is loaded unless the caller
    asks for them, and the pages they cut off are recorded as rejects, ``after_stop``.
    Rejects are counted on the way; the pass that records them runs only if there are any.  A
    retried task may count a reject twice, which does no harm to a test against zero.
    """
    runs = staged.groupBy("run_id").agg(F.min("requested_at").alias(STARTED))
    used = staged.join(overwrite_stage(runs, f"{tables.stage}/runs"), "run_id", "left")
    cut = None
    if apply_stop_rules:
        # Written first: with its size known from the files, this small frame is broadcast by
        # the planner from the start, and the page bodies stay where they are.
        stops = overwrite_stage(stop_points(headers(staged)), f"{tables.stage}/stops")
        used = keep_until(used, stops)
        cut = after_stop(headers(staged), stops)
    rows = normalize(flatten(used), stamp)
    checked = Observation()
    counted = rows.observe(checked, F.count_if(F.col("reason").isNotNull()).alias("n"))
    bounds = loadable(rows) if narrow_by_id else None
    with splits_of(staged.sparkSession, SPLIT):
        inserted = insert_if_absent(spark, loadable(counted), tables, bounds, batch=batch, filter_from=filter_from)

    n_rejected = 0
    bodies = bad_bodies(staged) if cut is None else bad_bodies(staged).unionByName(cut)
    if checked.get.get("n", 0):
        n_rejected = append_rejects(spark, rejected(rows).unionByName(bodies), tables, stamp)
    elif not bodies.isEmpty():
        n_rejected = append_rejects(spark, bodies, tables, stamp)
    return LoadResult(inserted, n_rejected)


def after_stop(pages: DataFrame, stops: DataFrame) -> DataFrame:
    """Rejects among the pages: those beyond their run's stop."""
    limits = stops.select("run_id", "source", "stop_seq")
    return (
        pages.join(limits, ["run_id", "source"])
        .where(F.col("seq") > F.col("stop_seq"))
        .select(
            "run_id",
            "source",
            "seq",
            F.lit(None).cast("int").alias("pos"),
            F.lit("after_stop").alias("reason"),
            F.lit(None).cast("string").alias("raw"),
        )
    )


def run_batch(
    spark: SparkSession,
    pages: DataFrame,
    tables: Tables,
    export_path: str,
    target: int | None = None,
    ingest_ts: datetime | Column | None = None,
    apply_stop_rules: bool = False,
) -> LoadResult:
    """The whole job: load everything that was landed, save the final checkpoint; export.

    The pages are parsed once.  With a ``target`` named, nothing is loaded once the table holds
    that many events, and the events source only if the feed leaves the table short; the result
    tells how many pages were left out.
    """
    loaded = LoadResult(0, 0)
    stamp = as_column(ingest_ts)
    before = 0 if target is None else events_saved(spark, tables)
    if target is not None and before >= target:
        loaded = LoadResult(0, 0, pages.count())
    else:
        staged, lines = stage_pages(spark, pages, tables, stamp)
        if target is None:
            part = load_staged(spark, staged, tables, stamp, apply_stop_rules)
            loaded = LoadResult(part.inserted, part.rejected + lines)
        else:
            feed = staged.where(F.col("source") == "feed")
            part = load_staged(spark, feed, tables, stamp, apply_stop_rules)
            loaded = LoadResult(part.inserted, part.rejected + lines)
            rest = staged.where(~F.col("source").eqNullSafe("feed"))
            if before + loaded.inserted < target:
                part = load_staged(spark, rest, tables, stamp, apply_stop_rules)
                loaded = LoadResult(loaded.inserted + part.inserted, loaded.rejected + part.rejected)
            else:
                loaded = LoadResult(loaded.inserted, loaded.rejected, rest.count())
        finish(spark, tables, next_version(spark, tables))
    export_ids(spark.table(tables.events), export_path)
    return loaded


def next_version(spark: SparkSession, tables: Tables) -> int:
    spark.catalog.refreshTable(tables.checkpoints)
    last = spark.table(tables.checkpoints).agg(F.max("version")).first()[0]
    return 0 if last is None else last + 1


def finish(spark: SparkSession, tables: Tables, version: int) -> None:
    """The checkpoint of a completed run: no cursor to resume from."""
    total = F.lit(events_saved(spark, tables)).cast("bigint")
    state = spark.range(1).select(F.lit(None).cast("string").alias("cursor"), total.alias("events_saved"))
    save_checkpoint(spark, tables, state, version)


def load_checkpoint(spark: SparkSession, tables: Tables) -> DataFrame:
    """The current checkpoint, no row when nothing was saved yet."""
    spark.catalog.refreshTable(tables.checkpoints)
    return latest_checkpoint(spark.table(tables.checkpoints)).where("id = 1")

