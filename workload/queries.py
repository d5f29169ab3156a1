"""The registered queries.  Each takes (spark, folder of the given tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill import schemas
from eventmill.functions import cursors, text, timestamps, variants
from eventmill.operators import chains, dedup, normalize, pagectl, reports
from eventmill.plans import load
from eventmill.session import configure, scratch_dir
from eventmill.sinks import export, layout, tables as sinks
from eventmill.sources import arrays, envelope, page_log, sessions, tables as scans
from eventmill.streaming.ingest import run_stream
from workload.landing import events, land, landed

Query = Callable[[SparkSession, str], DataFrame]

# The load stamp of every query, so that defaulted times are the same on both sides.
INGEST_TS = datetime(2024, 3, 1, tzinfo=timezone.utc)
LATER_TS = datetime(2024, 3, 2, tzinfo=timezone.utc)
SINCE_MS, UNTIL_MS = 1_704_844_800_000, 1_705_708_800_000  # 2024-01-10 and 2024-01-20
START_MS, NOW_MS = 1_709_251_200_000, 1_709_251_237_000
COUNT_TARGET = 3000
LATE_SECONDS = 6 * 3600


def typed(spark: SparkSession, sf_dir: str, log: str = "arrivals") -> DataFrame:
    return normalize.loadable(load.typed_events(landed(spark, sf_dir, log), INGEST_TS))


def winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.first_wins(typed(spark, sf_dir))


def control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page headers of the control log, staged as a load does, so bodies are parsed once."""
    decoded = envelope.decode(landed(spark, sf_dir, "control"))
    staged = sinks.overwrite_stage(decoded, scratch_dir(spark, "pages"), partition_by="source")
    return envelope.headers(staged)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.with_rate_limit(envelope.classify(landed(spark, sf_dir, "requests")))


_loaded: dict[tuple[str, str], str] = {}


def loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table loaded from the arrivals; once per session and table folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _loaded:
        t = fresh_tables(spark)
        load.load_pages(spark, landed(spark, sf_dir, "arrivals"), t, INGEST_TS)
        _loaded[key] = t.events
    configure(spark)
    return spark.table(_loaded[key])


def fresh_tables(spark: SparkSession) -> sinks.Tables:
    configure(spark)
    name = f"eventmill_{uuid.uuid4().hex[:12]}"
    return sinks.create_tables(spark, name, scratch_dir(spark, name))


def slim(df: DataFrame) -> DataFrame:
    """The identifying columns of event rows, times as epoch milliseconds."""
    return df.select("id", "type", F.unix_millis("timestamp").alias("ms"), "run_id", "seq", "pos")


# Sources ---------------------------------------------------------------------------------


def scan_source(source: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        pages = page_log.read_pages(spark, land(spark, sf_dir, "control"), source)
        return envelope.decode(pages).select("run_id", "seq", "request_cursor", "n_events")

    return query


def stream_page_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "streamed")
    pages = page_log.stream_pages(spark, land(spark, sf_dir, "control"), max_files=4)
    query = (
        envelope.decode(pages)
        .select("run_id", "source", "seq", "n_events")
        .writeStream.format("parquet")
        .option("path", f"{out}/pages")
        .option("checkpointLocation", f"{out}/offsets")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{out}/pages")


def decode_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control(spark, sf_dir).select(
        "run_id", "source", "seq", "page_limit", "has_more", "next_cursor", "cursor_expires_in",
        "meta_total", "meta_returned", "request_id", "n_events",
    )


def flatten_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = envelope.flatten(envelope.decode(landed(spark, sf_dir, "arrivals")))
    return flat.select("run_id", "seq", "pos", variants.as_text(variants.field(F.col("e"), "id")).alias("id"))


def unnest_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page, parallel arrays of ids, types and clicked ids; the last one is shorter."""
    row = F.struct("event_id", "event_type")
    packed = events(spark, sf_dir).groupBy(F.floor(F.col("event_id") / 100).alias("p")).agg(
        F.array_sort(F.collect_list(row)).alias("a"),
    )
    clicked = F.filter("a", lambda x: x["event_type"] == "click")
    arrays_ = packed.select(
        "p",
        F.col("a.event_id").alias("ids"),
        F.col("a.event_type").alias("types"),
        clicked["event_id"].alias("clicks"),
    )
    return arrays.unnest(arrays_, ["ids", "types", "clicks"], ["p"])


def time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both bounds over the date-partitioned layout."""
    path = scratch_dir(spark, "by-time")
    layout.write_by_time(loaded(spark, sf_dir), path)
    return slim(scans.time_range(spark.read.parquet(path), SINCE_MS, UNTIL_MS))


def session_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = sessions.read_sessions(landed(spark, sf_dir, "sessions"))
    return read.select("id", "userId", "eventCount", "duration")


def session_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whatever is no session in a log of torn bodies and odd records."""
    return sessions.rejected_sessions(landed(spark, sf_dir, "odd_sessions"))


def target_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slim(loaded(spark, sf_dir))


def checkpoint_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after one checkpoint per day of events, looked up by its key."""
    return scans.lookup_checkpoint(checkpoint_latest(spark, sf_dir)).select("cursor", "events_saved")


# Projections, scalars --------------------------------------------------------------------


def normalize_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(spark, sf_dir)
    return rows.select("id", "seq", F.unix_millis("timestamp").alias("ms"), "ts_defaulted")


def project_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    props, raw = F.col("properties"), F.col("raw")
    return typed(spark, sf_dir).select(
        "seq", "pos", "id", "session_id", "type", "user_id",
        props.isNull().alias("no_properties"),
        F.try_variant_get(props, "$.k", "bigint").alias("k"),
        variants.as_text(variants.field(raw, "name")).alias("raw_name"),
        F.unix_millis("ingested_at").alias("ingested_ms"),
        "event_date",
    )


def iso_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("timestamp")
    return loaded(spark, sf_dir).select(
        "id", timestamps.iso_text(ts).alias("iso"), F.unix_seconds(ts).alias("epoch_s")
    )


def mask_secret(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded(spark, sf_dir).select("id", text.mask_secret(F.col("session_id")).alias("masked"))


def decode_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next cursors of the arrivals, and the undecodable ones of the control log."""
    columns = ["run_id", "seq", "next_cursor"]
    pages = landed(spark, sf_dir, "arrivals").unionByName(landed(spark, sf_dir, "control"))
    now = F.lit(1704067200000 + 20 * 60000)
    return envelope.headers(envelope.decode(pages)).select(*columns).select(
        "run_id", "seq", cursors.decode_cursor(F.col("next_cursor")).alias("c"),
        cursors.cursor_expired(F.col("next_cursor"), now).alias("expired"),
    ).select("run_id", "seq", "c.*", "expired")


def path_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = landed(spark, sf_dir, "requests").withColumn("bucket", text.path_bucket(F.col("path")))
    return calls.groupBy("bucket").agg(F.count("*").alias("requests"))


def header_ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests(spark, sf_dir).select("seq", "rate_limit", "rate_remaining", "rate_reset")


def backoff_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected waits of retryable requests, by the failures in a row of their run and source."""
    attempted = pagectl.attempts(requests(spark, sf_dir))
    attempt = F.col("attempt")
    return attempted.where(F.col("outcome") == "retryable").select(
        "seq",
        "attempt",
        text.backoff_ms(attempt).alias("capped_ms"),
        text.backoff_ms(attempt, None).alias("uncapped_ms"),
        text.run_retry_ms(attempt).alias("run_retry_ms"),
    )


def raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events out as JSON text and back in."""
    again = F.try_parse_json(F.to_json("raw"))
    return loaded(spark, sf_dir).select(
        "id",
        variants.as_text(variants.field(again, "sessionId")).alias("session_id"),
        variants.as_text(variants.field(again, "type")).alias("type"),
    )


def copy_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as COPY rows: their text holds line breaks to escape."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select(
        export.copy_line(F.col("doc_id").cast("string"), F.col("lang"), F.col("text")).alias("value")
    )


# Filters ---------------------------------------------------------------------------------


def classify_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests(spark, sf_dir).select("seq", "source", "status", "outcome", "wait_s")


def page_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control(spark, sf_dir).select(
        "seq", pagectl.is_nonempty().alias("nonempty"), pagectl.is_terminal().alias("terminal")
    )


def target_reached(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = loaded(spark, sf_dir)
    counted = reports.target_reached(reports.event_count(table), COUNT_TARGET)
    since = reports.max_event_ms(table).select(reports.since_bound(F.col("max_ts"))).scalar()
    return counted.withColumn("since_ms", since)


def key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Before and after dedup."""
    before = reports.key_check(typed(spark, sf_dir)).withColumn("stage", F.lit("arrivals"))
    after = reports.key_check(loaded(spark, sf_dir)).withColumn("stage", F.lit("events"))
    return before.unionByName(after)


# Joins, dedup, sets ----------------------------------------------------------------------


def dedup_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slim(winners(spark, sf_dir))


def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last attempt is loaded first; the others may only add what it lacks."""
    t = fresh_tables(spark)
    pages = landed(spark, sf_dir, "arrivals")
    load.load_pages(spark, pages.where(F.col("run_id") == "run-3"), t, INGEST_TS)
    load.load_pages(spark, pages, t, LATER_TS, narrow_by_id=True)
    stamped = spark.table(t.events).withColumn("ingested_ms", F.unix_millis("ingested_at"))
    return stamped.select("id", "type", "run_id", "seq", "pos", "ingested_ms")


def rows_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = insert_if_absent(spark, sf_dir)
    return loaded.groupBy("ingested_ms").agg(F.count("*").alias("inserted"))


def insert_from_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The array path: pages as parallel arrays, unnested and loaded; same table."""
    t = fresh_tables(spark)
    columns = [*schemas.PAYLOAD, "ingested_at", "ts_defaulted", "event_date", "pos"]
    packed = typed(spark, sf_dir).groupBy("source", "run_id", "seq").agg(
        F.collect_list(F.struct(*columns)).alias("a")
    )
    parallel = packed.select("source", "run_id", "seq", *[F.col(f"a.{c}").alias(c) for c in columns])
    rows = arrays.unnest(parallel, columns, ["source", "run_id", "seq"])
    sinks.insert_if_absent(spark, rows.select(*schemas.EVENT_COLUMNS), t)
    return slim(spark.table(t.events))


def staging_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload columns staged twice: the second load replaces the first."""
    path = scratch_dir(spark, "stage")
    rows = typed(spark, sf_dir).select(*schemas.PAYLOAD)
    sinks.overwrite_stage(rows, path)
    staged = sinks.overwrite_stage(rows, path)
    return staged.select(
        "id", "session_id", "type", "user_id", F.unix_millis("timestamp").alias("ms"),
        F.try_variant_get("properties", "$.k", "bigint").alias("k"),
    )


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fresh_tables(spark)
    load.load_pages(spark, landed(spark, sf_dir, "dirty"), t, INGEST_TS)
    return spark.table(t.rejects).select("run_id", "source", "seq", "pos", "reason")


def load_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is loaded from between the rejects."""
    t = fresh_tables(spark)
    load.load_pages(spark, landed(spark, sf_dir, "dirty"), t, INGEST_TS)
    return slim(spark.table(t.events))


def page_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagectl.page_chain(control(spark, sf_dir))


def cursor_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of a log whose page numbers say nothing."""
    return chains.cursor_chains(envelope.headers(envelope.decode(landed(spark, sf_dir, "shuffled"))))


def backfill_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sinks.overwrite_stage(typed(spark, sf_dir, "sources"), scratch_dir(spark, "sources"))
    feed = dedup.first_wins(rows.where(F.col("source") == "feed"))
    fallback = rows.where(F.col("source") == "events")
    return slim(dedup.backfill(feed, fallback, reports.TARGET))


def backfill_missing_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backfill where a third of either source's events carry no time."""
    rows = sinks.overwrite_stage(typed(spark, sf_dir, "timeless"), scratch_dir(spark, "timeless"))
    feed = dedup.first_wins(rows.where(F.col("source") == "feed"))
    fallback = rows.where(F.col("source") == "events")
    return slim(dedup.backfill(feed, fallback, reports.TARGET))


def replay_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts in another order than their run ids, one of them repeated."""
    rows = typed(spark, sf_dir)
    runs = [rows.where(F.col("run_id") == run) for run in ("run-3", "run-1", "run-3", "run-2")]
    return slim(dedup.union_attempts(runs))


# Aggregates, reports ---------------------------------------------------------------------


def event_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.event_count(loaded(spark, sf_dir))


def max_event_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = loaded(spark, sf_dir)
    floor = reports.max_event_ms(rows).withColumn("mode", F.lit("floor"))
    return floor.unionByName(reports.max_event_ms(rows, "round").withColumn("mode", F.lit("round")))


def page_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.page_counters(control(spark, sf_dir))


def progress_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.progress(reports.event_count(loaded(spark, sf_dir)), START_MS, NOW_MS)


def session_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.session_rollup(loaded(spark, sf_dir))


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = envelope.headers(envelope.decode(landed(spark, sf_dir, "arrivals")))
    return reports.reconcile(pages, typed(spark, sf_dir), loaded(spark, sf_dir))


def page_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.page_check(control(spark, sf_dir))


def checkpoint_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A checkpoint log with one write per event; the state is the last write."""
    log = events(spark, sf_dir).select(
        F.lit(1).alias("id"),
        F.concat(F.lit("c-"), F.col("event_id").cast("string")).alias("cursor"),
        (F.col("event_id") + 1).alias("events_saved"),
        F.date_trunc("day", "at").alias("updated_at"),
        F.col("event_id").alias("version"),
    )
    return reports.latest_checkpoint(log).select("id", "cursor", "events_saved")


def checkpoint_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three writes to the checkpoint table, each with what was counted by then."""
    t = fresh_tables(spark)
    pages = landed(spark, sf_dir, "arrivals")
    for version, run in enumerate(("run-3", "run-2")):
        part = pages.where(F.col("run_id") == run)
        sinks.insert_if_absent(spark, normalize.loadable(load.typed_events(part, INGEST_TS)), t)
        counted = reports.event_count(spark.table(t.events))
        state = counted.select(F.lit(run).alias("cursor"), F.col("count").alias("events_saved"))
        sinks.save_checkpoint(spark, t, state, version)
    load.finish(spark, t, version=2)
    log = spark.table(t.checkpoints)
    states = [
        reports.latest_checkpoint(log.where(F.col("version") <= v)).withColumn("writes", F.lit(v + 1))
        for v in range(2)
    ]
    states.append(load.load_checkpoint(spark, t).withColumn("writes", F.lit(3)))
    both = states[0].unionByName(states[1]).unionByName(states[2])
    return both.select("writes", "id", "cursor", "events_saved")


# Windows ---------------------------------------------------------------------------------


def empty_page_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = pagectl.empty_page_stop(control(spark, sf_dir))
    return kept.select("run_id", "source", "seq", "page_no", "empty_streak")


def page_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages up to each run's stop, whichever rule ends it."""
    pages = control(spark, sf_dir)
    return pagectl.keep_until(pages, pagectl.stop_points(pages)).select("run_id", "source", "seq", "n_events")


def terminal_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagectl.terminal_cut(control(spark, sf_dir)).select("run_id", "source", "seq")


def stop_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagectl.stop_points(control(spark, sf_dir))


def checkpoint_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagectl.checkpoint_points(control(spark, sf_dir))


def target_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = loaded(spark, sf_dir).groupBy("run_id", "source", "seq").agg(F.count("*").alias("new_rows"))
    return pagectl.target_cut(new, COUNT_TARGET)


def late_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages are hours apart in this log, so the total is refreshed every six hours instead of ten seconds."""
    keys = ["run_id", "source", "seq"]
    new = loaded(spark, sf_dir).groupBy(*keys).agg(F.count("*").alias("new_rows"))
    asked = landed(spark, sf_dir, "arrivals").select(*keys, "requested_at")
    late = pagectl.late_target(new.join(asked, keys), COUNT_TARGET, every_seconds=LATE_SECONDS)
    return late.withColumn("span_ms", F.unix_millis("span_start")).drop("span_start")


def pacing_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = pagectl.pacing_audit(requests(spark, sf_dir))
    return audit.select(
        "run_id", "bucket", "seq", "gap_ms",
        F.round("min_interval_ms", 3).alias("min_interval_ms"), F.round("wait_ms", 3).alias("wait_ms"),
    )


# Sinks -----------------------------------------------------------------------------------


def export_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "ids")
    export.export_ids(loaded(spark, sf_dir), path)
    return spark.read.text(path).withColumnRenamed("value", "id")


def export_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COPY export of the events written and read back; the JSON columns by their names."""
    path = scratch_dir(spark, "copy")
    export.export_copy_text(loaded(spark, sf_dir), path)
    cells = F.split(F.col("value"), "\t")
    names = ["id", "session_id", "type", "user_id", "iso"]
    return spark.read.text(path).select(
        *[cells[i].alias(n) for i, n in enumerate(names)],
        (cells[5] == text.NULL_MARK).alias("no_properties"),
        F.get_json_object(cells[6], "$.name").alias("raw_name"),
    )


def layout_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "by-time")
    layout.write_by_time(loaded(spark, sf_dir), path)
    back = spark.read.parquet(path)
    return back.groupBy("event_date").agg(F.count("*").alias("events"), F.min("id").alias("first_id"))


def layout_by_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "by-session")
    layout.write_by_session(loaded(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("session_id").agg(F.count("*").alias("events"))


def compacted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends, compaction, and one more load that must still find every id."""
    t = fresh_tables(spark)
    rows = typed(spark, sf_dir)
    sinks.insert_if_absent(spark, rows.where(F.col("run_id") == "run-3"), t)
    sinks.insert_if_absent(spark, rows, t)
    layout.compact_events(spark, t)
    sinks.insert_if_absent(spark, rows, t)
    return slim(spark.table(t.events))


# Streaming and whole jobs ----------------------------------------------------------------


def _stream(spark: SparkSession, t: sinks.Tables, path: str, offsets: str) -> None:
    pages = page_log.stream_pages(spark, path, max_files=16)
    run_stream(spark, pages, t, offsets, INGEST_TS).awaitTermination()


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fresh_tables(spark)
    _stream(spark, t, land(spark, sf_dir, "arrivals"), f"{t.location}/offsets")
    spark.catalog.refreshTable(t.events)
    return slim(spark.table(t.events))


def stream_late_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late copies are in the table already; a stream with an id filter may only add what it lacks."""
    t = fresh_tables(spark)
    late = landed(spark, sf_dir, "arrivals").where(F.col("run_id") == "run-3")
    load.load_pages(spark, late, t, INGEST_TS)
    pages = page_log.stream_pages(spark, land(spark, sf_dir, "arrivals"), max_files=16)
    run_stream(spark, pages, t, f"{t.location}/offsets", LATER_TS, filter_from=1).awaitTermination()
    spark.catalog.refreshTable(t.events)
    saved = load.load_checkpoint(spark, t).select("events_saved").scalar()
    return slim(spark.table(t.events)).withColumn("events_saved", saved)


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run, run again on the same offsets, then replay everything on new ones."""
    t = fresh_tables(spark)
    path = land(spark, sf_dir, "arrivals")
    for offsets in ("offsets", "offsets", "replay"):
        _stream(spark, t, path, f"{t.location}/{offsets}")
    load.finish(spark, t, load.next_version(spark, t))
    spark.catalog.refreshTable(t.events)
    table = spark.table(t.events)
    state = load.load_checkpoint(spark, t)
    per_run = table.groupBy("run_id").agg(F.count("*").alias("events"))
    return per_run.withColumn("events_saved", state.select("events_saved").scalar())


def run_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job on the control log, whose runs go on after their last pages; exported ids."""
    t = fresh_tables(spark)
    out = f"{t.location}/ids"
    load.run_batch(spark, landed(spark, sf_dir, "control"), t, out, ingest_ts=INGEST_TS)
    return spark.read.text(out).withColumnRenamed("value", "id")


def run_job_stopped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with stop rules asked for: ids loaded, and the pages that were cut off."""
    t = fresh_tables(spark)
    load.load_pages(spark, landed(spark, sf_dir, "control"), t, INGEST_TS, apply_stop_rules=True)
    none = F.lit(None).cast("string")
    cut = spark.table(t.rejects).where(F.col("reason") == "after_stop")
    return spark.table(t.events).select("id", none.alias("run_id"), F.lit(None).cast("bigint").alias("seq")).unionByName(
        cut.select(none.alias("id"), "run_id", "seq")
    )


def load_clashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs whose ids do not sort as they started, and both sources with the same ids."""
    t = fresh_tables(spark)
    load.load_pages(spark, landed(spark, sf_dir, "clashing"), t, INGEST_TS)
    return spark.table(t.events).select("id", "type", "run_id", "source")


def short_circuit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job again once the target is met: nothing is loaded, the ids are exported."""
    t = fresh_tables(spark)
    rows = typed(spark, sf_dir)
    sinks.insert_if_absent(spark, rows.where(F.col("run_id") == "run-3"), t)
    out = f"{t.location}/ids"
    load.run_batch(spark, landed(spark, sf_dir, "arrivals"), t, out, 1, LATER_TS)
    return spark.read.text(out).withColumnRenamed("value", "id")


QUERIES: dict[str, Query] = {
    "scan_feed_pages": scan_source("feed"),
    "scan_events_pages": scan_source("events"),
    "stream_page_scan": stream_page_scan,
    "decode_envelope": decode_envelope,
    "flatten_pages": flatten_pages,
    "unnest_arrays": unnest_arrays,
    "time_range": time_range,
    "session_pages": session_pages,
    "session_rejects": session_rejects,
    "target_scan": target_scan,
    "checkpoint_lookup": checkpoint_lookup,
    "normalize_timestamp": normalize_timestamp,
    "project_events": project_events,
    "iso_time": iso_time,
    "mask_secret": mask_secret,
    "decode_cursor": decode_cursor,
    "path_buckets": path_buckets,
    "header_ints": header_ints,
    "backoff_schedule": backoff_schedule,
    "raw_json": raw_json,
    "copy_text": copy_text,
    "classify_responses": classify_responses,
    "page_flags": page_flags,
    "target_reached": target_reached,
    "key_check": key_check,
    "dedup_first_wins": dedup_first_wins,
    "insert_if_absent": insert_if_absent,
    "rows_per_batch": rows_per_batch,
    "insert_from_arrays": insert_from_arrays,
    "staging_load": staging_load,
    "rejects": rejects,
    "load_dirty": load_dirty,
    "page_chain": page_chain,
    "cursor_chain": cursor_chain,
    "backfill_union": backfill_union,
    "backfill_missing_times": backfill_missing_times,
    "load_clashing": load_clashing,
    "run_job_stopped": run_job_stopped,
    "replay_attempts": replay_attempts,
    "event_count": event_count,
    "max_event_ms": max_event_ms,
    "page_counters": page_counters,
    "progress_report": progress_report,
    "session_rollup": session_rollup,
    "reconcile": reconcile,
    "page_check": page_check,
    "checkpoint_latest": checkpoint_latest,
    "checkpoint_upsert": checkpoint_upsert,
    "empty_page_stop": empty_page_stop,
    "page_cut": page_cut,
    "terminal_cut": terminal_cut,
    "stop_points": stop_points,
    "checkpoint_points": checkpoint_points,
    "target_cut": target_cut,
    "late_target": late_target,
    "pacing_audit": pacing_audit,
    "export_ids": export_ids,
    "export_copy": export_copy,
    "layout_by_time": layout_by_time,
    "layout_by_session": layout_by_session,
    "compacted_table": compacted_table,
    "stream_ingest": stream_ingest,
    "stream_late_copies": stream_late_copies,
    "stream_resume": stream_resume,
    "run_job": run_job,
    "short_circuit": short_circuit,
}
