"""Tables, loads, layouts, exports, streams: SNK1-9, STR1-8, JOIN1, JOIN2, SRC7-10."""

import glob
import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from eventmill import schemas
from eventmill.operators.normalize import loadable
from eventmill.plans import load
from eventmill.sinks import export, layout
from eventmill.sinks import tables as sinks
from eventmill.sources import arrays, envelope, page_log
from eventmill.sources.tables import time_range
from eventmill.streaming.ingest import dedup_within, run_stream
from eventmill.streaming.progress import ProgressLog
from tests.conftest import body, event, page
from tests.conftest import page_log as log

STAMP = datetime(2024, 3, 1, tzinfo=timezone.utc)


def pages(spark, *batches, run="r1", source="feed", first=0, **more):
    return log(spark, [page(first + i, body([event(e, type=run) for e in ids], **more), run, source) for i, ids in enumerate(batches)])


def ids(spark, t):
    spark.catalog.refreshTable(t.events)
    return sorted(r["id"] for r in spark.table(t.events).select("id").collect())


def names(*numbers):
    return sorted(f"evt-{n}" for n in numbers)


def rejects(spark, t):
    spark.catalog.refreshTable(t.rejects)
    return sorted((r["reason"], r["seq"], r["pos"]) for r in spark.table(t.rejects).collect())


def test_create_is_idempotent(spark, tables):
    load.load_pages(spark, pages(spark, [1, 2]), tables, STAMP)
    again = sinks.create_tables(spark, tables.database, tables.location, buckets=4)
    assert again == tables and ids(spark, tables) == names(1, 2)
    assert spark.table(tables.events).columns == schemas.EVENT_COLUMNS


def test_insert_if_absent_counts_new_rows_only(spark, tables):
    assert load.load_pages(spark, pages(spark, [1, 2, 2], [2, 3]), tables, STAMP).inserted == 3
    assert load.load_pages(spark, pages(spark, [3, 4], run="r2"), tables, STAMP).inserted == 1
    assert load.load_pages(spark, pages(spark, [1, 2, 3, 4], run="r3"), tables, STAMP).inserted == 0
    assert load.load_pages(spark, pages(spark, []), tables, STAMP).inserted == 0
    types = {r["id"]: r["type"] for r in spark.table(tables.events).collect()}
    assert types == {"evt-1": "r1", "evt-2": "r1", "evt-3": "r1", "evt-4": "r2"}


def test_narrowing_by_id_changes_nothing(spark, tables):
    load.load_pages(spark, pages(spark, [1, 5, 9]), tables, STAMP)
    done = load.load_pages(spark, pages(spark, [4, 5, 6], run="r2"), tables, STAMP, narrow_by_id=True)
    assert done.inserted == 2 and ids(spark, tables) == names(1, 4, 5, 6, 9)
    assert load.load_pages(spark, pages(spark, []), tables, STAMP, narrow_by_id=True).inserted == 0


def test_both_load_paths_give_one_table(spark, tables, tmp_path):
    other = sinks.create_tables(spark, tables.database + "_b", str(tmp_path / "b"), buckets=4)
    log_ = pages(spark, [1, 2], [2, 3])
    load.load_pages(spark, log_, tables, STAMP)
    rows = loadable(load.typed_events(log_, STAMP))
    keys = ["source", "run_id", "seq"]
    columns = [c for c in schemas.EVENT_COLUMNS if c not in keys]
    packed = rows.groupBy(*keys).agg(F.collect_list(F.struct(*columns)).alias("a"))
    wide = packed.select(*keys, *[F.col(f"a.{c}").alias(c) for c in columns])
    sinks.insert_if_absent(spark, arrays.unnest(wide, columns, keys).select(*schemas.EVENT_COLUMNS), other)

    def content(t):
        df = spark.table(t.events).withColumns({"raw": F.to_json("raw"), "properties": F.to_json("properties")})
        return sorted(tuple(str(v) for v in r) for r in df.collect())

    assert content(tables) == content(other) and len(content(tables)) == 3


def test_known_ids_are_found_without_moving_the_table(spark, tables):
    rows = loadable(load.typed_events(pages(spark, [1, 2]), STAMP))
    sinks.insert_if_absent(spark, rows, tables)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sinks.new_rows(spark, rows, tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1
    assert "SelectedBucketsCount: 4 out of 4" in plan
    assert "ReadSchema: struct<id:string>" in plan


def test_reports_read_only_their_columns(spark, tables):
    from eventmill.operators import reports

    load.load_pages(spark, pages(spark, [1, 2]), tables, STAMP)
    events = spark.table(tables.events)
    for df, read in (
        (reports.event_count(events), "struct<>"),
        (reports.max_event_ms(events), "struct<timestamp:timestamp,ts_defaulted:boolean>"),
        (events.select("id").orderBy("id"), "struct<id:string>"),
    ):
        assert f"ReadSchema: {read}" in df._jdf.queryExecution().executedPlan().toString()


def test_rejects_once_and_the_rest_is_loaded(spark, tables):
    rows = [
        page(0, json.dumps({"data": [event(1), {"x": 1}, event(2, timestamp=1e300), event(3, userId={})]})),
        page(1, '{"data":[{"id":"evt-9"}'),
        page(2, body([event(4)])),
    ]
    expected = [("bad_json", 1, None), ("bad_type", 0, 3), ("no_id", 0, 1), ("ts_range", 0, 2)]
    done = load.load_pages(spark, log(spark, rows), tables, STAMP)
    assert (done.inserted, done.rejected) == (2, 4)
    assert rejects(spark, tables) == expected and ids(spark, tables) == names(1, 4)
    again = load.load_pages(spark, log(spark, rows), tables, STAMP)
    assert (again.inserted, again.rejected) == (0, 0) and rejects(spark, tables) == expected


def test_only_bad_bodies(spark, tables):
    done = load.load_pages(spark, log(spark, [page(0, "oops"), page(1, body([event(1)]))]), tables, STAMP)
    assert (done.inserted, done.rejected) == (1, 1)


def test_torn_lines_are_rejected_by_name(spark, tables, tmp_path):
    path = tmp_path / "log"
    pages(spark, [1]).coalesce(1).write.json(str(path))
    (path / "torn.json").write_text('{"run_id":"r1","source":"feed","se\n{"broken"\n')
    done = load.load_pages(spark, page_log.read_pages(spark, str(path)), tables, STAMP)
    assert (done.inserted, done.rejected) == (1, 2)
    assert [r[0] for r in rejects(spark, tables)] == ["bad_line", "bad_line"]


def test_stop_rules_in_a_load(spark, tables):
    log_ = pages(spark, [1], *[[]] * 10, [2])
    done = load.load_pages(spark, log_, tables, STAMP, apply_stop_rules=True)
    assert (done.inserted, done.rejected) == (1, 1)
    assert rejects(spark, tables) == [("after_stop", 11, None)]
    assert load.load_pages(spark, log_, tables, STAMP).inserted == 1
    assert ids(spark, tables) == names(1, 2)


def test_stop_rules_do_not_shuffle_the_bodies(spark, tables):
    from eventmill.operators.pagectl import keep_until, stop_points

    staged, _ = load.stage_pages(spark, pages(spark, [1], [2]), tables, F.lit(STAMP))
    stops = sinks.overwrite_stage(stop_points(envelope.headers(staged)), f"{tables.stage}/stops")
    plan = keep_until(staged, stops)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_checkpoints(spark, tables):
    assert load.load_checkpoint(spark, tables).first() is None
    for version, cursor in enumerate(["a", "b"]):
        state = spark.createDataFrame([(cursor, version)], "cursor string, events_saved long")
        sinks.save_checkpoint(spark, tables, state, version)
    row = load.load_checkpoint(spark, tables).first()
    assert (row["id"], row["cursor"], row["events_saved"]) == (1, "b", 1)
    load.finish(spark, tables, load.next_version(spark, tables))
    row = load.load_checkpoint(spark, tables).first()
    assert (row["cursor"], row["events_saved"]) == (None, 0)


def read_lines(path):
    return [line for f in sorted(glob.glob(f"{path}/part-*")) for line in open(f).read().splitlines()]


def test_run_batch_then_skip(spark, tables, tmp_path):
    out = str(tmp_path / "ids")
    feed, fallback = pages(spark, [1, 2], [3]), pages(spark, [3, 4], [5], source="events")
    both = feed.unionByName(fallback)
    assert load.run_batch(spark, both, tables, out, target=100, ingest_ts=STAMP).inserted == 5
    assert read_lines(out) == names(1, 2, 3, 4, 5)
    assert load.load_checkpoint(spark, tables).first()["events_saved"] == 5
    more = both.unionByName(pages(spark, [6], first=9))
    done = load.run_batch(spark, more, tables, out, target=5, ingest_ts=STAMP)
    assert (done.inserted, done.skipped) == (0, 5)
    assert len(read_lines(out)) == 5
    assert load.run_batch(spark, more, tables, out, ingest_ts=STAMP).inserted == 1


def test_batch_loads_what_was_landed_after_a_last_page(spark, tables, tmp_path):
    log_ = log(spark, [page(0, body([event(1)], has_more=False)), page(1, body([event(2)]))])
    assert load.run_batch(spark, log_, tables, str(tmp_path / "ids"), ingest_ts=STAMP).inserted == 2


def test_equal_torn_lines_of_two_files_are_two(spark, tables, tmp_path):
    for i in range(2):
        path = tmp_path / f"log{i}"
        path.mkdir()
        (path / "torn.json").write_text('{"broken"\n')
        for expected in (1, 0):
            assert load.load_pages(spark, page_log.read_pages(spark, str(path)), tables, STAMP).rejected == expected


def test_fallback_is_left_out_when_the_feed_suffices(spark, tables, tmp_path):
    both = pages(spark, [1, 2]).unionByName(pages(spark, [3], source="events"))
    assert load.run_batch(spark, both, tables, str(tmp_path / "ids"), target=2, ingest_ts=STAMP) == load.LoadResult(2, 0, 1)
    assert ids(spark, tables) == names(1, 2)


def test_one_stamp_per_load(spark, tables):
    load.load_pages(spark, pages(spark, list(range(50)), list(range(50, 90))).repartition(4), tables)
    assert spark.table(tables.events).select("ingested_at").distinct().count() == 1


def test_compaction(spark, tables):
    for run in range(3):
        load.load_pages(spark, pages(spark, list(range(run * 20, run * 20 + 30)), run=f"r{run}"), tables, STAMP)
    before = ids(spark, tables)
    location = layout.compact_events(spark, tables)
    assert ids(spark, tables) == before == names(*range(70))
    assert len(glob.glob(f"{location}/*.parquet")) == 4
    assert load.load_pages(spark, pages(spark, [69, 70], run="r9"), tables, STAMP).inserted == 1
    assert len(ids(spark, tables)) == 71
    # A catalog that has forgotten the tables finds the compacted files again.
    for table in (tables.events, tables.checkpoints, tables.rejects, tables.layouts):
        spark.sql(f"DROP TABLE {table}")
    sinks.create_tables(spark, tables.database, tables.location, buckets=4)
    assert len(ids(spark, tables)) == 71


def test_time_layout_is_pruned(spark, tmp_path):
    times = [1706745600000, 1706832000000, 1706918400000]
    events = [event(i, timestamp=times[i % 3]) for i in range(30)]
    rows = loadable(load.typed_events(log(spark, [page(0, json.dumps({"data": events}))]), STAMP))
    layout.write_by_time(rows, str(tmp_path / "t"), 4)
    df = time_range(spark.read.parquet(str(tmp_path / "t")), times[1], times[2])
    assert df.count() == 10
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "GreaterThanOrEqual(timestamp" in plan


def test_one_instant_is_spread_over_tasks(spark, tmp_path):
    rows = loadable(load.typed_events(pages(spark, list(range(4000))), STAMP))
    layout.write_by_time(rows, str(tmp_path / "t"), 4)
    files = glob.glob(f"{tmp_path}/t/*/*.parquet")
    assert len(files) == 4
    layout.write_by_session(rows, str(tmp_path / "s"), 4)
    assert len(glob.glob(f"{tmp_path}/s/*.parquet")) == 4
    assert spark.read.parquet(str(tmp_path / "s")).count() == 4000


def test_export_is_in_binary_order(spark, tmp_path):
    values = ["b", "a", "B", "é", "a1", "", "10", "9"] + [f"x{i:05d}" for i in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "id string").repartition(7)
    assert export.export_ids(df, str(tmp_path / "ids"), max_records_per_file=500) == len(values)
    assert read_lines(tmp_path / "ids") == sorted(values, key=lambda v: v.encode())


def test_copy_text(spark, tmp_path):
    text = json.dumps({"data": [event(1, sessionId=None, userId="a\tb\\", name="x\ny", properties={"k": "\t"})]})
    rows = loadable(load.typed_events(log(spark, [page(0, text)]), STAMP))
    export.export_copy_text(rows, str(tmp_path / "copy"))
    (line,) = read_lines(tmp_path / "copy")
    cells = line.split("\t")
    assert cells[:5] == ["evt-1", "\\N", "click", "a\\tb\\\\", "2024-02-01T00:00:00.000Z"]
    # JSON escapes the control characters itself; COPY doubles the backslash.
    assert cells[5] == '{"k":"\\\\t"}' and len(cells) == 7
    assert json.loads(cells[6].replace("\\\\", "\\"))["name"] == "x\ny"


def test_staging_is_replaced(spark, tmp_path):
    path = str(tmp_path / "stage")
    sinks.overwrite_stage(spark.range(5), path)
    assert sinks.overwrite_stage(spark.range(3), path).count() == 3


# Streaming --------------------------------------------------------------------------------


def land(df, path):
    df.coalesce(1).write.mode("append").json(path)


def stream(spark, tables, path, offsets, **options):
    query = run_stream(spark, page_log.stream_pages(spark, path, **options), tables, f"{tables.location}/{offsets}", STAMP)
    query.awaitTermination()
    return query


@pytest.mark.parametrize("max_files", [1, 100])
def test_stream_gives_the_batch_result(spark, tables, tmp_path, max_files):
    path = str(tmp_path / "log")
    land(pages(spark, [1, 2], run="r1"), path)
    land(pages(spark, [2, 3], run="r2"), path)
    land(pages(spark, [3, 1, 4], run="r3"), path)
    stream(spark, tables, path, "offsets", max_files=max_files)
    got = {r["id"]: r["type"] for r in spark.table(tables.events).collect()}
    assert got == {"evt-1": "r1", "evt-2": "r1", "evt-3": "r2", "evt-4": "r3"}
    row = load.load_checkpoint(spark, tables).first()
    assert (row["cursor"], row["events_saved"]) == ("cursor-next", 4)


def test_stream_resumes_and_replays_harmlessly(spark, tables, tmp_path):
    path = str(tmp_path / "log")
    land(pages(spark, [1, 2]), path)
    stream(spark, tables, path, "offsets")
    stream(spark, tables, path, "offsets")
    assert ids(spark, tables) == names(1, 2)
    land(pages(spark, [2, 3], first=5), path)
    query = stream(spark, tables, path, "offsets")
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1
    stream(spark, tables, path, "fresh")
    assert ids(spark, tables) == names(1, 2, 3)


def test_cursor_expiry_rescan_overlaps(spark, tables, tmp_path):
    """Page, expired cursor, rescan from the start: every event once."""
    path = str(tmp_path / "log")
    rows = [
        page(0, body([event(i) for i in range(100)])),
        page(1, '{"code":"CURSOR_EXPIRED"}', status=400, cursor="cursor-next"),
        page(2, body([event(i) for i in range(100)])),
        page(3, body([event(i) for i in range(100, 200)], has_more=False, next_cursor=None), cursor="cursor-next"),
    ]
    for row in rows:
        land(log(spark, [row]), path)
    stream(spark, tables, path, "offsets", max_files=1)
    assert ids(spark, tables) == names(*range(200))
    assert {r["seq"] for r in spark.table(tables.events).collect()} == {0, 3}


def test_crash_between_append_and_commit(spark, tables, tmp_path):
    """The batch is in the table but not committed: the replay adds nothing."""
    path = str(tmp_path / "log")
    land(pages(spark, [1, 2], [3]), path)
    load.load_pages(spark, page_log.read_pages(spark, path), tables, STAMP)
    stream(spark, tables, path, "offsets")
    assert ids(spark, tables) == names(1, 2, 3)


def test_half_written_batch_is_completed(spark, tables, tmp_path):
    path = str(tmp_path / "log")
    land(pages(spark, [1, 2], [3]), path)
    part = loadable(load.typed_events(page_log.read_pages(spark, path), STAMP)).where("id = 'evt-2'")
    sinks.insert_if_absent(spark, part, tables)
    stream(spark, tables, path, "offsets")
    assert ids(spark, tables) == names(1, 2, 3)


def test_progress_listener(spark, tables, tmp_path):
    path = str(tmp_path / "log")
    land(pages(spark, [1], [2]), path)
    listener = ProgressLog()
    spark.streams.addListener(listener)
    try:
        stream(spark, tables, path, "offsets")
        for _ in range(50):
            if listener.reports:
                break
            import time

            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert sum(r["pages"] for r in listener.reports) == 2


def test_bounded_dedup(spark, tmp_path):
    path = str(tmp_path / "events")
    rows = loadable(load.typed_events(pages(spark, [1, 2, 2]), STAMP)).select("id", "timestamp")
    rows.write.parquet(path)
    streamed = spark.readStream.schema(rows.schema).parquet(path)
    query = dedup_within(streamed, "1 hour").writeStream.format("memory").queryName("bounded").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r["id"] for r in spark.table("bounded").collect()) == names(1, 2)


def test_jobs(spark, tmp_path, capsys):
    from eventmill.__main__ import parse, run

    path = str(tmp_path / "log")
    land(pages(spark, [1, 2]), path)
    common = ["--database", "jobs_test", "--location", str(tmp_path / "t"), "--buckets", "4", "--pages", path]
    run(spark, parse(["batch", *common, "--export", str(tmp_path / "ids")]))
    assert read_lines(tmp_path / "ids") == names(1, 2)
    land(pages(spark, [2, 3], first=5), path)
    run(spark, parse(["stream", *common, "--max-files", "1"]))
    run(spark, parse(["layout", *common]))
    run(spark, parse(["layout", *common, "--by", "time", "--out", str(tmp_path / "by")]))
    run(spark, parse(["report", *common, "--target", "6"]))
    assert spark.read.parquet(str(tmp_path / "by")).count() == 3
    out = capsys.readouterr().out
    assert "inserted 2, rejected 0" in out and "3 / 6 (50.0%)" in out
    with pytest.raises(SystemExit):
        parse(["batch", "--database", "d", "--location", "l"])


def test_stream_at_an_interval(spark, tables, tmp_path):
    path = str(tmp_path / "log")
    land(pages(spark, [1]), path)
    stream_ = page_log.stream_pages(spark, path)
    query = run_stream(spark, stream_, tables, f"{tables.location}/offsets", STAMP, every="1 second")
    try:
        query.processAllAvailable()
        land(pages(spark, [2], first=1), path)
        query.processAllAvailable()
    finally:
        query.stop()
    assert ids(spark, tables) == names(1, 2)


def test_a_load_unpacks_few_staged_pages_in_a_task(spark, tables, monkeypatch):
    """Rows of a whole split are sorted at once, so its size bounds the memory of a task, whatever the input."""
    tasks, insert, key = [], load.insert_if_absent, "spark.sql.files.maxPartitionBytes"

    def counting(session, events, *args, **more):
        tasks.append(events.rdd.getNumPartitions())
        return insert(session, events, *args, **more)

    monkeypatch.setattr(load, "insert_if_absent", counting)
    before = spark.conf.get(key)
    many = pages(spark, *[[k, k + 100] for k in range(96)]).repartition(24)
    assert load.load_pages(spark, many, tables, STAMP).inserted == 192
    monkeypatch.setattr(load, "SPLIT", "1m")
    assert load.load_pages(spark, many.withColumn("run_id", F.lit("r2")), tables, STAMP).inserted == 0
    assert tasks[1] == 24 > tasks[0]
    assert spark.conf.get(key) == before
    assert ids(spark, tables) == names(*range(96), *range(100, 196))
