"""Page logs derived from the given ``events`` table, landed as JSON lines.

Every event becomes raw JSON with a timestamp in one of six forms, is packed into pages of 100,
and the pages are written as the fetching job would land them.  The logs:

``arrivals``  three attempts, one after the other: early copies of the ``view`` events (type
              ``early``), all events, late copies of the ``click`` events (type ``late``).
``control``   three runs with empty pages, chain breaks, differing envelopes and terminal pages.
``sources``   feed and events source: the feed misses everything from ``FEED_END`` on.
``timeless``  the same, with a third of the events without a time.
``clashing``  ``run-10`` started a year after ``run-2``; the fallback's pages come first by number.
``dirty``     events and pages that cannot be loaded among those that can.
``shuffled``  pages out of order, with forks, loops, orphans and restarts among their cursors.
``requests``  one request per event, with every kind of response.
``sessions``  pages of session records.
``odd_sessions``  session pages with torn bodies and records that are no sessions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill import schemas
from eventmill.session import configure, scratch_dir
from eventmill.sources.page_log import read_pages

PAGE = 100
SEGMENT = 1_000_000_000
FEED_END = "2024-01-16"

_landed: dict[tuple[str, str, str], str] = {}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("at", F.col("ts").cast("timestamp"))


def _timestamp_json() -> Column:
    form = F.col("event_id") % 6
    ms = F.unix_millis("at")
    return (
        F.when(form == 0, ms.cast("string"))
        .when(form == 1, F.floor(ms / 1000).cast("string"))
        .when(form == 2, F.date_format("at", "'\"'yyyy-MM-dd'T'HH:mm:ss.SSS'Z\"'"))
        .when(form == 3, F.date_format("at", "'\"'yyyy-MM-dd'T'HH:mm:ss'\"'"))
        .when(form == 4, "null")
        .otherwise('"not-a-date"')
    )


def raw_json(type_: Column, id_member: Column | None = None, ts: Column | None = None,
             session: Column | None = None) -> Column:
    """One raw event as JSON text."""
    quoted = F.concat(F.lit('"id":"evt-'), F.col("event_id").cast("string"), F.lit('"'))
    day = F.date_format("at", "yyyy-MM-dd")
    session_id = F.concat(
        F.lit('"s-'), F.col("user_id").cast("string"), F.lit("-"), day, F.lit('"')
    )
    return F.concat(
        F.lit("{"), quoted if id_member is None else id_member,
        F.lit(',"sessionId":'), session_id if session is None else session,
        F.lit(',"type":"'), type_, F.lit('"'),
        F.lit(',"userId":'), F.col("user_id").cast("string"),
        F.lit(',"name":"n","properties":'),
        F.when(F.col("event_id") % 9 == 0, "0").when(F.col("event_id") % 9 == 1, '""')
        .when(F.col("event_id") % 9 == 2, "{}").otherwise(F.col("props")),
        F.lit(',"timestamp":'), _timestamp_json() if ts is None else ts,
        F.lit("}"),
    )


def cursor(seq: Column) -> Column:
    """Cursor that leads to the page after ``seq``."""
    n = seq.cast("string")
    text = F.concat(
        F.lit('{"id":"p-'), n, F.lit('","ts":'), (seq * 1000).cast("string"), F.lit(',"v":1,"exp":'),
        (F.lit(1704067200000) + seq * 60000).cast("string"), F.lit("}"),
    )
    # base64() breaks its output into lines, which a JSON string cannot hold.
    return F.regexp_replace(F.base64(F.encode(text, "utf-8")), r"\s", "")


def _pages(rows: DataFrame) -> DataFrame:
    """``event_id, json`` rows to one row per page: ``p, n, data`` (a JSON array, in id order)."""
    packed = rows.groupBy(F.floor(F.col("event_id") / PAGE).alias("p")).agg(
        F.array_sort(F.collect_list(F.struct("event_id", "json"))).alias("a"),
        F.max("at").alias("requested_at"),
    )
    text = F.concat(F.lit("["), F.array_join(F.col("a.json"), ","), F.lit("]"))
    return packed.select("p", "requested_at", F.size("a").alias("n"), text.alias("data"))


def _nested(data: Column, n: Column, has_more: Column, next_cursor: Column) -> Column:
    return F.concat(
        F.lit('{"data":'), data, F.lit(',"pagination":{"limit":100,"hasMore":'),
        has_more.cast("string"), F.lit(',"nextCursor":"'), next_cursor,
        F.lit('","cursorExpiresIn":120},"meta":{"total":3000000,"returned":'), n.cast("string"),
        F.lit(',"requestId":"req"}}'),
    )


def _log(pages: DataFrame, **columns: Column) -> DataFrame:
    """Fills in the page-log columns that ``columns`` does not name."""
    base = {
        "path": F.lit("/api/v1/events"),
        "request_cursor": F.lit(None).cast("string"),
        "request_limit": F.lit(100).cast("bigint"),
        "requested_at": F.col("requested_at"),
        "status": F.lit(200),
        "headers": F.create_map(F.lit("content-type"), F.lit("application/json")),
    }
    base.update(columns)
    names = schemas.column_names(schemas.PAGE_LOG)
    return pages.select(*[base[c].alias(c) for c in names])


def _arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    ev = events(spark, sf_dir)
    segments = [
        ("run-1", ev.where(F.col("event_type") == "view"), F.lit("early")),
        ("run-2", ev, F.col("event_type")),
        ("run-3", ev.where(F.col("event_type") == "click"), F.lit("late")),
    ]
    logs = []
    for i, (run, rows, type_) in enumerate(segments):
        pages = _pages(rows.withColumn("json", raw_json(type_)))
        pages = pages.withColumn("requested_at", F.col("requested_at") + F.expr(f"INTERVAL {i * 366} DAY"))
        seq = F.col("p") + F.lit(i * SEGMENT)
        body = _nested(F.col("data"), F.col("n"), F.lit(True), cursor(seq))
        logs.append(_log(pages, run_id=F.lit(run), source=F.lit("feed"), seq=seq, body=body))
    return logs


def _control(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    pages = _pages(events(spark, sf_dir).withColumn("json", raw_json(F.col("event_type"))))
    p = F.col("p")
    extra = F.when(p % 40 == 30, 11).when(p % 8 == 3, 4).otherwise(0)
    slots = pages.withColumn("slot", F.explode(F.sequence(F.lit(0), extra)))
    slots = slots.withColumns(
        {
            "seq": p * 16 + F.col("slot"),
            "n": F.when(F.col("slot") == 0, F.col("n")).otherwise(0),
            "data": F.when(F.col("slot") == 0, F.col("data")).otherwise("[]"),
        }
    )
    seq, n, data = F.col("seq"), F.col("n"), F.col("data")
    has_more = p % 64 != 61
    next_cursor = F.concat(F.lit("c-"), seq.cast("string"))
    flat = F.concat(
        F.lit('{"data":'), data, F.lit(',"hasMore":'), has_more.cast("string"),
        F.lit(',"nextCursor":"'), next_cursor, F.lit('"}'),
    )
    bare = F.concat(
        F.lit('{"data":'), data, F.lit(',"pagination":{"hasMore":'), has_more.cast("string"),
        F.lit(',"nextCursor":"'), next_cursor, F.lit('"},"meta":{"total":7}}'),
    )
    body = F.when(p % 4 == 0, flat).when(p % 4 == 1, bare).otherwise(
        _nested(data, n, has_more, next_cursor)
    )
    # The cursor of the run's page before: slots follow each other, pages of a run are 3 apart.
    before = F.when(F.col("slot") > 0, seq - 1).otherwise(
        (p - 3) * 16 + F.when((p - 3) % 40 == 30, 11).when((p - 3) % 8 == 3, 4).otherwise(0)
    )
    asked = (
        F.when((p < 3) & (F.col("slot") == 0), None)
        .when(p % 10 == 7, None)
        .when(p % 10 == 4, F.concat(F.lit("x-"), seq.cast("string")))
        .otherwise(F.concat(F.lit("c-"), before.cast("string")))
    )
    run = (p % 3).cast("string")
    return [
        _log(
            slots,
            run_id=F.concat(F.lit("run-"), run),
            source=F.when(p % 3 == 2, "events").otherwise("feed"),
            seq=seq,
            request_cursor=asked,
            request_limit=F.when(p % 2 == 0, F.lit(50).cast("bigint")),
            body=body,
        )
    ]


def _sources(spark: SparkSession, sf_dir: str, ts: Column | None = None) -> list[DataFrame]:
    ev = events(spark, sf_dir)
    parts = [
        ("feed", ev.where(F.col("ts") < F.lit(FEED_END).cast("timestamp_ntz")), F.col("event_type")),
        ("events", ev, F.lit("fallback")),
    ]
    logs = []
    for source, rows, type_ in parts:
        ms = F.unix_millis("at").cast("string") if ts is None else ts
        pages = _pages(rows.withColumn("json", raw_json(type_, ts=ms)))
        body = _nested(F.col("data"), F.col("n"), F.lit(True), cursor(F.col("p")))
        logs.append(_log(pages, run_id=F.lit("run-1"), source=F.lit(source), seq=F.col("p"), body=body))
    return logs


def _timeless(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return _sources(spark, sf_dir, _timestamp_json())


def _clashing(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    ev = events(spark, sf_dir)
    parts = [
        ("run-10", "feed", 0, 366, ev),
        ("run-2", "feed", SEGMENT, 0, ev.where(F.col("event_type") == "view")),
        ("run-2", "events", 0, 0, ev.where(F.col("event_type").isin("view", "click"))),
    ]
    logs = []
    for run, source, first, days, rows in parts:
        pages = _pages(rows.withColumn("json", raw_json(F.lit(f"{run}-{source}"))))
        later = pages.withColumn("requested_at", F.col("requested_at") + F.expr(f"INTERVAL {days} DAY"))
        seq = F.col("p") + F.lit(first)
        body = _nested(F.col("data"), F.col("n"), F.lit(True), cursor(seq))
        logs.append(_log(later, run_id=F.lit(run), source=F.lit(source), seq=seq, body=body))
    return logs


def _dirty(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    kind = F.col("event_id") % 11
    eid = F.col("event_id").cast("string")
    id_member = (
        F.when(kind == 0, '"no":1')
        .when(kind == 1, '"id":null')
        .when(kind == 2, '"id":{"a":1}')
        .when(kind == 5, F.concat(F.lit('"id":'), eid))
        .otherwise(F.concat(F.lit('"id":"evt-'), eid, F.lit('"')))
    )
    ts = F.when(kind == 3, "1e300").otherwise(F.unix_millis("at").cast("string"))
    session = F.when(kind == 4, "[1]").otherwise('"s"')
    json = raw_json(F.col("event_type"), id_member, ts, session)
    pages = _pages(events(spark, sf_dir).withColumn("json", json))
    p = F.col("p")
    good = F.concat(F.lit('{"data":'), F.col("data"), F.lit("}"))
    body = (
        F.when(p % 13 == 5, F.concat(F.lit('{"data":'), F.col("data")))
        .when(p % 13 == 6, '{"data":{"id":"evt-1"}}')
        .otherwise(good)
    )
    return [_log(pages, run_id=F.lit("run-1"), source=F.lit("feed"), seq=p, body=body)]


def _shuffled(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Pages numbered out of order; only cursors tell which follows which.

    A run's pages come in chains of eight.  Some chains begin with the cursor that they end with, some
    ask with a cursor that nobody handed out, some begin anew in the middle, and some requests are
    made twice.
    """
    pages = _pages(events(spark, sf_dir).withColumn("json", raw_json(F.col("event_type"))))
    p, copy = F.col("p"), F.col("copy")
    j = F.floor(p / 3)
    block, k = F.floor(j / 8), j % 8
    slots = pages.withColumn("copy", F.explode(F.sequence(F.lit(0), F.when(j % 6 == 2, 1).otherwise(0))))

    def name(mark: str, number: Column) -> Column:
        return F.concat(F.lit(f"{mark}-"), number.cast("string"))

    asked = (
        F.when((k == 0) & (block % 5 == 3), name("c", j + 7))
        .when(k == 0, None)
        .when((k == 5) & (block % 5 == 1), name("x", j))
        .when((k == 6) & (block % 5 == 2), None)
        .otherwise(name("c", j - 1))
    )
    handed = F.when(copy == 0, name("c", j)).otherwise(name("r", j))
    return [
        _log(
            slots,
            run_id=F.concat(F.lit("run-"), (p % 3).cast("string")),
            source=F.lit("feed"),
            seq=(p * 7919) % 1_000_003 * 2 + copy,
            request_cursor=asked,
            body=_nested(F.col("data"), F.col("n"), F.lit(True), handed),
        )
    ]


def _requests(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    ev = events(spark, sf_dir).withColumnRenamed("at", "requested_at")
    n = F.col("event_id")
    status = F.element_at(
        F.array(*[F.lit(s) for s in (200, 200, 400, 400, 401, 403, 403, 403, 429, 429, 500, 204)]),
        (n % 12 + 1).cast("int"),
    )
    body = F.element_at(
        F.array(*[F.lit(b) for b in (
            "{}", "{}", '{"code":"CURSOR_EXPIRED"}', '{"message":"bad limit"}', "{}",
            '{"message":"token expired"}', '{"code":"INVALID_STREAM_TOKEN"}', '{"message":"no"}',
            "{}", "{}", "{}", "",
        )]),
        (n % 12 + 1).cast("int"),
    )
    headers = F.when(
        n % 12 == 8, F.create_map(F.lit("Retry-After"), (n % 50).cast("string"))
    ).when(
        n % 12 == 9, F.create_map(F.lit("x-ratelimit-reset"), F.lit("17;w=60"))
    ).otherwise(
        F.create_map(
            F.lit("X-RateLimit-Limit"), F.when(n % 5 == 0, "abc").otherwise(F.lit("10;w=60")),
            F.lit("X-RateLimit-Remaining"), (n % 10).cast("string"),
            F.lit("X-RateLimit-Reset"), F.concat(F.lit(" "), (n % 600 + 1).cast("string")),
        )
    )
    uuid = F.concat(F.lit("0123abcd-0000-0000-0000-"), F.lpad(n.cast("string"), 12, "0"))
    path = F.when(n % 4 < 2, "/api/v1/events").when(
        n % 4 == 2, F.concat(F.lit("/api/v1/sessions/"), uuid)
    ).otherwise(F.concat(F.lit("/api/v1/users/"), uuid, F.lit("/events/"), uuid))
    return [
        _log(
            ev, run_id=F.concat(F.lit("run-"), (F.col("user_id") % 2).cast("string")),
            source=F.when(n % 7 < 2, "feed").otherwise("events"), seq=n,
            path=path, status=status, headers=headers, body=body,
        )
    ]


def _sessions(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    day = F.date_format("at", "yyyy-MM-dd")
    sessions = (
        events(spark, sf_dir)
        .groupBy("user_id", day.alias("day"))
        .agg(F.count("*").alias("n"), F.min("event_id").alias("event_id"), F.max("at").alias("at"))
    )
    user = F.col("user_id").cast("string")
    json = F.concat(
        F.lit('{"id":"s-'), user, F.lit("-"), F.col("day"), F.lit('","userId":"'), user,
        F.lit('","eventCount":'), F.col("n").cast("string"), F.lit("}"),
    )
    pages = _pages(sessions.withColumn("json", json))
    body = F.concat(F.lit('{"data":'), F.col("data"), F.lit("}"))
    return [
        _log(pages, run_id=F.lit("run-1"), source=F.lit("events"), seq=F.col("p"),
             path=F.lit("/api/v1/sessions"), body=body)
    ]


def _odd_sessions(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """A page per event: two sessions, or a torn body, odd records, or no array."""
    eid = F.col("event_id").cast("string")
    good = F.concat(F.lit('{"id":"s-'), eid, F.lit('","eventCount":1}'))
    kind = F.col("event_id") % 10
    body = (
        F.when(kind == 1, F.concat(F.lit('{"data":['), good))
        .when(kind == 2, F.concat(F.lit('{"data":['), good, F.lit(',{"userId":"u"}]}')))
        .when(kind == 3, F.concat(F.lit('{"data":['), eid, F.lit(","), good, F.lit("]}")))
        .when(kind == 4, F.concat(F.lit("nonsense "), eid))
        .when(kind == 5, F.concat(F.lit('{"data":'), good, F.lit("}")))
        .otherwise(F.concat(F.lit('{"data":['), good, F.lit(","), good, F.lit("]}")))
    )
    ev = events(spark, sf_dir).withColumnRenamed("at", "requested_at")
    return [
        _log(ev, run_id=F.lit("run-1"), source=F.lit("events"), seq=F.col("event_id"),
             path=F.lit("/api/v1/sessions"), body=body)
    ]


_LOGS = {
    "arrivals": _arrivals,
    "control": _control,
    "sources": _sources,
    "timeless": _timeless,
    "clashing": _clashing,
    "dirty": _dirty,
    "shuffled": _shuffled,
    "requests": _requests,
    "sessions": _sessions,
    "odd_sessions": _odd_sessions,
}


def land(spark: SparkSession, sf_dir: str, log: str) -> str:
    """Folder of a landed log; written once per session and table folder."""
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir, log)
    if key not in _landed:
        path = scratch_dir(spark, f"landed-{log}")
        for part in _LOGS[log](spark, sf_dir):
            part.write.mode("append").json(path)
        _landed[key] = path
    return _landed[key]


def landed(spark: SparkSession, sf_dir: str, log: str) -> DataFrame:
    return read_pages(spark, land(spark, sf_dir, log))
