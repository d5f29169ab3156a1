"""Schemas of the landed, loaded and reported tables, as Spark DDL strings."""

# One row per API request, as the fetching job lands it.  (run_id, source, seq) is the key.
PAGE_LOG = (
    "run_id STRING, source STRING, seq BIGINT, path STRING, request_cursor STRING, "
    "request_limit BIGINT, requested_at TIMESTAMP, status INT, "
    "headers MAP<STRING,STRING>, body STRING"
)
CORRUPT = "_corrupt_record"

# Only `data` is typed: everything else is read leniently, so an odd value in
# `pagination` or `meta` cannot cost the page its events.
ENVELOPE = (
    "data ARRAY<VARIANT>, pagination VARIANT, meta VARIANT, "
    f"hasMore VARIANT, nextCursor VARIANT, {CORRUPT} STRING"
)

# The seven payload columns, then the load stamp, then our lineage columns.
PAYLOAD = ["id", "session_id", "type", "user_id", "timestamp", "properties", "raw"]
EVENTS = (
    "id STRING, session_id STRING, type STRING, user_id STRING, timestamp TIMESTAMP, "
    "properties VARIANT, raw VARIANT, ingested_at TIMESTAMP, "
    "ts_defaulted BOOLEAN, event_date DATE, source STRING, run_id STRING, seq BIGINT, pos INT"
)
CHECKPOINTS = "id INT, cursor STRING, events_saved BIGINT, updated_at TIMESTAMP, version BIGINT"
REJECTS = (
    "run_id STRING, source STRING, seq BIGINT, pos INT, reason STRING, raw STRING, "
    "ingested_at TIMESTAMP, file STRING, raw_hash BIGINT"
)

# Two rows a load: `open` before its append, `done` after it, with the rows the table then holds.
# `ids` were added to a generation of the id filter.
LEDGER = (
    "version BIGINT, state STRING, batch STRING, inserted BIGINT, total BIGINT, "
    "generation INT, ids BIGINT"
)

# Bloom filter of the event table's ids.
ID_FILTERS = "slot BIGINT, bits BIGINT"

# Where the event table's files are: the row with the highest version names the folder.
LAYOUTS = "folder STRING, version BIGINT"

SESSION = (
    "id STRING, userId STRING, deviceType STRING, browser STRING, os STRING, country STRING, "
    "city STRING, startedAt STRING, endedAt STRING, duration DOUBLE, eventCount BIGINT"
)
CURSOR = "id STRING, ts BIGINT, v BIGINT, exp BIGINT"


def column_names(ddl: str) -> list[str]:
    """Column names of one of the flat DDL strings above."""
    depth, start, parts = 0, 0, []
    for i, ch in enumerate(ddl):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            parts.append(ddl[start:i])
            start = i + 1
    parts.append(ddl[start:])
    return [p.split()[0] for p in parts]


EVENT_COLUMNS = column_names(EVENTS)
REJECT_COLUMNS = column_names(REJECTS)
