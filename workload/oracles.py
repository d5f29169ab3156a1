"""DuckDB SQL for each registered query, computed straight from the given tables."""

from __future__ import annotations

# One row per event: the values its raw JSON stands for.
_EV = """
ev AS (
  SELECT event_id, user_id, event_type, ts, props,
         event_id // 100 AS p, 'evt-' || event_id AS id,
         epoch_us(ts) // 1000 AS true_ms,
         CASE WHEN event_id % 6 IN (0, 2) THEN epoch_us(ts) // 1000
              WHEN event_id % 6 IN (1, 3) THEN epoch_us(ts) // 1000000 * 1000
              ELSE 1709251200000 END AS ms,
         event_id % 6 >= 4 AS ts_defaulted,
         's-' || user_id || '-' || strftime(ts, '%Y-%m-%d') AS session_id
  FROM events)"""

# Every delivered copy, in the order (seq, pos).
_ARR = _EV + """,
arr AS (
  SELECT *, 'early' AS type, 'run-1' AS run_id, p AS seq,
         row_number() OVER (PARTITION BY p ORDER BY event_id) - 1 AS pos
  FROM ev WHERE event_type = 'view'
  UNION ALL
  SELECT *, event_type, 'run-2', 1000000000 + p,
         row_number() OVER (PARTITION BY p ORDER BY event_id) - 1
  FROM ev
  UNION ALL
  SELECT *, 'late', 'run-3', 2000000000 + p,
         row_number() OVER (PARTITION BY p ORDER BY event_id) - 1
  FROM ev WHERE event_type = 'click')"""

_WIN = _ARR + """,
win AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq, pos) AS rn FROM arr) WHERE rn = 1)"""

# Event table after the last attempt was loaded first.
_LATE_FIRST = _ARR + """,
win AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY id ORDER BY CASE WHEN run_id = 'run-3' THEN 0 ELSE 1 END, seq, pos) AS rn
    FROM arr) WHERE rn = 1)"""

_CTL = """
pg AS (SELECT event_id // 100 AS p, count(*) AS cnt FROM events GROUP BY 1),
slots AS (
  SELECT p, cnt, unnest(range(0, 1 + CASE WHEN p % 40 = 30 THEN 11 WHEN p % 8 = 3 THEN 4 ELSE 0 END)) AS slot
  FROM pg),
ctl AS (
  SELECT 'run-' || (p % 3) AS run_id, CASE WHEN p % 3 = 2 THEN 'events' ELSE 'feed' END AS source,
         p * 16 + slot AS seq, CASE WHEN slot = 0 THEN cnt ELSE 0 END AS n_events,
         p % 64 <> 61 AS has_more, 'c-' || (p * 16 + slot) AS next_cursor, p, slot
  FROM slots),
asked AS (
  SELECT *, lag(next_cursor) OVER (PARTITION BY run_id, source ORDER BY seq) AS prev_cursor,
         lag(seq) OVER (PARTITION BY run_id, source ORDER BY seq) AS prev_seq
  FROM ctl),
req AS (
  SELECT *, CASE WHEN prev_seq IS NULL OR p % 10 = 7 THEN NULL
                 WHEN p % 10 = 4 THEN 'x-' || seq
                 ELSE prev_cursor END AS request_cursor
  FROM asked),
num AS (
  SELECT *, row_number() OVER w AS page_no,
         sum(CASE WHEN n_events > 0 THEN 1 ELSE 0 END) OVER w AS island
  FROM req WINDOW w AS (PARTITION BY run_id, source ORDER BY seq)),
streaks AS (
  SELECT *, sum(CASE WHEN n_events = 0 THEN 1 ELSE 0 END) OVER (
      PARTITION BY run_id, source, island ORDER BY seq) AS empty_streak
  FROM num),
stops AS (
  SELECT run_id, source, min(CASE WHEN empty_streak >= 10 THEN seq END) AS e,
         min(CASE WHEN NOT has_more THEN seq END) AS t
  FROM streaks GROUP BY 1, 2)"""

_REQ = """
rq AS (
  SELECT event_id AS seq, event_id AS n, 'run-' || (user_id % 2) AS run_id,
         CASE WHEN event_id % 7 < 2 THEN 'feed' ELSE 'events' END AS source,
         epoch_us(ts) // 1000 AS at_ms,
         [200, 200, 400, 400, 401, 403, 403, 403, 429, 429, 500, 204][event_id % 12 + 1] AS status,
         CASE WHEN event_id % 12 IN (8, 9) OR event_id % 5 = 0 THEN NULL ELSE 10::BIGINT END AS rate_limit,
         CASE WHEN event_id % 12 IN (8, 9) THEN NULL ELSE event_id % 10 END AS rate_remaining,
         CASE WHEN event_id % 12 = 8 THEN NULL WHEN event_id % 12 = 9 THEN 17
              ELSE event_id % 600 + 1 END AS rate_reset,
         CASE WHEN event_id % 4 < 2 THEN '/api/v1/events' WHEN event_id % 4 = 2 THEN '/api/v1/sessions/:id'
              ELSE '/api/v1/users/:id/events/:id' END AS bucket
  FROM events),
cls AS (
  SELECT *, CASE WHEN status IN (200, 204) THEN 'ok'
                 WHEN n % 12 = 2 THEN 'cursor_expired'
                 WHEN n % 12 IN (5, 6) AND source = 'feed' THEN 'token_expired'
                 WHEN status = 429 THEN 'rate_limited'
                 WHEN source = 'events' AND status IN (401, 403) THEN 'fatal'
                 ELSE 'retryable' END AS outcome,
         CASE WHEN n % 12 = 8 THEN n % 50 WHEN n % 12 = 9 AND source = 'feed' THEN 5
              WHEN n % 12 = 9 THEN 17 END AS wait_s
  FROM rq)"""

_DIRTY = _EV + """,
bad AS (
  SELECT *, row_number() OVER (PARTITION BY p ORDER BY event_id) - 1 AS pos,
         CASE WHEN event_id % 11 IN (0, 1) THEN 'no_id' WHEN event_id % 11 IN (2, 4) THEN 'bad_type'
              WHEN event_id % 11 = 3 THEN 'ts_range' END AS reason,
         CASE WHEN event_id % 11 = 5 THEN '' || event_id ELSE id END AS out_id
  FROM ev)"""

_SRC = _EV + """,
feed AS (SELECT *, event_type AS type FROM ev WHERE ts < TIMESTAMP '2024-01-16'),
src AS (
  SELECT id, type, true_ms, 0 AS rnk, p AS seq, row_number() OVER (PARTITION BY p ORDER BY event_id) - 1 AS pos
  FROM feed
  UNION ALL
  SELECT id, 'fallback', true_ms, 1, p, pos
  FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY event_id) - 1 AS pos FROM ev)
  WHERE true_ms >= (SELECT max(true_ms) // 1000 * 1000 FROM feed))"""

_SLIM = "id, type, ms, run_id, seq, CAST(pos AS INT) AS pos"


def _k(alias: str = "") -> str:
    """``properties.k``: absent where the raw properties are 0, empty text or an empty object."""
    return f"CASE WHEN {alias}event_id % 9 > 2 THEN CAST(json_extract({alias}props, '$.k') AS BIGINT) END"


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


_PACING = _REQ + """,
calls AS (
  SELECT *, outcome = 'ok' AND rate_limit <> 0 AND rate_reset <> 0 AS names
  FROM cls WHERE source = 'events'),
known AS (
  SELECT *, lag(CASE WHEN names THEN seq END IGNORE NULLS) OVER w AS known_seq,
         lag(seq) OVER w AS prev_seq, lag(at_ms) OVER w AS prev_ms
  FROM calls WINDOW w AS (PARTITION BY run_id, bucket ORDER BY seq)),
prior AS (
  SELECT k.*, lag(known_seq) OVER (PARTITION BY run_id, bucket ORDER BY seq) AS prev_known
  FROM known k),
audit AS (
  SELECT a.run_id, a.bucket, a.seq,
         CASE WHEN a.prev_known IS NOT NULL THEN a.at_ms - a.prev_ms END AS gap_ms,
         c.rate_reset * 1000.0::DOUBLE / c.rate_limit AS min_interval
  FROM prior a JOIN calls c ON c.seq = a.known_seq)"""

ORACLES: dict[str, str] = {
    "scan_feed_pages": _with(_CTL, "SELECT run_id, seq, request_cursor, n_events FROM req WHERE source = 'feed'"),
    "scan_events_pages": _with(_CTL, "SELECT run_id, seq, request_cursor, n_events FROM req WHERE source = 'events'"),
    "stream_page_scan": _with(_CTL, "SELECT run_id, source, seq, n_events FROM req"),
    "decode_envelope": _with(_CTL, """
SELECT run_id, source, seq,
       CASE WHEN p % 4 = 0 THEN 50 WHEN p % 4 = 1 THEN CASE WHEN source = 'feed' THEN 5000 ELSE 1000 END
            ELSE 100 END::BIGINT AS page_limit,
       has_more, next_cursor, CASE WHEN p % 4 >= 2 THEN 120::BIGINT END AS cursor_expires_in,
       CASE WHEN p % 4 = 0 THEN 0 WHEN p % 4 = 1 THEN 7 ELSE 3000000 END::BIGINT AS meta_total,
       n_events AS meta_returned, CASE WHEN p % 4 >= 2 THEN 'req' ELSE '' END AS request_id, n_events
FROM req"""),
    "flatten_pages": _with(_ARR, "SELECT run_id, seq, CAST(pos AS INT) AS pos, id FROM arr"),
    "unnest_arrays": """
WITH e AS (SELECT event_id // 100 AS p, event_id, event_type,
                  row_number() OVER (PARTITION BY event_id // 100 ORDER BY event_id) AS i FROM events),
c AS (SELECT p, event_id, row_number() OVER (PARTITION BY p ORDER BY event_id) AS i
      FROM e WHERE event_type = 'click')
SELECT e.p, e.event_id AS ids, e.event_type AS types, c.event_id AS clicks
FROM e LEFT JOIN c ON e.p = c.p AND e.i = c.i""",
    "time_range": _with(_WIN, f"SELECT {_SLIM} FROM win WHERE ms >= 1704844800000 AND ms < 1705708800000"),
    "session_pages": """
SELECT 's-' || user_id || '-' || strftime(ts, '%Y-%m-%d') AS id, CAST(user_id AS VARCHAR) AS "userId",
       count(*) AS "eventCount", CAST(NULL AS DOUBLE) AS duration
FROM events GROUP BY user_id, strftime(ts, '%Y-%m-%d')""",
    "session_rejects": """
SELECT 'run-1' AS run_id, 'events' AS source, event_id AS seq,
       CASE event_id % 10 WHEN 2 THEN 1 WHEN 3 THEN 0 END AS pos,
       CASE event_id % 10 WHEN 2 THEN 'no_id' WHEN 3 THEN 'bad_type' ELSE 'bad_json' END AS reason,
       CASE event_id % 10
         WHEN 1 THEN '{"data":[{"id":"s-' || event_id || '","eventCount":1}'
         WHEN 2 THEN '{"userId":"u"}'
         WHEN 3 THEN CAST(event_id AS VARCHAR)
         WHEN 4 THEN 'nonsense ' || event_id
         ELSE '{"data":{"id":"s-' || event_id || '","eventCount":1}}' END AS raw
FROM events WHERE event_id % 10 BETWEEN 1 AND 5""",
    "target_scan": _with(_WIN, f"SELECT {_SLIM} FROM win"),
    "checkpoint_lookup": """
SELECT 'c-' || event_id AS cursor, event_id + 1 AS events_saved FROM events
ORDER BY date_trunc('day', ts) DESC, event_id DESC LIMIT 1""",
    "normalize_timestamp": _with(_ARR, "SELECT id, seq, ms, ts_defaulted FROM arr"),
    "project_events": _with(_ARR, f"""
SELECT seq, CAST(pos AS INT) AS pos, id, session_id, type, CAST(user_id AS VARCHAR) AS user_id,
       event_id % 9 IN (0, 1) AS no_properties, {_k()} AS k, 'n' AS raw_name,
       1709251200000 AS ingested_ms, CAST(make_timestamp_ms(ms) AS DATE) AS event_date
FROM arr"""),
    "iso_time": _with(_WIN, """
SELECT id, strftime(make_timestamp_ms(ms), '%Y-%m-%dT%H:%M:%S.%gZ') AS iso, ms // 1000 AS epoch_s FROM win"""),
    "mask_secret": _with(_WIN, "SELECT id, left(session_id, 4) || '...' || right(session_id, 4) AS masked FROM win"),
    "decode_cursor": _with(_CTL + "," + _ARR, """
SELECT run_id, seq, 'p-' || seq AS id, seq * 1000 AS ts, 1::BIGINT AS v, 1704067200000 + seq * 60000 AS exp,
       seq < 20 AS expired
FROM (SELECT DISTINCT run_id, seq FROM arr)
UNION ALL SELECT run_id, seq, NULL, NULL, NULL, NULL, NULL FROM ctl"""),
    "path_buckets": _with(_REQ, "SELECT bucket, count(*) AS requests FROM rq GROUP BY bucket"),
    "header_ints": _with(_REQ, "SELECT seq, rate_limit, rate_remaining, rate_reset FROM rq"),
    "backoff_schedule": _with(_REQ, """
SELECT seq, attempt, least(CAST(1000 * pow(2, attempt - 1) AS BIGINT), 10000) AS capped_ms,
       CAST(1000 * pow(2, attempt - 1) AS BIGINT) AS uncapped_ms, 5000 * attempt AS run_retry_ms
FROM (
  SELECT seq, outcome, row_number() OVER (PARTITION BY run_id, source, streak ORDER BY seq)
                       - CASE WHEN streak > 0 THEN 1 ELSE 0 END AS attempt
  FROM (SELECT *, sum(CASE WHEN outcome = 'retryable' THEN 0 ELSE 1 END)
                    OVER (PARTITION BY run_id, source ORDER BY seq) AS streak FROM cls))
WHERE outcome = 'retryable'"""),
    "raw_json": _with(_WIN, "SELECT id, session_id, type FROM win"),
    "copy_text": r"""
SELECT doc_id || chr(9) || lang || chr(9) ||
       replace(replace(replace(replace(text, '\', '\\'), chr(9), '\t'), chr(10), '\n'), chr(13), '\r') AS value
FROM documents""",
    "classify_responses": _with(_REQ, "SELECT seq, source, status, outcome, wait_s FROM cls"),
    "page_flags": _with(_CTL, "SELECT seq, n_events > 0 AS nonempty, NOT has_more AS terminal FROM ctl"),
    "target_reached": _with(_WIN, """
SELECT count(*) AS count, count(*) >= 3000 AS reached, max(ms) FILTER (NOT ts_defaulted) // 1000 * 1000 AS since_ms
FROM win"""),
    "key_check": _with(_WIN, """
SELECT count(*) AS row_count, count(DISTINCT id) AS distinct_ids, 0::BIGINT AS null_ids,
       count(*) = count(DISTINCT id) AS is_key, 'arrivals' AS stage FROM arr
UNION ALL
SELECT count(*), count(DISTINCT id), 0, count(*) = count(DISTINCT id), 'events' FROM win"""),
    "dedup_first_wins": _with(_WIN, f"SELECT {_SLIM} FROM win"),
    "insert_if_absent": _with(_LATE_FIRST, """
SELECT id, type, run_id, seq, CAST(pos AS INT) AS pos,
       CASE WHEN run_id = 'run-3' THEN 1709251200000 ELSE 1709337600000 END AS ingested_ms FROM win"""),
    "rows_per_batch": _with(_LATE_FIRST, """
SELECT CASE WHEN run_id = 'run-3' THEN 1709251200000 ELSE 1709337600000 END AS ingested_ms,
       count(*) AS inserted FROM win GROUP BY 1"""),
    "insert_from_arrays": _with(_WIN, f"SELECT {_SLIM} FROM win"),
    "staging_load": _with(_ARR, f"""
SELECT id, session_id, type, CAST(user_id AS VARCHAR) AS user_id, ms, {_k()} AS k FROM arr"""),
    "rejects": _with(_DIRTY, """
SELECT 'run-1' AS run_id, 'feed' AS source, p AS seq, CAST(pos AS INT) AS pos, reason
FROM bad WHERE reason IS NOT NULL AND p % 13 NOT IN (5, 6)
UNION ALL
SELECT DISTINCT 'run-1', 'feed', p, NULL, 'bad_json' FROM bad WHERE p % 13 IN (5, 6)"""),
    "load_dirty": _with(_DIRTY, """
SELECT out_id AS id, event_type AS type, true_ms AS ms, 'run-1' AS run_id, p AS seq, CAST(pos AS INT) AS pos
FROM bad WHERE reason IS NULL AND p % 13 NOT IN (5, 6)"""),
    "page_chain": _with(_CTL, """
SELECT run_id, source, seq, request_cursor, prev_seq, prev_cursor AS expected_cursor,
       CASE WHEN prev_seq IS NULL THEN 'start' WHEN p % 10 = 7 THEN 'reset' WHEN p % 10 = 4 THEN 'broken'
            ELSE 'linked' END AS link
FROM req"""),
    "cursor_chain": """
WITH RECURSIVE pg AS (SELECT event_id // 100 AS p, event_id // 300 AS j, event_id // 300 // 8 AS block,
    event_id // 300 % 8 AS k FROM events GROUP BY ALL),
log AS (
  SELECT 'run-' || (p % 3) AS run_id, 'feed' AS source, (p * 7919) % 1000003 * 2 + copy AS seq,
         CASE WHEN k = 0 AND block % 5 = 3 THEN 'c-' || (j + 7) WHEN k = 0 THEN NULL
              WHEN k = 5 AND block % 5 = 1 THEN 'x-' || j WHEN k = 6 AND block % 5 = 2 THEN NULL
              ELSE 'c-' || (j - 1) END AS asked,
         CASE WHEN copy = 0 THEN 'c-' ELSE 'r-' END || j AS handed
  FROM pg, range(2) AS r(copy) WHERE copy = 0 OR j % 6 = 2),
up AS (
  SELECT l.*, (SELECT min(h.seq) FROM log h WHERE h.run_id = l.run_id AND h.handed = l.asked) AS parent_seq,
         CASE WHEN asked IS NOT NULL THEN count(*) OVER (PARTITION BY run_id, asked) END AS siblings
  FROM log l),
chain(run_id, seq, head_seq, step) AS (
  SELECT run_id, seq, seq, 0::BIGINT FROM up WHERE parent_seq IS NULL
  UNION ALL
  SELECT u.run_id, u.seq, c.head_seq, c.step + 1 FROM chain c JOIN up u ON u.run_id = c.run_id AND u.parent_seq = c.seq)
SELECT u.run_id, u.source, u.seq, u.parent_seq, c.head_seq, c.step, u.siblings,
       CASE WHEN asked IS NULL THEN 'start' WHEN parent_seq IS NULL THEN 'orphan' WHEN c.seq IS NULL THEN 'loop'
            ELSE 'linked' END AS link
FROM up u LEFT JOIN chain c ON u.run_id = c.run_id AND u.seq = c.seq""",
    "backfill_union": _with(_SRC, """
SELECT id, type, true_ms AS ms, 'run-1' AS run_id, seq, CAST(pos AS INT) AS pos
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY rnk, seq, pos) AS rn FROM src) WHERE rn = 1"""),
    "replay_attempts": _with(_LATE_FIRST, f"SELECT {_SLIM} FROM win"),
    "event_count": _with(_WIN, "SELECT count(*) AS count FROM win"),
    "max_event_ms": _with(_WIN, """
SELECT max(ms) // 1000 * 1000 AS max_ts, 'floor' AS mode FROM win WHERE NOT ts_defaulted
UNION ALL
SELECT CAST(round(max(ms) / 1000.0) AS BIGINT) * 1000, 'round' FROM win WHERE NOT ts_defaulted"""),
    "page_counters": _with(_CTL, """
SELECT run_id, source, count(*) AS pages, count(*) FILTER (n_events = 0) AS empty_pages,
       CAST(sum(n_events) AS BIGINT) AS events FROM ctl GROUP BY 1, 2"""),
    "progress_report": _with(_WIN, """,
c AS (SELECT count(*) AS n FROM win),
r AS (SELECT n, CAST(floor(n / 37.0 + 0.5) AS BIGINT) AS rate, 3000000 - n AS remaining FROM c),
t AS (SELECT *, CAST(floor(remaining / rate + 0.5) AS BIGINT) AS eta_s FROM r)
SELECT n AS saved, 3000000::BIGINT AS target, format('{:.1f}', n / 3000000 * 100) AS pct, rate, remaining, eta_s,
       eta_s // 60 AS eta_min, eta_s % 60 AS eta_sec,
       format('{:,}', n) || ' / 3,000,000 (' || format('{:.1f}', n / 3000000 * 100) || '%) | ' || rate
         || ' evt/s' AS line
FROM t"""),
    "session_rollup": _with(_WIN, """
SELECT session_id, count(*) AS event_count, count(*) FILTER (ts_defaulted) AS defaulted,
       min(ms) FILTER (NOT ts_defaulted) AS started_ms, max(ms) FILTER (NOT ts_defaulted) AS ended_ms,
       max(ms) FILTER (NOT ts_defaulted) - min(ms) FILTER (NOT ts_defaulted) AS duration_ms, CAST(any_value(user_id) AS VARCHAR) AS user_id
FROM win GROUP BY session_id"""),
    "reconcile": _with(_WIN, """,
d AS (SELECT run_id, count(*) AS delivered, count(DISTINCT id) AS ids FROM arr GROUP BY 1),
u AS (SELECT run_id, count(*) AS loaded_ids FROM win GROUP BY 1)
SELECT d.run_id, 'feed' AS source, 3000000::BIGINT AS announced, delivered AS returned, delivered,
       ids AS distinct_ids, coalesce(loaded_ids, 0) AS loaded_ids, 0::BIGINT AS returned_diff,
       3000000 - ids AS missing, 3000000 - ids AS target_shortfall
FROM d LEFT JOIN u ON d.run_id = u.run_id"""),
    "page_check": _with(_CTL, """
SELECT run_id, source, seq, n_events, n_events AS meta_returned, 0::BIGINT AS returned_diff FROM ctl"""),
    "checkpoint_latest": """
SELECT 1 AS id, 'c-' || event_id AS cursor, event_id + 1 AS events_saved FROM events
ORDER BY date_trunc('day', ts) DESC, event_id DESC LIMIT 1""",
    "checkpoint_upsert": """
SELECT 1 AS writes, 1 AS id, 'run-3' AS cursor, count(*) FILTER (event_type = 'click') AS events_saved FROM events
UNION ALL SELECT 2, 1, 'run-2', count(*) FROM events
UNION ALL SELECT 3, 1, NULL, count(*) FROM events""",
    "empty_page_stop": _with(_CTL, """
SELECT s.run_id, s.source, seq, page_no, CAST(empty_streak AS BIGINT) AS empty_streak
FROM streaks s JOIN stops p ON s.run_id = p.run_id AND s.source = p.source
WHERE p.e IS NULL OR seq <= p.e"""),
    "page_cut": _with(_CTL, """
SELECT s.run_id, s.source, seq, n_events
FROM streaks s JOIN stops p ON s.run_id = p.run_id AND s.source = p.source
WHERE seq <= coalesce(least(p.e, p.t), seq)"""),
    "terminal_cut": _with(_CTL, """
SELECT s.run_id, s.source, seq
FROM streaks s JOIN stops p ON s.run_id = p.run_id AND s.source = p.source
WHERE p.t IS NULL OR seq <= p.t"""),
    "stop_points": _with(_CTL, """
SELECT run_id, source, least(e, t) AS stop_seq,
       CASE WHEN e <= coalesce(t, e) THEN 'empty_pages' WHEN t IS NOT NULL THEN 'end_of_data' END AS stop_reason
FROM stops"""),
    "checkpoint_points": _with(_CTL, """
SELECT run_id, source, seq, page_no,
       CASE WHEN source = 'feed' THEN next_cursor ELSE request_cursor END AS resume_cursor
FROM num WHERE page_no % CASE WHEN source = 'feed' THEN 10 ELSE 5 END = 0"""),
    "target_cut": _with(_WIN, """,
n AS (SELECT run_id, 'feed' AS source, seq, count(*) AS new_rows FROM win GROUP BY 1, 2, 3),
r AS (SELECT *, CAST(sum(new_rows) OVER (ORDER BY run_id, seq) AS BIGINT) AS total FROM n)
SELECT run_id, source, seq, new_rows, total, total >= 3000 AS is_target_page FROM r
WHERE total - new_rows < 3000"""),
    "late_target": _with(_WIN, """,
n AS (SELECT run_id, seq, count(*) AS new_rows FROM win GROUP BY 1, 2),
asked_at AS (SELECT run_id, seq, max(epoch_us(ts)) + (right(run_id, 1)::BIGINT - 1) * 366 * 86400000000 AS us
       FROM arr GROUP BY 1, 2),
spans AS (SELECT us // 21600000000 * 21600000 AS span_ms, count(*) AS pages, CAST(sum(new_rows) AS BIGINT) AS new_rows
          FROM n JOIN asked_at USING (run_id, seq) GROUP BY 1),
r AS (SELECT *, CAST(sum(new_rows) OVER (ORDER BY span_ms) AS BIGINT) AS total FROM spans)
SELECT span_ms, pages, new_rows, total - new_rows AS known_total, total, total >= 3000 AS is_target_span,
       greatest(total - 3000, 0) AS overshoot
FROM r WHERE total - new_rows < 3000"""),
    "pacing_audit": _with(_PACING, """
SELECT run_id, bucket, seq, gap_ms, round(min_interval, 3) AS min_interval_ms,
       round(coalesce(greatest(min_interval - gap_ms, 0), 0), 3) AS wait_ms
FROM audit"""),
    "export_ids": _with(_WIN, "SELECT id FROM win"),
    "export_copy": _with(_WIN, """
SELECT id, session_id, type, CAST(user_id AS VARCHAR) AS user_id,
       strftime(make_timestamp_ms(ms), '%Y-%m-%dT%H:%M:%S.%gZ') AS iso,
       event_id % 9 IN (0, 1) AS no_properties, 'n' AS raw_name FROM win"""),
    "layout_by_time": _with(_WIN, """
SELECT CAST(make_timestamp_ms(ms) AS DATE) AS event_date, count(*) AS events, min(id) AS first_id
FROM win GROUP BY 1"""),
    "layout_by_session": _with(_WIN, "SELECT session_id, count(*) AS events FROM win GROUP BY 1"),
    "compacted_table": _with(_LATE_FIRST, f"SELECT {_SLIM} FROM win"),
    "stream_ingest": _with(_WIN, f"SELECT {_SLIM} FROM win"),
    "stream_late_copies": _with(_LATE_FIRST, f"""
SELECT {_SLIM}, count(*) OVER () AS events_saved
FROM (SELECT * REPLACE (CASE WHEN run_id <> 'run-3' AND ts_defaulted THEN 1709337600000 ELSE ms END AS ms) FROM win)"""),
    "stream_resume": _with(_WIN, """
SELECT run_id, count(*) AS events, (SELECT count(*) FROM win) AS events_saved FROM win GROUP BY 1"""),
    "run_job": _with(_EV, "SELECT id FROM ev"),
    "run_job_stopped": _with(_CTL + "," + _EV, """
SELECT DISTINCT ev.id, NULL::VARCHAR AS run_id, NULL::BIGINT AS seq
FROM ev JOIN ctl c ON c.p = ev.p AND c.slot = 0
JOIN stops s ON c.run_id = s.run_id AND c.source = s.source
WHERE c.seq <= coalesce(least(s.e, s.t), c.seq)
UNION ALL
SELECT NULL, c.run_id, c.seq FROM ctl c JOIN stops s ON c.run_id = s.run_id AND c.source = s.source
WHERE c.seq > least(s.e, s.t)"""),
    "load_clashing": _with(_EV, """
SELECT id, CASE event_type WHEN 'view' THEN 'run-2-feed' WHEN 'click' THEN 'run-2-events'
                           ELSE 'run-10-feed' END AS type,
       CASE WHEN event_type IN ('view', 'click') THEN 'run-2' ELSE 'run-10' END AS run_id,
       CASE event_type WHEN 'click' THEN 'events' ELSE 'feed' END AS source FROM ev"""),
    "backfill_missing_times": _with(_EV, """,
f AS (SELECT id, event_type AS type, ms, ts_defaulted, 0 AS rnk, p,
             row_number() OVER (PARTITION BY p ORDER BY event_id) - 1 AS pos
      FROM ev WHERE ts < TIMESTAMP '2024-01-16'),
b AS (SELECT id, 'fallback' AS type, ms, ts_defaulted, 1 AS rnk, p,
             row_number() OVER (PARTITION BY p ORDER BY event_id) - 1 AS pos FROM ev),
s AS (SELECT * FROM f UNION ALL SELECT * FROM b
      WHERE ts_defaulted OR ms >= (SELECT max(ms) // 1000 * 1000 FROM f WHERE NOT ts_defaulted))
SELECT id, type, ms, 'run-1' AS run_id, p AS seq, CAST(pos AS INT) AS pos
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY rnk, p, pos) AS rn FROM s) WHERE rn = 1"""),
    "short_circuit": _with(_EV, "SELECT id FROM ev WHERE event_type = 'click'"),
}


def _join_ctes(sql: str) -> str:
    """A body that opens with a comma goes on with the CTE list."""
    return sql.replace(")\n,\n", "),\n")


ORACLES = {name: _join_ctes(sql) for name, sql in ORACLES.items()}
