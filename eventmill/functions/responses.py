"""Classifying API responses from the page log."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventmill.functions.text import header_int

# Substrings that mark an expired cursor or stream token (case-sensitive).
CURSOR_EXPIRED_MARKS = ["CURSOR_EXPIRED", "Cursor expired"]
TOKEN_EXPIRED_MARKS = ["expired", "INVALID_STREAM_TOKEN"]
# Seconds to wait after a 429 that names no time.
FEED_WAIT_S = 5
EVENTS_WAIT_S = 60


def _contains_any(body: Column, marks: list[str]) -> Column:
    found = F.lit(False)
    for mark in marks:
        found = found | F.contains(F.coalesce(body, F.lit("")), F.lit(mark))
    return found


def is_cursor_expired(status: Column, body: Column) -> Column:
    return (status == 400) & _contains_any(body, CURSOR_EXPIRED_MARKS)


def is_token_expired(source: Column, status: Column, body: Column) -> Column:
    return (source == "feed") & (status == 403) & _contains_any(body, TOKEN_EXPIRED_MARKS)


def outcome(source: Column, status: Column, body: Column) -> Column:
    """What the fetching loop does with a response.

    ``fatal`` exists on the events source only; the feed retries those too.
    """
    return (
        F.when(status.between(200, 299), "ok")
        .when(is_cursor_expired(status, body), "cursor_expired")
        .when(is_token_expired(source, status, body), "token_expired")
        .when(status == 429, "rate_limited")
        .when((source == "events") & status.isin(401, 403), "fatal")
        .otherwise("retryable")
    )


def wait_seconds(source: Column, status: Column, headers: Column) -> Column:
    """Seconds to wait after a 429, else NULL."""
    named = header_int(headers, "retry-after")
    window = F.coalesce(header_int(headers, "x-ratelimit-reset"), F.lit(EVENTS_WAIT_S))
    fallback = F.when(source == "feed", F.lit(FEED_WAIT_S)).otherwise(window)
    return F.when(status == 429, F.coalesce(named, fallback)).cast("bigint")
