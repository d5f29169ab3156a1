"""Page bodies to envelopes, envelopes to events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill import schemas
from eventmill.functions.responses import outcome, wait_seconds
from eventmill.functions.text import header_int
from eventmill.functions.variants import as_long, as_text, field, is_truthy

# Page size assumed when neither response nor request names one.
FEED_LIMIT, EVENTS_LIMIT = 5000, 1000

PAGE_KEY = ["run_id", "source", "seq"]


def classify(pages: DataFrame) -> DataFrame:
    """Adds ``outcome`` and ``wait_s`` to each request."""
    return pages.withColumns(
        {
            "outcome": outcome(F.col("source"), F.col("status"), F.col("body")),
            "wait_s": wait_seconds(F.col("source"), F.col("status"), F.col("headers")),
        }
    )


def with_rate_limit(pages: DataFrame) -> DataFrame:
    """Adds the rate-limit headers as integers."""
    headers = F.col("headers")
    return pages.withColumns(
        {
            "rate_limit": header_int(headers, "x-ratelimit-limit"),
            "rate_remaining": header_int(headers, "x-ratelimit-remaining"),
            "rate_reset": header_int(headers, "x-ratelimit-reset"),
        }
    )


def _first_present(*values: Column) -> Column:
    """First value that is neither missing nor JSON null."""
    return F.coalesce(*[F.when(~F.is_variant_null(v), v) for v in values])


def decode(pages: DataFrame) -> DataFrame:
    """Successful requests to decoded pages, one row each, defaults filled in.

    ``bad_body`` carries the body when it is not a page: not JSON, or ``data`` not an array.
    Both the nested and the flat pagination shape are read.
    """
    body = F.from_json(
        "body", schemas.ENVELOPE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
    )
    ok = classify(pages).where(F.col("outcome") == "ok").withColumn("_p", body)
    page, meta = F.col("_p.pagination"), F.col("_p.meta")
    default_limit = F.when(F.col("source") == "feed", FEED_LIMIT).otherwise(EVENTS_LIMIT)
    data = F.col("_p.data")
    n_events = F.when(data.isNull(), 0).otherwise(F.size(data)).cast("bigint")
    unusable = F.col("_p").isNull() | F.col(f"_p.{schemas.CORRUPT}").isNotNull()
    return ok.select(
        *PAGE_KEY,
        "path",
        "request_cursor",
        "requested_at",
        F.coalesce(as_long(field(page, "limit")), "request_limit", default_limit)
        .cast("bigint")
        .alias("page_limit"),
        is_truthy(_first_present(field(page, "hasMore"), F.col("_p.hasMore"))).alias("has_more"),
        as_text(_first_present(field(page, "nextCursor"), F.col("_p.nextCursor"))).alias("next_cursor"),
        as_long(field(page, "cursorExpiresIn")).alias("cursor_expires_in"),
        F.coalesce(as_long(field(meta, "total")), F.lit(0)).cast("bigint").alias("meta_total"),
        F.coalesce(as_long(field(meta, "returned")), n_events).alias("meta_returned"),
        F.coalesce(as_text(field(meta, "requestId")), F.lit("")).alias("request_id"),
        n_events.alias("n_events"),
        F.when(unusable, F.coalesce("body", F.lit(""))).alias("bad_body"),
        data.alias("data"),
    )


def headers(decoded: DataFrame) -> DataFrame:
    """Decoded pages without their events: what page control works on.

    A page that could not be decoded is no page to the fetching loop, so it is left out.
    """
    return decoded.where(F.col("bad_body").isNull()).drop("data", "bad_body")


def flatten(decoded: DataFrame) -> DataFrame:
    """Decoded pages to events; ``(seq, pos)`` is the arrival order within a run and source.

    The outer form with a filter behind it gives the same rows as the inner one.  For the inner
    form the planner adds a filter on the array's size, and parses each page again for it.
    """
    started = [c for c in ("run_started",) if c in decoded.columns]
    return decoded.select(*PAGE_KEY, *started, F.posexplode_outer("data").alias("pos", "e")).where(
        F.col("pos").isNotNull()
    )


def bad_lines(pages: DataFrame) -> DataFrame:
    """Rejects among the log's lines: those the reader could not read, with the file they are in."""
    return pages.where(F.col(schemas.CORRUPT).isNotNull()).select(
        *PAGE_KEY,
        F.lit(None).cast("int").alias("pos"),
        F.lit("bad_line").alias("reason"),
        F.col(schemas.CORRUPT).alias("raw"),
        F.input_file_name().alias("file"),
    )


def bad_bodies(decoded: DataFrame) -> DataFrame:
    """Rejects among the pages: bodies that could not be decoded."""
    return decoded.where(F.col("bad_body").isNotNull()).select(
        *PAGE_KEY,
        F.lit(None).cast("int").alias("pos"),
        F.lit("bad_json").alias("reason"),
        F.col("bad_body").alias("raw"),
    )
