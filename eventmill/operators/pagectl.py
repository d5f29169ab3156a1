"""Page control: where a run stops, where it checkpoints, whether its pages hang together.

All of it works on page headers, a few dozen bytes per page, never on events.  Order within a
run and source is ``seq``.  Only decoded pages take part: failed requests never count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.functions.text import path_bucket
from eventmill.operators.running import (
    CHUNK,
    Running,
    carried_states,
    chunk_states,
    numbered,
    running,
    same_keys,
)

RUN = ["run_id", "source"]

# Empty pages in a row that end a run; pages between checkpoints per source.
EMPTY_LIMIT = 10
REFRESH_SECONDS = 10
CHECKPOINT_EVERY = {"feed": 10, "events": 5}


def is_nonempty() -> Column:
    return F.col("n_events") > 0


def is_terminal() -> Column:
    """The page after which there is nothing to ask for."""
    return ~F.col("has_more") | (F.coalesce("next_cursor", F.lit("")) == "")


def number_pages(headers: DataFrame) -> DataFrame:
    """Adds ``page_no`` (1-based) and ``empty_streak``, the empty pages in a row ending here."""
    streak = F.col("row_no") - F.coalesce("_last_full", F.lit(0))
    return (
        numbered(headers, RUN, "seq", {"_last_full": is_nonempty()})
        .withColumn("empty_streak", streak)
        .withColumnRenamed("row_no", "page_no")
        .drop("_last_full")
    )


def stop_points(headers: DataFrame, empty_limit: int = EMPTY_LIMIT, chunk: int = CHUNK) -> DataFrame:
    """Per run and source the page it stops at, one row each: ``stop_seq`` and ``stop_reason``.

    A run that reaches neither rule has no ``stop_seq``.  When both fall on one page the empty
    guard is the reason, as it is tested first.

    Chunks are summed up with their first stops: the first last page, the first long streak inside
    the chunk, and the first ``empty_limit`` of the empty pages it begins with, one of which
    completes the streak that earlier chunks may have begun.  So pages move twice, to be sorted and to
    their chunk, and after that only summaries do.
    """
    full = {"_full": is_nonempty()}
    leading = F.col("_last__full").isNull()
    inside = F.col("_n") - F.col("_last__full") >= empty_limit
    _, totals = chunk_states(
        headers, RUN, "seq", full, chunk,
        _end=F.min(F.when(is_terminal(), F.col("seq"))),
        _inner=F.min(F.when(inside, F.col("seq"))),
        _leading=F.sort_array(F.collect_list(F.when(leading & (F.col("_n") <= empty_limit), F.col("seq")))),
    )
    states = carried_states(totals, RUN, full)
    open_streak = F.col("_rows_before") - F.coalesce("_before__full", F.lit(0))
    # The n-th leading page completes the streak; 0 and less cannot be, as earlier pages would have stopped.
    nth = F.greatest(F.lit(empty_limit) - open_streak, F.lit(1)).cast("int")
    empty = F.coalesce(F.get("_leading", nth - 1), F.col("_inner"))
    found = states.groupBy(*RUN).agg(F.min(empty).alias("_empty"), F.min("_end").alias("_end"))
    return found.select(
        *RUN,
        F.least("_empty", "_end").alias("stop_seq"),
        F.when(F.col("_empty") <= F.coalesce("_end", "_empty"), "empty_pages")
        .when(F.col("_end").isNotNull(), "end_of_data")
        .alias("stop_reason"),
    )


def empty_page_stop(headers: DataFrame, empty_limit: int = EMPTY_LIMIT) -> DataFrame:
    """Pages up to and including the one that completes the first long empty streak."""
    pages = number_pages(headers)
    stops = pages.groupBy(*RUN).agg(
        F.min(F.when(F.col("empty_streak") >= empty_limit, F.col("seq"))).alias("stop_seq")
    )
    return keep_until(pages, stops)


def terminal_cut(headers: DataFrame) -> DataFrame:
    """Pages up to and including the first end-of-data page."""
    stops = headers.groupBy(*RUN).agg(F.min(F.when(is_terminal(), F.col("seq"))).alias("stop_seq"))
    return keep_until(headers, stops)


def keep_until(pages: DataFrame, stops: DataFrame) -> DataFrame:
    """Pages not beyond their run's stop.

    ``stops`` has one row per run and source.  Whether it is small enough to broadcast is left
    to the planner, which knows once ``stops`` is read from files; if it is not, adaptive
    execution splits the runs that dominate.
    """
    limits = stops.select(*RUN, "stop_seq")
    return (
        pages.join(limits, RUN, "left")
        .where(F.col("stop_seq").isNull() | (F.col("seq") <= F.col("stop_seq")))
        .drop("stop_seq")
    )


def checkpoint_points(headers: DataFrame, every: dict[str, int] | None = None) -> DataFrame:
    """The pages a run checkpoints at and the cursor it saves.

    The feed saves the next cursor, the events source the cursor of the current request.
    """
    every = every or CHECKPOINT_EVERY
    step = F.when(F.col("source") == "feed", every["feed"]).otherwise(every["events"])
    pages = numbered(headers, RUN, "seq").withColumnRenamed("row_no", "page_no")
    resume = F.when(F.col("source") == "feed", F.col("next_cursor")).otherwise(
        F.col("request_cursor")
    )
    return pages.where(F.pmod("page_no", step) == 0).select(
        *RUN, "seq", "page_no", resume.alias("resume_cursor")
    )


def page_chain(headers: DataFrame) -> DataFrame:
    """Compares each request's cursor with the cursor the page before handed out.

    ``start`` has no page before, ``linked`` follows it, ``reset`` asks without a cursor
    (a rescan from the beginning), ``broken`` asks with a different one.
    """
    previous = Running("max", F.struct("seq", "next_cursor"), before=True)
    linked = running(headers, RUN, "seq", {"_prev": previous})
    before, asked = F.col("_prev.next_cursor"), F.col("request_cursor")
    return linked.select(
        *RUN,
        "seq",
        "request_cursor",
        F.col("_prev.seq").alias("prev_seq"),
        before.alias("expected_cursor"),
        F.when(F.col("_prev").isNull(), "start")
        .when(asked.isNull() & before.isNotNull(), "reset")
        .when(asked.eqNullSafe(before), "linked")
        .otherwise("broken")
        .alias("link"),
    )


def target_cut(
    page_counts: DataFrame, target: int, saved: int = 0, order: str = "run_id"
) -> DataFrame:
    """Pages until the running total of new rows reaches ``target``, that page included.

    ``page_counts`` holds ``new_rows`` per page.  Adds ``total`` (running) and
    ``is_target_page``, true for the page that reaches it.  The total goes on from one run to the
    next, by ``order`` and the feed first, and starts at the rows ``saved`` already.  Totals of
    whole runs, one row each, give a run its start.
    """
    within = running(
        page_counts, RUN, "seq", {"_within": Running("sum", F.col("new_rows").cast("bigint"))}
    )
    fallback = F.when(F.col("source") == "feed", 0).otherwise(1)
    runs = page_counts.groupBy(*RUN).agg(
        F.sum("new_rows").cast("bigint").alias("_rows"), F.struct(F.min(order), "run_id", fallback).alias("_order")
    )
    # Runs are added up in chunks too, so no task sees them all.
    before = running(runs, [], "_order", {"_start": Running("sum", F.col("_rows"), before=True)})
    starts = before.select(*[F.col(c).alias(f"_{c}") for c in RUN], (F.col("_start") + F.lit(saved)).alias("_start"))
    same = same_keys(RUN, [f"_{c}" for c in RUN])
    totals = within.join(starts, same).select(
        *page_counts.columns, (F.col("_start") + F.col("_within")).alias("total")
    )
    before = F.col("total") - F.col("new_rows")
    return totals.where(before < target).withColumn("is_target_page", F.col("total") >= target)


def late_target(
    page_counts: DataFrame, target: int, saved: int = 0, every_seconds: int = REFRESH_SECONDS
) -> DataFrame:
    """The spans of time that a load goes on in when it learns the total every ``every_seconds`` only.

    ``page_counts`` holds ``requested_at`` and ``new_rows`` per page.  The known total is a step
    function of time: inside a span it is that of all spans before, and loading stops at the first
    span that begins at the target or beyond.  One row per span with pages: ``span_start``, ``pages``,
    ``new_rows``, ``known_total``, ``total``, ``is_target_span`` (the total reaches the target here) and
    ``overshoot``, the rows beyond the target.  A page without a time counts as known from the start.

    Pages are summed by span before anything is put in order, so what is sorted are spans, whatever the
    number of pages in one.
    """
    width = every_seconds * 1_000_000
    span = F.floor(F.unix_micros("requested_at") / F.lit(width)).cast("bigint")
    spans = (
        page_counts.groupBy(span.alias("_span"))
        .agg(F.count("*").alias("pages"), F.sum("new_rows").cast("bigint").alias("new_rows"))
        .withColumn("_order", F.coalesce("_span", F.lit(-(1 << 62))))
    )
    known = F.col("known_total")
    totals = running(spans, [], "_order", {"known_total": Running("sum", F.col("new_rows"), before=True)})
    return (
        totals.withColumn("known_total", known + F.lit(saved))
        .where(known < target)
        .select(
            F.timestamp_micros(F.col("_span") * F.lit(width)).alias("span_start"),
            "pages",
            "new_rows",
            "known_total",
            (known + F.col("new_rows")).alias("total"),
            (known + F.col("new_rows") >= target).alias("is_target_span"),
            F.greatest(known + F.col("new_rows") - F.lit(target), F.lit(0)).cast("bigint").alias("overshoot"),
        )
    )


def pacing_audit(requests: DataFrame) -> DataFrame:
    """Was each request far enough from the one before it in its rate-limit bucket?

    Paced are requests to the events source once a successful response has named a non-zero
    limit and reset; the interval is measured from the paced request before.  ``requests`` needs
    ``outcome`` and the parsed rate-limit columns.
    """
    keys = ["run_id", "bucket"]
    calls = requests.where(F.col("source") == "events").withColumn("bucket", path_bucket(F.col("path")))
    names_limit = (F.col("outcome") == "ok") & (F.col("rate_limit") != 0) & (F.col("rate_reset") != 0)
    known = F.when(names_limit, F.struct("seq", "rate_limit", "rate_reset"))
    spec = {
        "_limit": Running("max", known, before=True),
        "_first": Running("min", F.when(names_limit, F.col("seq")), before=True),
        "_prev": Running("max", F.struct("seq", "requested_at"), before=True),
    }
    audited = running(calls, keys, "seq", spec)
    # The request before was paced only if a limit was known before it.
    prev_at = F.when(F.col("_first") < F.col("_prev.seq"), F.col("_prev.requested_at"))
    gap = F.unix_millis("requested_at") - F.unix_millis(prev_at)
    interval = F.col("_limit.rate_reset") * F.lit(1000.0) / F.col("_limit.rate_limit")
    paced = audited.where(F.col("_limit").isNotNull())
    return paced.select(
        "run_id",
        "bucket",
        "seq",
        gap.alias("gap_ms"),
        interval.alias("min_interval_ms"),
        F.coalesce(F.greatest(interval - gap, F.lit(0.0)), F.lit(0.0)).alias("wait_ms"),
    )


def attempts(requests: DataFrame) -> DataFrame:
    """Adds ``attempt``: a retryable request's place in its row of failures, from 1; 0 for others.

    A row of failures is within a run and source, in ``seq`` order; anything else ends it.
    """
    failed = F.col("outcome") == "retryable"
    marked = numbered(requests, RUN, "seq", {"_other": ~failed})
    attempt = F.when(failed, F.col("row_no") - F.coalesce("_other", F.lit(0))).otherwise(0)
    return marked.withColumn("attempt", attempt).drop("row_no", "_other")
