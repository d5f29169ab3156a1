"""Each id once: first arrival wins, within a batch and against the loaded table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Column that a load adds: when the event's run made its first request.
STARTED = "run_started"


def arrival(events: DataFrame) -> list[str | Column]:
    """Arrival order: runs as they started, the feed before the fallback, pages, events in a page.

    Without start times, runs follow each other by id.
    """
    started = [STARTED] if STARTED in events.columns else []
    fallback = F.when(F.col("source") == "feed", 0).otherwise(1)
    return [*started, "run_id", fallback, "seq", "pos"]


def first_wins(events: DataFrame, order: list[str | Column] | None = None) -> DataFrame:
    """One row per id, the earliest in ``order``, by default that of arrival.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so each map task
    sends one row per id: an id that holds a third of the input costs a few rows, not one
    huge task.
    """
    first = F.row_number().over(W.partitionBy("id").orderBy(*(order or arrival(events))))
    return events.withColumn("_rn", first).where(F.col("_rn") == 1).drop("_rn")


def absent_from(events: DataFrame, target_ids: DataFrame) -> DataFrame:
    """Rows whose id the target does not hold yet.

    After ``first_wins`` the rows are already partitioned by id.  A target bucketed by id into
    as many buckets as there are shuffle partitions is joined without moving either side.
    """
    return events.join(target_ids.select("id"), "id", "left_anti")


def backfill(feed: DataFrame, fallback: DataFrame, target_count: int) -> DataFrame:
    """Feed events, and fallback events from the feed's latest time on if the feed is short.

    The feed wins an id both sources hold.  ``feed`` must be one row per id already.  Its count
    and latest time reach the fallback scan as scalar subqueries, so that scan can skip data.
    The latest time is cut to the second, as the fallback is asked in whole seconds.  Load stamps
    are no event times: they move no bound, and fallback events without a time are taken always.
    """
    own = F.when(~F.col("ts_defaulted"), F.col("timestamp"))
    count = feed.agg(F.count("*")).scalar()
    since = feed.agg(F.date_trunc("second", F.max(own))).scalar()
    late = fallback.where(count < target_count).where(
        F.col("ts_defaulted")
        | (F.col("timestamp") >= F.coalesce(since, F.timestamp_millis(F.lit(-62_135_596_800_000))))
    )
    ranked = feed.withColumn("_rank", F.lit(0)).unionByName(late.withColumn("_rank", F.lit(1)))
    return first_wins(ranked, ["_rank", *arrival(ranked)]).drop("_rank")


def union_attempts(attempts: list[DataFrame]) -> DataFrame:
    """Several attempts over overlapping ranges as one table: earlier attempts win.

    However often an attempt is repeated, the result is that of the first.
    """
    rows = attempts[0].withColumn("_attempt", F.lit(0))
    for i, attempt in enumerate(attempts[1:], start=1):
        rows = rows.unionByName(attempt.withColumn("_attempt", F.lit(i)))
    return first_wins(rows, ["_attempt", *arrival(rows)]).drop("_attempt")
