"""Scans of the loaded tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.functions.timestamps import utc_date


def time_range(
    events: DataFrame, since_ms: int | Column | None = None, until_ms: int | Column | None = None
) -> DataFrame:
    """Events with ``since <= timestamp < until``, bounds in epoch milliseconds.

    Where the table carries ``event_date`` the days are bounded as well, so a date-partitioned
    layout is pruned; Spark cannot infer that bound from the timestamp by itself.
    """
    for bound, is_lower in ((since_ms, True), (until_ms, False)):
        if bound is None:
            continue
        at = F.timestamp_millis(bound if isinstance(bound, Column) else F.lit(bound).cast("bigint"))
        ts = F.col("timestamp")
        events = events.where(ts >= at if is_lower else ts < at)
        if "event_date" in events.columns:
            day = F.col("event_date")
            events = events.where(day >= utc_date(at) if is_lower else day <= utc_date(at))
    return events


def lookup_checkpoint(state: DataFrame) -> DataFrame:
    """The one checkpoint row, or no row when nothing was saved yet."""
    return state.where(F.col("id") == 1)


def target_ids(spark: SparkSession, table: str) -> DataFrame:
    """The id column of the event table, re-read from its current files."""
    spark.catalog.refreshTable(table)
    return spark.table(table).select("id")
