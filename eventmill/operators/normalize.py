"""Raw events to typed rows, and the split of rows that cannot be loaded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill import schemas
from eventmill.functions.timestamps import date_text, number_ms, out_of_range, to_timestamp, utc_date
from eventmill.functions.variants import (
    field,
    is_container,
    looks_nested,
    text_field,
    truthy_or_null,
)
from eventmill.sources.envelope import PAGE_KEY

# Column of the event table -> member of the raw event.
TEXT_FIELDS = {"id": "id", "session_id": "sessionId", "type": "type", "user_id": "userId"}


def normalize(events: DataFrame, ingest_ts: Column) -> DataFrame:
    """Typed event rows plus ``reason``, which is NULL for rows that can be loaded.

    ``ingest_ts`` is the load stamp and stands in for a missing or unreadable event time.
    """
    e = F.col("e")
    started = [c for c in ("run_started",) if c in events.columns]
    # Step by step, so that no step extracts a member twice.
    split = events.select(
        *PAGE_KEY,
        *started,
        "pos",
        "e",
        *[text_field(e, member).alias(name) for name, member in TEXT_FIELDS.items()],
        field(e, "timestamp").alias("_ts"),
        field(e, "properties").alias("_props"),
    )
    # Types are looked up only for the few rows with a text that could be a nested value.
    suspicious, nested = F.lit(False), F.lit(False)
    for name, member in TEXT_FIELDS.items():
        suspicious = suspicious | looks_nested(F.col(name))
        nested = nested | is_container(field(e, member))
    read = split.select(
        *PAGE_KEY,
        *started,
        "pos",
        *TEXT_FIELDS,
        number_ms(F.col("_ts")).alias("_ms"),
        date_text(F.col("_ts")).alias("_date_text"),
        truthy_or_null(F.col("_props")).alias("properties"),
        e.alias("raw"),
        F.when(suspicious, nested).otherwise(False).alias("_nested"),
    )
    typed = read.withColumns(
        {
            "_event_ts": to_timestamp(F.col("_ms"), F.col("_date_text")),
            "reason": F.when(F.col("id").isNull(), "no_id")
            .when(F.col("_nested"), "bad_type")
            .when(out_of_range(F.col("_ms")), "ts_range"),
        }
    )
    timestamp = F.coalesce("_event_ts", ingest_ts)
    return typed.select(
        *TEXT_FIELDS,
        timestamp.alias("timestamp"),
        "properties",
        "raw",
        ingest_ts.alias("ingested_at"),
        F.col("_event_ts").isNull().alias("ts_defaulted"),
        utc_date(timestamp).alias("event_date"),
        "source",
        "run_id",
        "seq",
        "pos",
        "reason",
        *started,
    )


def loadable(rows: DataFrame) -> DataFrame:
    """Rows for the event table, with the start of their run where a load has added it."""
    started = [c for c in ("run_started",) if c in rows.columns]
    return rows.where(F.col("reason").isNull()).select(*schemas.EVENT_COLUMNS, *started)


def rejected(rows: DataFrame) -> DataFrame:
    """Rows that cannot be loaded, with the reason and the raw event as JSON text."""
    return rows.where(F.col("reason").isNotNull()).select(
        *PAGE_KEY, "pos", "reason", F.to_json("raw").alias("raw")
    )
