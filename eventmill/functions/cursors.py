"""Decoding pagination cursors (base64 of a JSON object)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventmill.functions.variants import as_long, as_text, field


def cursor_variant(cursor: Column) -> Column:
    """The JSON inside a cursor, NULL when the cursor is not base64 of JSON."""
    return F.try_parse_json(F.try_to_binary(cursor, F.lit("base64")).try_cast("string"))


def decode_cursor(cursor: Column) -> Column:
    """``STRUCT<id, ts, v, exp>`` of a cursor; members are NULL when it cannot be decoded."""
    value = cursor_variant(cursor)
    return F.struct(
        as_text(field(value, "id")).alias("id"),
        as_long(field(value, "ts")).alias("ts"),
        as_long(field(value, "v")).alias("v"),
        as_long(field(value, "exp")).alias("exp"),
    )


def cursor_expired(cursor: Column, now_ms: Column) -> Column:
    """NULL when the cursor names no expiry."""
    return as_long(field(cursor_variant(cursor), "exp")) < now_ms
