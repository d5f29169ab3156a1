"""Text exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from eventmill.functions.text import copy_escape
from eventmill.functions.timestamps import iso_text


def export_ids(events: DataFrame, path: str, max_records_per_file: int = 0) -> int:
    """All ids in binary order, one per line; returns their number.

    The sort is a range exchange: part files, taken by name, concatenate in order.
    """
    seen = Observation()
    (
        events.select("id")
        .orderBy("id")
        .observe(seen, F.count("*").alias("n"))
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .text(path)
    )
    return int(seen.get.get("n", 0))


def copy_line(*values: Column) -> Column:
    """One COPY text row: escaped values, TAB between them."""
    return F.concat_ws("\t", *[copy_escape(v) for v in values])


def copy_rows(events: DataFrame) -> DataFrame:
    """The seven payload columns as COPY text, column ``value``."""
    return events.select(
        copy_line(
            F.col("id"),
            F.col("session_id"),
            F.col("type"),
            F.col("user_id"),
            iso_text(F.col("timestamp")),
            F.to_json("properties"),
            F.to_json("raw"),
        ).alias("value")
    )


def export_copy_text(events: DataFrame, path: str) -> None:
    copy_rows(events).write.mode("overwrite").option("lineSep", "\n").text(path)
