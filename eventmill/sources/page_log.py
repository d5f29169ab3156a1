"""Scans of the landed page log, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill import schemas

FEED, EVENTS = "feed", "events"


def read_pages(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """Landed pages of one source, or of all.

    A torn line keeps its text in the corrupt-record column, so it can be rejected by name.
    """
    schema = f"{schemas.PAGE_LOG}, {schemas.CORRUPT} STRING"
    pages = spark.read.schema(schema).json(path)
    return pages if source is None else pages.where(F.col("source") == source)


def stream_pages(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """The same scan, page files arriving over time.

    Files are taken in the order they land; the landing job must land them in ``seq`` order.
    Set ``max_bytes`` to bound a micro-batch by size on a backlog of unknown shape.
    """
    schema = f"{schemas.PAGE_LOG}, {schemas.CORRUPT} STRING"
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.json(path)
