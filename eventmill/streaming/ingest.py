"""Loading landed pages as they arrive."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventmill.plans.load import as_column, load_staged, stage_pages
from eventmill.session import configure
from eventmill.sinks.tables import Tables, events_saved, save_checkpoint
from eventmill.sources.envelope import headers


def run_stream(
    spark: SparkSession,
    pages: DataFrame,
    tables: Tables,
    checkpoint_location: str,
    ingest_ts: datetime | Column | None = None,
    narrow_by_id: bool = False,
    every: str | None = None,
    filter_from: int | None = None,
) -> StreamingQuery:
    """Starts loading everything that has landed, then ends; run it again for what came since.
    With ``every`` (such as ``"1 minute"``) it goes on instead, at that interval.

    A batch is written before its offset is committed, so a failure between the two replays the
    batch, and the replay inserts nothing: each id once, whatever is repeated.  The ledger then tells
    that a load broke off, and rows are counted instead of added up.  No watermark: an
    event of any age is taken.  A new ``checkpoint_location`` replays everything, as harmlessly.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        session = configure(batch.sparkSession)
        stamp = as_column(ingest_ts)
        staged, _ = stage_pages(session, batch, tables, stamp)
        name = f"{checkpoint_location}#{batch_id}"
        load_staged(
            session, staged, tables, stamp, narrow_by_id=narrow_by_id, batch=name, filter_from=filter_from
        )
        save_progress(session, staged, tables, batch_id)

    return (
        pages.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint_location)
        .trigger(**({"processingTime": every} if every else {"availableNow": True}))
        .start()
    )


def save_progress(spark: SparkSession, staged: DataFrame, tables: Tables, version: int) -> None:
    """Appends the resume cursor of the last page staged and the events saved so far."""
    saved = F.lit(events_saved(spark, tables)).cast("bigint")
    resume = F.when(F.col("source") == "feed", F.col("next_cursor")).otherwise(
        F.col("request_cursor")
    )
    state = headers(staged).agg(F.max_by(resume, F.struct("requested_at", "seq")).alias("cursor"))
    save_checkpoint(spark, tables, state.withColumn("events_saved", saved), version)


def dedup_within(events: DataFrame, delay: str) -> DataFrame:
    """Streaming dedup with bounded state, for readers that may miss copies older than ``delay``.

    The load itself does not use this: its state is the event table.
    """
    return events.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["id"])
