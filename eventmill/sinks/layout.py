"""Physical layouts made after a load: by time, by session, and compacted by id."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from eventmill.session import configure
from eventmill.sinks.tables import Tables, current_layout

_AUTO_BUCKETED_SCAN = "spark.sql.sources.bucketing.autoBucketedScan.enabled"


def write_by_time(events: DataFrame, path: str, partitions: int | None = None) -> None:
    """One folder per day, rows within a file in time order, for time-range scans.

    Range partitioning goes on to ``id``: events with a defaulted time all carry the load
    stamp, and the id lets that one instant be split over many tasks.
    """
    by = ["event_date", "timestamp", "id"]
    ranged = events.repartitionByRange(partitions, *by) if partitions else events.repartitionByRange(*by)
    ranged.sortWithinPartitions(*by).write.mode("overwrite").partitionBy("event_date").parquet(path)


def write_by_session(events: DataFrame, path: str, partitions: int | None = None) -> None:
    """Rows in session order, for lookups by session through file statistics.

    Ranges, not hash buckets, so that a session of any size can be split.
    """
    by = ["session_id", "timestamp", "id"]
    ranged = events.repartitionByRange(partitions, *by) if partitions else events.repartitionByRange(*by)
    ranged.sortWithinPartitions(*by).write.mode("overwrite").parquet(path)


def compact_events(spark: SparkSession, tables: Tables) -> str:
    """Rewrites the event table as one file per bucket and points the table at it.

    Every append adds a file per bucket.  The new files are complete before the table is
    pointed at them, so a failure on the way leaves the table as it was.  Returns the new
    location; the old folder is left for the caller to retire.
    """
    spark.catalog.refreshTable(tables.events)
    detail = spark.sql(f"DESCRIBE EXTENDED {tables.events}").where("col_name = 'Num Buckets'")
    buckets = int(detail.first()["data_type"])
    folder = f"ingested_events-{uuid.uuid4().hex[:12]}"
    location = f"{tables.location}/{folder}"
    shadow = f"{tables.database}.compacted_{uuid.uuid4().hex[:12]}"
    # One task reads one bucket and writes it back: no shuffle.  Left to itself the planner
    # reads file by file, as it sees no join or aggregate that needs the buckets.
    # A session of its own, as the setting would hold for whatever else runs in the caller's.
    own = configure(spark.newSession())
    own.conf.set(_AUTO_BUCKETED_SCAN, "false")
    (
        own.table(tables.events)
        .write.bucketBy(buckets, "id")
        .sortBy("id")
        .option("path", location)
        .saveAsTable(shadow)
    )
    version = current_layout(spark, tables)[1] + 1
    spark.sql(f"INSERT INTO {tables.layouts} VALUES ('{folder}', {version})")
    spark.sql(f"ALTER TABLE {tables.events} SET LOCATION '{location}'")
    # The shadow entry is external: dropping it leaves the files in place.
    spark.sql(f"DROP TABLE {shadow}")
    spark.catalog.refreshTable(tables.events)
    return location
