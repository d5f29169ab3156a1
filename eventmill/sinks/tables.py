"""The event, checkpoint and reject tables and the writes into them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventmill import schemas
from eventmill.operators.dedup import absent_from, first_wins
from eventmill.sinks import filters
from eventmill.sources.tables import target_ids


#: Ids that may be known, up to which they are looked up by name.
FEW_IDS = 2000
#: Rows from which the event table has an id filter; below, its id column is read sooner than one.
FILTER_FROM = 20_000_000


@dataclass(frozen=True)
class Tables:
    """Names of one set of tables.

    ``stage`` is a folder the loads may overwrite.  One writer per set: two concurrent loads
    could both find an id absent.
    """

    database: str
    location: str

    @property
    def events(self) -> str:
        return f"{self.database}.ingested_events"

    @property
    def checkpoints(self) -> str:
        return f"{self.database}.ingestion_checkpoints"

    @property
    def rejects(self) -> str:
        return f"{self.database}.rejects"

    @property
    def layouts(self) -> str:
        return f"{self.database}.layouts"

    @property
    def ledger(self) -> str:
        return f"{self.database}.ledger"

    @property
    def id_filters(self) -> str:
        return f"{self.database}.id_filters"

    @property
    def stage(self) -> str:
        return f"{self.location}/stage"


def create_tables(
    spark: SparkSession, database: str, location: str, buckets: int | None = None
) -> Tables:
    """Creates what does not exist yet; existing tables keep their data.

    The event table is bucketed and sorted by id, so looking for known ids moves none of it.
    That holds while loads run with as many shuffle partitions as there are buckets, which is
    the default; the result is the same otherwise.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables = Tables(database, location.rstrip("/"))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{tables.location}/db'")
    for table, ddl, folder in (
        (tables.checkpoints, schemas.CHECKPOINTS, "ingestion_checkpoints"),
        (tables.rejects, schemas.REJECTS, "rejects"),
        (tables.layouts, schemas.LAYOUTS, "layouts"),
        (tables.ledger, schemas.LEDGER, "ledger"),
    ):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet "
            f"LOCATION '{tables.location}/{folder}'"
        )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {tables.id_filters} ({schemas.ID_FILTERS}) USING parquet "
        f"CLUSTERED BY (slot) SORTED BY (slot) INTO {buckets} BUCKETS LOCATION '{tables.location}/id_filters'"
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {tables.events} ({schemas.EVENTS}) USING parquet "
        f"CLUSTERED BY (id) SORTED BY (id) INTO {buckets} BUCKETS "
        f"LOCATION '{tables.location}/{current_layout(spark, tables)[0]}'"
    )
    return tables


def current_layout(spark: SparkSession, tables: Tables) -> tuple[str, int]:
    """Folder and version of the event table's files.

    Kept with the data, so that tables made anew in a catalog that forgets find the files of
    the last compaction.
    """
    spark.catalog.refreshTable(tables.layouts)
    last = spark.table(tables.layouts).agg(F.max_by("folder", "version"), F.max("version")).first()
    return ("ingested_events", 0) if last[1] is None else (last[0], last[1])


def overwrite_stage(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Replaces a staging folder and reads it back.

    Besides what staging is for, this cuts the lineage on shared storage: several outputs are
    derived without parsing the pages again, and a lost executor costs its tasks only.
    """
    writer = df.write.mode("overwrite")
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return read_stage(df.sparkSession, path, df.schema)


def read_stage(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def new_rows(
    spark: SparkSession,
    events: DataFrame,
    tables: Tables,
    narrow_by: DataFrame | None = None,
    only: list[str] | None = None,
) -> DataFrame:
    """First arrival per id, without the ids the event table holds.

    ``only`` names the few incoming ids that the table may hold: just their buckets are read, and in
    those just the row groups whose range they fall into.  ``narrow_by`` (any frame with the incoming ids)
    bounds the table scan by the smallest and largest of them instead, which pays when ids grow over time.
    """
    known = target_ids(spark, tables.events)
    if only is not None:
        known = known.where(F.col("id").isin(only))
    elif narrow_by is not None:
        low, high = narrow_by.agg(F.min("id"), F.max("id")).first()
        known = known.where((F.col("id") >= low) & (F.col("id") <= high))
    return absent_from(first_wins(events), known).select(*schemas.EVENT_COLUMNS)


def insert_if_absent(
    spark: SparkSession,
    events: DataFrame,
    tables: Tables,
    narrow_by: DataFrame | None = None,
    staged: bool = False,
    batch: str | None = None,
    filter_from: int | None = None,
) -> int:
    """Appends events whose id is not in the table yet; returns how many that were.

    In a table of ``filter_from`` rows or more, the id filter tells which ids the table may hold.  If
    they are few, only their buckets are looked at; if they are many, as in a replay, the whole id
    column is.  Either way the search itself is exact.  With a filter, events that are not ``staged`` are,
    as they are then read more than once.

    The ledger notes the load before and after the append, with the rows the table then holds, so
    these are added up and not counted, except after a load that broke off in between.  Appended rows
    are counted while they are written.  They pass the counter in the writing stage, whose tasks are
    counted once however often they are retried.
    """
    state = ledger_state(spark, tables)
    base = row_count(spark, tables) if state.total is None else state.total
    only: list[str] | None = None if base else []
    generation = n = None
    if base >= (FILTER_FROM if filter_from is None else filter_from):
        events = events if staged else overwrite_stage(events, f"{tables.stage}/incoming")
        held = state.held
        if base and not held:  # the table has grown to that size, or is older than its filter
            first = filters.add(spark, target_ids(spark, tables.events), base, tables, held)
            held = {first: base}
            write_ledger(spark, tables, state.version, "filter", None, generation=first, ids=base)
        asked = filters.flagged(spark, events.select("id").distinct(), tables, list(held))
        asked = overwrite_stage(asked, f"{tables.stage}/asked")
        few = asked.where("maybe").limit(FEW_IDS + 1).agg(F.collect_list("id")).first()[0]
        only = few if len(few) <= FEW_IDS else None
        unknown = asked.where("NOT maybe").select("id")
        n = unknown.count()
        generation = filters.add(spark, unknown, n, tables, held)
    write_ledger(spark, tables, state.version + 1, "open", batch, generation=generation, ids=n)
    seen = Observation()
    fresh = new_rows(spark, events, tables, narrow_by, only).observe(seen, F.count("*").alias("n"))
    fresh.write.mode("append").insertInto(tables.events)
    inserted = int(seen.get.get("n", 0))
    write_ledger(spark, tables, state.version + 2, "done", batch, inserted=inserted, total=base + inserted)
    return inserted


@dataclass(frozen=True)
class LedgerState:
    """``total`` is None if the last load did not end; ``held`` are the filter's ids by generation."""

    version: int
    total: int | None
    held: dict[int, int]


def ledger_state(spark: SparkSession, tables: Tables) -> LedgerState:
    spark.catalog.refreshTable(tables.ledger)
    ledger = spark.table(tables.ledger)
    last = F.max(F.when(F.col("state") != "filter", F.struct("version", "state", "total")))
    parts = ledger.groupBy("generation").agg(F.sum("ids").alias("ids"), last.alias("last"))
    known = F.when(F.col("generation").isNotNull(), F.struct("generation", "ids"))
    row = parts.agg(F.max("last").alias("last"), F.map_from_entries(F.collect_list(known)).alias("held")).first()
    if row["last"] is None:
        return LedgerState(-1, None, row["held"] or {})
    ended = row["last"]["state"] == "done"
    return LedgerState(row["last"]["version"], row["last"]["total"] if ended else None, row["held"] or {})


def write_ledger(
    spark: SparkSession, tables: Tables, version: int, state: str, batch: str | None, **numbers: int | None
) -> None:
    values = {"version": version, "state": state, "batch": batch, **numbers}
    kinds = dict(part.split() for part in schemas.LEDGER.split(", "))
    row = spark.range(1).select(*[F.lit(values.get(name)).cast(kind).alias(name) for name, kind in kinds.items()])
    row.coalesce(1).write.mode("append").insertInto(tables.ledger)


def row_count(spark: SparkSession, tables: Tables) -> int:
    spark.catalog.refreshTable(tables.events)
    return spark.table(tables.events).agg(F.count("*")).first()[0]


def events_saved(spark: SparkSession, tables: Tables) -> int:
    """Rows of the event table as the ledger has them; counted only where a load broke off."""
    total = ledger_state(spark, tables).total
    return row_count(spark, tables) if total is None else total


def append_rejects(
    spark: SparkSession, rejects: DataFrame, tables: Tables, ingest_ts: Column
) -> int:
    """Adds rejects that are not recorded yet, so a replay records none twice; returns how many.

    Raw text and file are part of the key: lines that could not be read have nothing else, and
    equal ones may come again in another file.
    """
    if "file" not in rejects.columns:
        rejects = rejects.withColumn("file", F.lit(None).cast("string"))
    spark.catalog.refreshTable(tables.rejects)
    key = ["run_id", "source", "seq", "pos", "reason", "file"]
    known = spark.table(tables.rejects).select(*key, "raw_hash").alias("old")
    same = F.lit(True)
    for c in [*key, "raw_hash"]:
        same = same & F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}"))
    written = Observation()
    (
        rejects.withColumn("ingested_at", ingest_ts)
        .withColumn("raw_hash", F.xxhash64("raw"))
        .alias("new")
        .join(known, same, "left_anti")
        .select(*schemas.REJECT_COLUMNS)
        .observe(written, F.count("*").alias("n"))
        .write.mode("append")
        .insertInto(tables.rejects)
    )
    return int(written.get.get("n", 0))


def save_checkpoint(
    spark: SparkSession, tables: Tables, state: DataFrame, version: int
) -> None:
    """Appends the state of ``state`` (``cursor, events_saved``, one row); the last write wins.

    ``version`` orders writes that share a clock reading.
    """
    state.select(
        F.lit(1).alias("id"),
        "cursor",
        F.col("events_saved").cast("bigint"),
        F.current_timestamp().alias("updated_at"),
        F.lit(version).cast("bigint").alias("version"),
    ).coalesce(1).write.mode("append").insertInto(tables.checkpoints)
    spark.catalog.refreshTable(tables.checkpoints)
