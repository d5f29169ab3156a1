"""The id filter and the ledger of loads: STR2, STR3, STR5, JOIN1."""

import glob

import pytest
from pyspark.sql import functions as F

from eventmill.operators.normalize import loadable
from eventmill.plans import load
from eventmill.sinks import filters
from eventmill.sinks import tables as sinks
from eventmill.sources import page_log
from eventmill.streaming.ingest import run_stream
from tests.test_load import STAMP, ids, names, pages


def typed(spark, *batches, run="r1"):
    return loadable(load.typed_events(pages(spark, *batches, run=run), STAMP))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def insert(spark, tables, *batches, run="r1", **more):
    return sinks.insert_if_absent(spark, typed(spark, *batches, run=run), tables, filter_from=0, **more)


def test_filter_knows_every_id_and_few_others(spark, tables):
    known = spark.range(20_000).select(F.concat(F.lit("evt-"), "id").alias("id"))
    generation = filters.add(spark, known, 20_000, tables, {})
    asked = spark.range(40_000).select(F.concat(F.lit("evt-"), "id").alias("id"))
    found = filters.flagged(spark, asked, tables, [generation]).groupBy("maybe").count().collect()
    counts = {r["maybe"]: r["count"] for r in found}
    assert counts[True] >= 20_000 and counts[True] + counts[False] == 40_000
    assert counts[True] < 20_100  # 0.5 % of the ids that are not there
    assert all(r["maybe"] for r in filters.flagged(spark, known, tables, [generation]).collect())


def test_generations_grow(spark, tables, monkeypatch):
    monkeypatch.setattr(filters, "FIRST_WORDS", 4)
    assert [filters.room(g) for g in range(3)] == [8, 32, 128]
    for start in range(0, 200, 10):
        assert insert(spark, tables, list(range(start, start + 10)), run=f"r{start}") == 10
    held = sinks.ledger_state(spark, tables).held
    assert len(held) >= 2 and sum(held.values()) <= 200
    assert insert(spark, tables, list(range(195, 205)), run="late") == 5
    assert ids(spark, tables) == names(*range(205))


def test_new_ids_read_no_bucket_and_few_known_ones_their_own(spark, tables):
    insert(spark, tables, list(range(40)))
    rows = typed(spark, [7, 1000, 1001], run="r2")
    assert "ingested_events" not in plan(sinks.new_rows(spark, rows, tables, only=[]))
    (mine,) = spark.table(tables.events).where("id = 'evt-7'").select(F.input_file_name()).first()
    others = [f for f in glob.glob(f"{tables.location}/ingested_events/*.parquet") if not mine.endswith(f)]
    assert len(others) == 3
    for path in others:  # whoever opens one of them fails
        with open(path, "wb") as f:
            f.write(b"no parquet")
    fresh = sinks.new_rows(spark, rows, tables, only=["evt-7"])
    assert sorted(r["id"] for r in fresh.select("id").collect()) == ["evt-1000", "evt-1001"]


def test_insert_is_exact_with_a_filter(spark, tables, monkeypatch):
    assert insert(spark, tables, [1, 2, 2], [3]) == 3
    assert insert(spark, tables, [3, 4], run="r2") == 1
    monkeypatch.setattr(sinks, "FEW_IDS", 1)  # more are looked up in the whole id column
    assert insert(spark, tables, [1, 2, 3, 4, 5], run="r3") == 1
    types = {r["id"]: r["type"] for r in spark.table(tables.events).collect()}
    assert types == {"evt-1": "r1", "evt-2": "r1", "evt-3": "r1", "evt-4": "r2", "evt-5": "r3"}


def test_a_filter_is_built_once_the_table_is_large(spark, tables):
    load.load_pages(spark, pages(spark, [1, 2, 3]), tables, STAMP)
    assert not sinks.ledger_state(spark, tables).held
    assert insert(spark, tables, [3, 4], run="r2") == 1
    assert sum(sinks.ledger_state(spark, tables).held.values()) == 4


def test_a_batch_killed_between_append_and_commit(spark, tables, tmp_path, monkeypatch):
    pages(spark, [1, 2], [3]).write.json(str(tmp_path / "log"))
    read = page_log.stream_pages(spark, str(tmp_path / "log"))
    write = sinks.write_ledger

    def fail(spark_, tables_, version, state, batch, **numbers):
        if state == "done":
            raise RuntimeError("killed")
        write(spark_, tables_, version, state, batch, **numbers)

    monkeypatch.setattr(sinks, "write_ledger", fail)
    with pytest.raises(Exception, match="killed"):
        run_stream(spark, read, tables, str(tmp_path / "offsets"), STAMP).awaitTermination()
    assert ids(spark, tables) == names(1, 2, 3)  # appended, not committed
    assert sinks.ledger_state(spark, tables).total is None
    monkeypatch.setattr(sinks, "write_ledger", write)
    run_stream(spark, read, tables, str(tmp_path / "offsets"), STAMP).awaitTermination()
    assert ids(spark, tables) == names(1, 2, 3)
    assert load.load_checkpoint(spark, tables).first()["events_saved"] == 3
    spark.catalog.refreshTable(tables.ledger)
    last = spark.table(tables.ledger).orderBy(F.desc("version")).first()
    assert (last["state"], last["inserted"], last["total"]) == ("done", 0, 3)
    assert last["batch"].endswith("#0")


def test_totals_are_added_up_not_counted(spark, tables, monkeypatch):
    load.load_pages(spark, pages(spark, [1, 2]), tables, STAMP)
    monkeypatch.setattr(sinks, "row_count", lambda *_: pytest.fail("counted"))
    assert load.load_pages(spark, pages(spark, [2, 3], run="r2"), tables, STAMP).inserted == 1
    assert sinks.events_saved(spark, tables) == 3


def test_files_of_an_append(spark, tables):
    insert(spark, tables, list(range(50)))
    assert len(glob.glob(f"{tables.location}/id_filters/*.parquet")) <= 4
