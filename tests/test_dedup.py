"""First arrival wins, absent rows, backfill, attempts: DED1, JOIN1, SET1, SET2."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from eventmill.operators import dedup

SCHEMA = "id string, run_id string, source string, seq long, pos int, v string"


def rows(spark, *values):
    return spark.createDataFrame([(i, r, "feed", s, p, v) for i, r, s, p, v in values], SCHEMA)


def kept(df):
    return sorted((r["id"], r["v"]) for r in df.collect())


def test_first_wins_within_page_between_pages_and_runs(spark):
    df = rows(
        spark, ("a", "r1", 0, 1, "second"), ("a", "r1", 0, 0, "first"), ("b", "r1", 2, 0, "late"),
        ("b", "r1", 1, 5, "early"), ("c", "r2", 0, 0, "run2"), ("c", "r1", 9, 9, "run1"),
    )
    assert kept(dedup.first_wins(df.repartition(3))) == [("a", "first"), ("b", "early"), ("c", "run1")]


def test_hot_id_is_cut_down_before_the_shuffle(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.lit("r").alias("run_id"), F.lit("feed").alias("source"), F.col("id").alias("seq"),
        F.lit(0).alias("pos"), F.lit("v").alias("v"),
    ).repartition(4)
    out = dedup.first_wins(df)
    assert out.count() == 20_001
    assert out.where("id = 'hot'").first()["seq"] == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    partial = next(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line)
    shuffle = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(id" in line)
    assert shuffle < partial


def test_absent_from(spark):
    df = rows(spark, ("a", "r", 0, 0, "x"), ("b", "r", 0, 1, "y"))
    known = spark.createDataFrame([("a", 1)], "id string, other int")
    assert kept(dedup.absent_from(df, known)) == [("b", "y")]
    assert kept(dedup.absent_from(df, known.where("false"))) == [("a", "x"), ("b", "y")]


def timed(spark, source, *values):
    at = [(i, "r", source, s, 0, v, datetime.fromtimestamp(t / 1000, timezone.utc)) for i, s, v, t in values]
    return spark.createDataFrame(at, SCHEMA + ", timestamp timestamp").withColumn("ts_defaulted", F.lit(False))


@pytest.fixture
def feed(spark):
    return timed(spark, "feed", ("a", 0, "feed", 1000), ("b", 1, "feed", 5500))


@pytest.fixture
def fallback(spark):
    return timed(
        spark, "events", ("a", 0, "fb", 5600), ("c", 1, "fb", 4999), ("d", 2, "fb", 5000), ("e", 3, "fb", 9000)
    )


def test_backfill_from_the_second_of_the_latest_event(feed, fallback):
    out = kept(dedup.backfill(feed, fallback, target_count=10))
    assert out == [("a", "feed"), ("b", "feed"), ("d", "fb"), ("e", "fb")]


def test_no_backfill_once_the_target_is_met(feed, fallback):
    assert kept(dedup.backfill(feed, fallback, target_count=2)) == [("a", "feed"), ("b", "feed")]


def test_load_stamps_move_no_bound_and_are_not_cut(spark, feed, fallback):
    stamped = feed.unionByName(timed(spark, "feed", ("z", 2, "feed", 99_000)).withColumn("ts_defaulted", F.lit(True)))
    late = fallback.withColumn("ts_defaulted", F.col("id") == "c")
    out = kept(dedup.backfill(stamped, late, target_count=10))
    assert out == [("a", "feed"), ("b", "feed"), ("c", "fb"), ("d", "fb"), ("e", "fb"), ("z", "feed")]


def test_backfill_of_nothing_takes_all(feed, fallback):
    assert len(kept(dedup.backfill(feed.where("false"), fallback, 10))) == 4


def test_replays_of_an_attempt_change_nothing(spark):
    first = rows(spark, ("a", "r1", 0, 0, "1"), ("b", "r1", 0, 1, "1"))
    second = rows(spark, ("b", "r0", 0, 0, "2"), ("c", "r0", 0, 1, "2"))
    once = kept(dedup.union_attempts([first, second]))
    assert once == [("a", "1"), ("b", "1"), ("c", "2")]
    assert kept(dedup.union_attempts([first, second, first, second, second])) == once
