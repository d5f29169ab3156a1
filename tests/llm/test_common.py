"""Row names and the removal of rows by them."""

import pytest
from pyspark.sql import functions as F

from eventmill.llm import common, exact_dedup

ROWS = [(i % 50 if i % 7 else None, f"t{i % 40}" if i % 9 else None, "x", i) for i in range(200)]
SCHEMA = "doc_id long, text string, row_key string, row long"


def test_rows_of_files_have_one_name_at_every_reading(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).repartition(5).write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    first, again = (
        {bytes(r["row_key"]): r["row"] for r in common.keyed(d).collect()} for d in (docs, docs.select("*"))
    )
    assert first == again and len(first) == 200


def test_other_rows_are_written_first(spark):
    keyed = common.keyed(spark.createDataFrame(ROWS, SCHEMA).groupBy("doc_id", "text").agg(F.count("*").alias("n")))
    assert keyed.select("row_key").distinct().count() == keyed.count() > 0


@pytest.mark.parametrize("map_rows", [1, 1 << 18])
def test_without_is_exact_however_full_the_map(spark, monkeypatch, map_rows):
    monkeypatch.setattr(common, "MAP_ROWS", map_rows)
    rows = spark.range(3000).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    left = common.without(rows, spark.range(0, 3000, 3).select(F.col("id").alias("k")), "k")
    assert left.columns == ["k", "v"]
    assert sorted(r["k"] for r in left.collect()) == [i for i in range(3000) if i % 3]


def test_exactly_one_of_each_text_stays(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    kept = exact_dedup.keep(docs)
    assert kept.columns == docs.columns
    best = {}
    for doc_id, text, _, _ in ROWS:
        key = text or ""
        best[key] = max(best.get(key, -1), -1 if doc_id is None else doc_id)
    got = {(r["text"] or ""): -1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()}
    assert got == best and kept.count() == len(best)
