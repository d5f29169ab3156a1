"""Which ids may be in the event table: Bloom filter bits in a side table, merged load by load.

The filter grows by generations.  Generation g has ``FIRST_WORDS * 4 ** g`` words of 64 bits and takes
two ids a word; an id sets ``BITS`` bits of one word.  A word is a row (or several, one for each load that
set bits in it), named by ``slot``, which holds the generation in its upper bits; the table is bucketed
by it, so looking ids up moves the ids of a load and no part of the filter.  Four bytes an id are read
instead of the ids.

Bits are written before the events they stand for.  A load that fails between the two leaves bits
without events, which cost a look at the table and nothing else.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from eventmill.sinks.tables import Tables

FIRST_WORDS = 1 << 16
IDS_A_WORD = 2
BITS = 5
_GENERATION_SHIFT = 48


def words(generation: int) -> int:
    return FIRST_WORDS << (2 * generation)


def room(generation: int) -> int:
    """Ids a generation takes before the next one begins."""
    return words(generation) * IDS_A_WORD


def slot(id_: Column, generation: int) -> Column:
    first = generation << _GENERATION_SHIFT
    return F.pmod(F.xxhash64(F.lit(generation), id_), F.lit(words(generation))) + F.lit(first).cast("bigint")


def mask(id_: Column) -> Column:
    """The bits an id sets in its words."""
    h = F.xxhash64(F.lit("bits"), id_)
    bits = F.lit(0).cast("bigint")
    for i in range(BITS):
        place = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63).cast("bigint")).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return bits


def flagged(spark: SparkSession, ids: DataFrame, tables: Tables, generations: list[int]) -> DataFrame:
    """Distinct ``ids`` with ``maybe``: true for every id the table holds, and for few others."""
    if not generations:
        return ids.select("id", F.lit(False).alias("maybe"))
    spark.catalog.refreshTable(tables.id_filters)
    places = F.array(*[slot(F.col("id"), g) for g in sorted(generations)])
    asked = ids.select("id", mask(F.col("id")).alias("mask"), F.explode(places).alias("slot"))
    merged = spark.table(tables.id_filters).groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    hit = F.coalesce(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False))
    return asked.join(merged, "slot", "left").groupBy("id").agg(F.bool_or(hit).alias("maybe"))


def add(spark: SparkSession, ids: DataFrame, n: int, tables: Tables, held: dict[int, int]) -> int:
    """Sets the bits of ``n`` distinct ids in the youngest generation, or in a new one if that is full.

    ``held`` is the number of ids by generation; returns the generation.
    """
    generation = max(held, default=0)
    while held.get(generation, 0) >= room(generation) or n > room(generation):
        generation += 1
    if n:
        buckets = bucket_count(spark, tables.id_filters)
        bits = ids.groupBy(slot(F.col("id"), generation).alias("slot")).agg(F.bit_or(mask(F.col("id"))).alias("bits"))
        bits.repartition(buckets, "slot").write.mode("append").insertInto(tables.id_filters)
    return generation


def bucket_count(spark: SparkSession, table: str) -> int:
    detail = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Num Buckets'")
    return int(detail.first()["data_type"])
