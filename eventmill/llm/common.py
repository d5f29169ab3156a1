"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.session import scratch_dir

#: White space between words (fixed value): space, and tab to carriage return.
GAP = "[\\x20\\x09-\\x0D]+"

#: Characters of GAP.
BLANKS = " \t\n\x0b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body).getItem(0)


def words(text: Column) -> Column:
    """Words of a text, split at ``GAP``."""
    return F.filter(F.split(text, GAP), lambda w: w != "")


def stage(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write to the cluster's shared folder and read again.

    That cuts the lineage: a lost executor costs its own tasks only, and row numbers given
    before the write stay as they are.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of 64 bits, at most, in the table that is broadcast to leave most rows unmoved.
MAP_ROWS = 1 << 18


def keyed(docs: DataFrame) -> DataFrame:
    """(row_key, row): each row as a struct, with a name of 16 bytes that is the same at every reading.

    Rows that are read from files are named by file and place there; nothing is written.  Others are
    written once, as a plan with a shuffle may give its rows in another order each time.
    """

    def named(df: DataFrame, row) -> DataFrame:
        place = [F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")]
        key = F.unhex(F.concat(*[F.lpad(F.hex(x), 16, "0") for x in place]))
        return df.select(key.alias("row_key"), row.alias("row"))

    if "_metadata" not in docs.columns:
        try:
            return named(docs, F.struct("*"))
        except AnalysisException:  # not read from files, or from several sources
            pass
    return named(stage(docs.select(F.struct("*").alias("row")), "rows"), F.col("row"))


def without(rows: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is not among the ``dropped`` ones; only few others are shuffled.

    Dropped keys are marked in a bit map of bounded size.  A fuller map sends more rows through the
    join behind it, and changes nothing else.  ``rows`` is read twice.
    """
    place = F.pmod(F.xxhash64(key), F.lit(MAP_ROWS))
    bit = F.pmod(F.xxhash64(F.lit(1), key), F.lit(64)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    bits = F.broadcast(dropped.groupBy(place.alias("map_row")).agg(F.bit_or(one).alias("bits")))
    marked = rows.withColumn("map_row", place).join(bits, "map_row", "left")
    maybe = F.coalesce(F.getbit("bits", bit) == 1, F.lit(False))
    rest = marked.filter(maybe).select(*rows.columns).join(dropped.select(key), key, "left_anti")
    return marked.filter(~maybe).select(*rows.columns).unionByName(rest)


def join_split(rows: DataFrame, values: DataFrame, keys: list[str], total: int, *, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``values``, whose ``n`` counts the rows of each of its keys.

    Keys are unique in ``values`` and null keys match.  Those that a thousandth or more of the ``total``
    rows have, at most a thousand, are broadcast, so their rows stay where they are; only the others
    are shuffled by key.  ``rows`` is read twice and should be a written table.
    """
    often = F.col("n") * 1000 >= total
    names = [c for c in values.columns if c not in (*keys, "n")]
    hot = stage(values.filter(often), "frequent-keys")

    def same(v: DataFrame):
        return [F.col(f"r.{k}").eqNullSafe(F.col(f"v.{k}")) for k in keys]

    def joined(left: DataFrame, right: DataFrame, kind: str) -> DataFrame:
        wide = left.alias("r").join(right.alias("v"), same(right), kind)
        return wide.select("r.*", *[F.col(f"v.{c}") for c in names])

    few = F.broadcast(hot)
    rest = rows.alias("r").join(few.alias("v"), same(few), "left_anti")
    return joined(rows, few, "inner").unionByName(joined(rest, values.filter(~often), how))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def running_sum(values: Column) -> Column:
    """Sums up to and including each item of an array of bigint.

    Blocks of 256 keep the copying of a growing array from becoming quadratic.
    """
    zero = F.struct(F.array().cast("array<bigint>").alias("sums"), F.lit(0).cast("bigint").alias("total"))

    def grow(acc, x):
        return F.struct(
            F.array_append(acc["sums"], acc["total"] + x).alias("sums"), (acc["total"] + x).alias("total")
        )

    def cut(items):
        n = F.ceil(F.size(items) / 256).cast("int")
        return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(
            let(
                F.transform(
                    F.sequence(F.lit(0), n - 1),
                    lambda b: F.aggregate(F.slice(items, b * 256 + 1, F.lit(256)), zero, grow),
                ),
                lambda parts: let(
                    F.aggregate(F.transform(parts, lambda p: p["total"]), zero, grow)["sums"],
                    lambda ends: F.flatten(
                        F.transform(
                            parts,
                            lambda p, i: F.transform(
                                p["sums"], lambda x: x + F.get(ends, i) - p["total"]
                            ),
                        )
                    ),
                ),
            )
        )

    return let(values, cut)


def find_spans(text: Column, pattern: str) -> Column:
    """Matches of a pattern as array of (start, end, match), in code points, end exclusive.

    Splitting at the pattern and extracting it walk the same matches, so the lengths of the
    pieces between and of the matches themselves add up to the positions.
    """
    empty = F.array().cast("array<struct<start:bigint,end:bigint,match:string>>")

    def place(gaps, hits):
        lengths = F.transform(
            hits, lambda h, i: (F.length(F.get(gaps, i)) + F.length(h)).cast("bigint")
        )
        return let(
            running_sum(lengths),
            lambda ends: F.transform(
                hits,
                lambda h, i: F.struct(
                    (F.get(ends, i) - F.length(h)).alias("start"),
                    F.get(ends, i).alias("end"),
                    h.alias("match"),
                ),
            ),
        )

    return let(
        F.regexp_extract_all(text, F.lit(f"({pattern})"), 1),
        lambda hits: F.when(F.size(hits) == 0, empty).otherwise(
            let(F.split(text, pattern, -1), lambda gaps: place(gaps, hits))
        ),
    )
