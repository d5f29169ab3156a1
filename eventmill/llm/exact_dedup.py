"""Exact deduplication with a heavy-hitter split.  DataFrame functions only.

A Misra-Gries pass (``freqItems``) finds every digest that a share of ``support`` or more of the
rows may have; it keeps at most ``1 / support`` counters in each task.  Their rows are then
counted exactly and their winners chosen by a partial aggregate, and the verified winners, at most
``1 / support`` rows, are broadcast: rows of frequent texts are decided where they lie.  Only the
other rows are shuffled by digest, and none of their groups holds more than that share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmill.llm.common import keyed, stage, without


def mark(
    docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", row_key: str | None = None, support: float = 0.001
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Equal texts form a group; a null text counts as empty.  The row with the largest id stays, a
    null id being the smallest; of repeated rows with that id exactly one stays.  An empty table
    gives no rows.  Other columns are left out, whatever their names, but for a ``row_key`` that tells
    rows apart.
    """
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    key = F.col(row_key) if row_key else F.monotonically_increasing_id()
    staged = stage(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.unhex(digest).alias("digest"),
            F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint").alias("key"),
            key.alias("rid"),
        ),
        "digests",
    )
    candidate = F.struct("doc_id", "rid")
    total = staged.count()
    frequent = staged.stat.freqItems(["key"], support).select(F.explode("key_freqItems").alias("key"))
    verified = stage(
        staged.select("doc_id", "digest", "key", "rid")
        .join(F.broadcast(frequent), "key")
        .groupBy("digest")
        .agg(F.max(candidate).alias("best"), F.count("*").alias("group_size"))
        .filter(F.col("group_size") >= support * total),
        "frequent",
    )
    known = staged.join(F.broadcast(verified), "digest", "left")
    same = Window.partitionBy("digest")
    rest = (
        known.filter("group_size IS NULL")
        .withColumn("best", F.max(candidate).over(same))
        .withColumn("group_size", F.count("*").over(same))
    )
    return (
        known.filter("group_size IS NOT NULL")
        .unionByName(rest)
        .select(
            "doc_id",
            F.col("best.doc_id").alias("keep_id"),
            "group_size",
            (F.col("rid") == F.col("best.rid")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
            *([F.col("rid").alias(row_key)] if row_key else []),
        )
    )


def keep(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", **names) -> DataFrame:
    """The rows that stay, with the columns of the input.  Texts stay where they are; ids and digests move."""
    rows = keyed(docs)
    flat = rows.select("row_key", F.col(f"row.`{text}`").alias("text"), F.col(f"row.`{doc_id}`").alias("doc_id"))
    marked = mark(flat, row_key="row_key", **names)
    return without(rows, stage(marked.filter("NOT kept").select("row_key"), "copies"), "row_key").select("row.*")
