"""Landed session pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill import schemas
from eventmill.functions.variants import text_field
from eventmill.sources.envelope import PAGE_KEY, bad_bodies, decode, flatten

_TYPES = dict(column.split() for column in schemas.SESSION.split(", "))


def _reason(record: Column) -> Column:
    """Why a record is no session; NULL for those that are."""
    no_object = ~F.coalesce(F.schema_of_variant(record).startswith("OBJECT"), F.lit(False))
    return F.when(no_object, "bad_type").when(text_field(record, "id").isNull(), "no_id")


def read_sessions(pages: DataFrame) -> DataFrame:
    """Session records of landed pages, one row each, in arrival order.

    A member of another type than its column is NULL.  Bodies that are no page, and records that
    are no object or have no id, are in ``rejected_sessions``.
    """
    members = [F.try_variant_get("e", f"$.{name}", kind.lower()).alias(name) for name, kind in _TYPES.items()]
    return flatten(decode(pages)).where(_reason(F.col("e")).isNull()).select(*PAGE_KEY, "pos", *members)


def rejected_sessions(pages: DataFrame) -> DataFrame:
    """What ``read_sessions`` leaves out, as rejects: page key, pos, reason, raw."""
    decoded = decode(pages)
    records = (
        flatten(decoded)
        .withColumn("reason", _reason(F.col("e")))
        .where(F.col("reason").isNotNull())
        .select(*PAGE_KEY, "pos", "reason", F.to_json("e").alias("raw"))
    )
    return records.unionByName(bad_bodies(decoded))
