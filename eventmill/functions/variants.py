"""Reading loosely typed JSON values the way the source system means them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(value: Column, name: str) -> Column:
    """Member ``name`` of a variant object, still a variant."""
    return F.try_variant_get(value, f"$.{name}", "variant")


def as_text(value: Column) -> Column:
    """Scalar variant as text; null and missing are NULL, the empty string stays."""
    return F.try_variant_get(value, "$", "string")


def as_long(value: Column) -> Column:
    return F.try_variant_get(value, "$", "bigint")


def text_field(value: Column, name: str) -> Column:
    """Scalar member as text; null and missing are NULL, the empty string stays."""
    return F.try_variant_get(value, f"$.{name}", "string")


def looks_nested(text: Column) -> Column:
    """Could this text be that of an object or array?"""
    return F.coalesce(text.startswith("{") | text.startswith("["), F.lit(False))


def is_container(value: Column) -> Column:
    """True for an object or array, false for anything else."""
    kind = F.schema_of_variant(value)
    return F.coalesce(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(False))


def is_truthy(value: Column) -> Column:
    """JavaScript truthiness: false for missing, null, false, zero and the empty string."""
    kind = F.schema_of_variant(value)
    return (
        F.when(value.isNull() | (kind == "VOID"), False)
        .when(kind == "STRING", as_text(value) != "")
        .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .when(is_container(value), True)
        .otherwise(F.coalesce(F.try_variant_get(value, "$", "double") != 0, F.lit(True)))
    )


def truthy_or_null(value: Column) -> Column:
    return F.when(is_truthy(value), value)
