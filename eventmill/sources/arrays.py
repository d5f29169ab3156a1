"""Rows from parallel arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, arrays: list[str], keep: list[str] | None = None) -> DataFrame:
    """One row per position; arrays shorter than the longest one pad with NULL."""
    return df.select(*(keep or []), F.inline(F.arrays_zip(*arrays)))
