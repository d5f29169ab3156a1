"""Text and number formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARK = "\\N"


def copy_escape(value: Column) -> Column:
    r"""COPY text form of a value: ``\``, TAB, LF, CR escaped (backslash first), NULL as ``\N``."""
    escaped = value
    for raw, mark in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(mark))
    return F.coalesce(escaped, F.lit(NULL_MARK))


def mask_secret(value: Column) -> Column:
    """First four characters, dots, last four characters."""
    return F.concat(F.left(value, F.lit(4)), F.lit("..."), F.right(value, F.lit(4)))


def path_bucket(path: Column) -> Column:
    """Rate-limit bucket of a request path: 36-character ids become ``:id``."""
    return F.regexp_replace(path, "/[0-9a-f-]{36}", "/:id")


def header_int(headers: Column, name: str) -> Column:
    """Leading integer of a header, NULL when missing or not a number.

    Header names are matched without regard to case; of several spellings the first counts.
    """
    named = F.filter(F.map_entries(headers), lambda e: F.lower(e["key"]) == name)
    return leading_int(F.get(named, F.lit(0))["value"])


def leading_int(value: Column) -> Column:
    """``"10;w=60"`` is 10, ``"abc"`` is NULL."""
    return F.regexp_extract(value, r"^\s*([+-]?[0-9]+)", 1).try_cast("bigint")


def round_half_up(value: Column) -> Column:
    """Nearest integer, halves towards positive infinity."""
    return F.floor(value + F.lit(0.5)).cast("bigint")


def fixed1(value: Column) -> Column:
    """Text with one decimal."""
    return F.format_string("%.1f", value.cast("double"))


def grouped(value: Column) -> Column:
    """Integer text with thousands separators."""
    return F.format_number(value, 0)


def backoff_ms(attempt: Column, cap_ms: int | None = 10_000) -> Column:
    """Expected wait before the retry that follows ``attempt`` (1-based): doubles from 1 s."""
    # 2^53 s is far beyond any cap, so the exponent is bounded before it can overflow.
    wait = (F.pow(F.lit(2.0), F.least(attempt - 1, F.lit(43))) * 1000).cast("bigint")
    return wait if cap_ms is None else F.least(wait, F.lit(cap_ms).cast("bigint"))


def run_retry_ms(attempt: Column) -> Column:
    """Wait between two attempts of a whole run: five seconds per attempt so far."""
    return (attempt * F.lit(5000)).cast("bigint")
