"""Normalising the event time: epoch milliseconds, epoch seconds, or date text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventmill.functions.variants import as_text

# A number above this is milliseconds, anything else is seconds;
# and the largest distance from the epoch a date can have, in milliseconds.
MS_THRESHOLD = 1e12
MAX_ABS_MS = 8.64e15

# Numeric variant types as schema_of_variant names them.
_NUMERIC = "^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)"

# Date text is UTC unless it names a zone, whatever the session time zone is.
_ZONE = r"(Z|[+-][0-9]{2}:?[0-9]{2})?$"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
_SECONDS = _DAY + r"[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?" + _ZONE
_MINUTES = _DAY + r"[T ][0-9]{2}:[0-9]{2}" + _ZONE

# Other date texts accepted, as (shape, text to remove, pattern).
OTHER_FORMATS = [
    (r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$", "", "y/M/d X"),
    (r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", "", "y-M-d X"),
    (r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2} [0-9]{1,2}:[0-9]{2}$", "", "y/M/d H:mm X"),
    (r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2} [0-9]{1,2}:[0-9]{2}:[0-9]{2}$", "", "y/M/d H:mm:ss X"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "", "M/d/y X"),
    (r"^[A-Z][a-z]{2} [0-9]{1,2},? [0-9]{4}$", ",", "MMM d y X"),
    (r"^[0-9]{1,2} [A-Z][a-z]{2} [0-9]{4}$", "", "d MMM y X"),
    (r"^[A-Z][a-z]{2} [0-9]{1,2},? [0-9]{4} [0-9]{1,2}:[0-9]{2}:[0-9]{2}$", ",", "MMM d y H:mm:ss X"),
    (
        r"^[A-Z][a-z]{2}, [0-9]{1,2} [A-Z][a-z]{2} [0-9]{4} [0-9:]{8} GMT$",
        r"^[A-Za-z]{3}, | GMT$",
        "d MMM y HH:mm:ss X",
    ),
    (
        r"^[A-Z][a-z]{2} [A-Z][a-z]{2} [0-9]{1,2} [0-9]{4} [0-9:]{8} GMT\+0000$",
        r"^[A-Za-z]{3} | GMT\+0000$",
        "MMM d y HH:mm:ss X",
    ),
]
YEAR_FIRST = [f for f in OTHER_FORMATS if f[2].startswith("y")]


def _in_utc(text: Column) -> Column:
    zoned = text.rlike("(Z|[+-][0-9]{2}:?[0-9]{2})$")
    return F.when(zoned, text).otherwise(F.concat(text, F.lit("Z"))).try_cast("timestamp")


def parse_text(text: Column) -> Column:
    """Date text to TIMESTAMP, NULL if it is not one of the accepted shapes.

    The shape is tested before anything is parsed: a cast alone would take a bare ``12:30`` for
    a time of today, and the shapes that are left are rare enough to cost little.
    """
    return (
        F.when(text.rlike(_SECONDS), _in_utc(text))
        .when(text.rlike("^[0-9]{4}"), _short_iso(text))
        .otherwise(_other(text))
    )


def _short_iso(text: Column) -> Column:
    midnight = F.lit("T00:00:00Z")
    parsed = (
        F.when(text.rlike(_MINUTES), _in_utc(F.regexp_replace(text, "([T ].{5})", "$1:00")))
        .when(text.rlike(_DAY + "$"), F.concat(text, midnight).try_cast("timestamp"))
        .when(text.rlike("^.{4}-[0-9]{2}$"), F.concat(text, F.lit("-01"), midnight).try_cast("timestamp"))
        .when(text.rlike("^.{4}$"), F.concat(text, F.lit("-01-01"), midnight).try_cast("timestamp"))
    )
    return _by_pattern(parsed, text, YEAR_FIRST)


def _other(text: Column) -> Column:
    return _by_pattern(F, text, [f for f in OTHER_FORMATS if f not in YEAR_FIRST])


def _by_pattern(cases, text: Column, formats: list[tuple[str, str, str]]) -> Column:
    for shape, strip, pattern in formats:
        body = F.regexp_replace(text, strip, "") if strip else text
        zoned = F.concat(body, F.lit(" Z"))
        cases = cases.when(text.rlike(shape), F.try_to_timestamp(zoned, F.lit(pattern)))
    return cases


def number_ms(value: Column) -> Column:
    """Milliseconds a number stands for; NULL unless the variant is a number.

    The type is tested, not cast: a cast would read ``true`` as 1 and take digits in quotes.
    """
    number = F.try_variant_get(value, "$", "double")
    ms = F.when(number > F.lit(MS_THRESHOLD), number).otherwise(number * F.lit(1000.0))
    return F.when(F.schema_of_variant(value).rlike(_NUMERIC), ms)


def date_text(value: Column) -> Column:
    """The text of a text variant, else NULL."""
    return F.when(F.schema_of_variant(value) == "STRING", as_text(value))


def in_range(ms: Column) -> Column:
    return F.abs(ms) <= F.lit(MAX_ABS_MS)


def out_of_range(ms: Column) -> Column:
    """A number no date can hold: the source refuses such an event, so we reject it."""
    return F.coalesce(~in_range(ms), F.lit(False))


def to_timestamp(ms: Column, text: Column) -> Column:
    """Event time from ``number_ms`` or ``date_text``, cut to milliseconds; NULL if neither is one."""
    from_number = F.when(in_range(ms), F.timestamp_millis(ms.cast("bigint")))
    return F.coalesce(from_number, F.timestamp_millis(F.unix_millis(parse_text(text))))


def parse_timestamp(value: Column) -> Column:
    """Event time of a variant, NULL when it has none."""
    return to_timestamp(number_ms(value), date_text(value))


def iso_text(ts: Column) -> Column:
    """``YYYY-MM-DDTHH:mm:ss.SSSZ`` (the session time zone must be UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def utc_date(ts: Column) -> Column:
    """Calendar day in UTC, independent of the session time zone."""
    return F.date_from_unix_date(F.floor(F.unix_millis(ts) / F.lit(86_400_000)).cast("int"))
