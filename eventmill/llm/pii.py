"""Personal data: patterns propose spans, validators confirm, nearby words adjust a score.

DataFrame functions only.  Quantifiers that cannot give characters back with profit are
possessive, and a pattern that starts with a run of characters starts only where such a run does
(or where the last match ended), so that long runs cost linear time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.llm.common import find_spans, let


@dataclass(frozen=True)
class Kind:
    """``needs`` is text without which the pattern cannot match, a cheap test before it.

    A span's score is ``score``, plus ``boost`` when a word of ``context`` lies within ``NEAR``
    characters; spans below ``THRESHOLD`` are left out.  Kinds with a score of 1 always stay.
    """

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    needs: str | None = None
    score: float = 1.0
    boost: float = 0.0
    context: str | None = None


NEAR = 40
THRESHOLD = 0.5


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Sum of digits from the right, every second one doubled (9 taken off above 9), ends in 0."""
    each = F.transform(
        F.split(F.reverse(number), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(each, F.lit(0), lambda total, x: total + x) % 10 == 0


def mod97(account: Column) -> Column:
    """First four characters moved to the end, letters as 10 to 35: the remainder by 97 is 1."""
    moved = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))
    rest = F.aggregate(
        F.split(moved, ""),
        F.lit(0),
        lambda r, c: F.when(c.between("0", "9"), (r * 10 + c.cast("int")) % 97).otherwise(
            (r * 100 + F.ascii(c) - 55) % 97
        ),
    )
    return rest == 1


def card(match: Column) -> Column:
    return let(digits(match), lambda d: F.length(d).between(16, 19) & luhn(d))


def ip(match: Column) -> Column:
    return F.forall(
        F.split(match, "\\."), lambda part: part.rlike("^0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")
    )


def phone(match: Column) -> Column:
    return F.length(digits(match)).between(8, 15)


def any_match(match: Column) -> Column:
    return F.lit(True)


LOCAL, HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: The first four are the base kinds; their order is that of the output.
KINDS = (
    Kind("email", f"(?:\\G|(?<!{LOCAL})){LOCAL}++@{HOST}++(?:\\.{HOST}++)++", any_match, "@"),
    Kind("ip", "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++", ip),
    Kind("card", "[0-9](?:[\\x20-]?[0-9])++", card),
    Kind("phone", "\\+[0-9][\\x20().0-9-]+[0-9]", phone, "+"),
    Kind(
        "iban", "(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])", mod97,
        score=0.6, boost=0.4, context="(?i)iban|account|bank|konto|compte|cuenta",
    ),
    Kind(
        "ssn", "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", any_match,
        score=0.2, boost=0.6, context="(?i)ssn|social security|tax",
    ),
)
BASE = KINDS[:4]


def kind_spans(text: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind: (kind, start, end, match, score)."""
    found = F.filter(find_spans(text, kind.pattern), lambda s: kind.valid(s["match"]))

    def score(s):
        if kind.context is None:
            return F.lit(kind.score)
        begin = F.greatest(s["start"] - NEAR, F.lit(0))
        near = F.substr(text, (begin + 1).cast("int"), (s["end"] + NEAR - begin).cast("int"))
        return F.lit(kind.score) + F.when(near.rlike(kind.context), kind.boost).otherwise(0.0)

    spans = F.filter(
        F.transform(
            found,
            lambda s: F.struct(
                F.lit(kind.name).alias("kind"), s["start"], s["end"], s["match"], score(s).alias("score")
            ),
        ),
        lambda s: s["score"] >= THRESHOLD,
    )
    kind_type = "array<struct<kind:string,start:bigint,end:bigint,match:string,score:double>>"
    if kind.needs:
        spans = F.when(F.contains(text, F.lit(kind.needs)), spans).otherwise(F.array().cast(kind_type))
    return spans


def find(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id and ``found``, an array of spans for each kind by name.

    A null text is empty and has none; repeated rows and null ids are kept; an empty table gives
    no rows.  Other columns are left out, whatever their names.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Every pattern starts with a digit or needs a sign: most texts have neither.
    return plain.select(
        "doc_id", F.struct(*[kind_spans(F.col("text"), k).alias(k.name) for k in KINDS]).alias("found")
    )


def joined(found: Column, kinds: tuple[Kind, ...]) -> Column:
    """kind:start:end of all spans, by kind as listed, then start."""
    every = F.concat(*[found[k.name] for k in kinds])
    return F.array_join(F.transform(every, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
