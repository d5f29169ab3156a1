"""Chat formatting by schema fingerprints.  DataFrame functions only.

A record's fingerprint is the hash of the nested field paths that it fills.  A table from
fingerprints to declarative mappings (which path gives which role's text) selects how a record
becomes canonical turns; a layout stands there once for each subset of its optional fields.
Turns are formatted one row each, so a conversation of any length is spread over tasks until it
is assembled.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn.  Control strings inside a role
or text get a backslash after their first character, and such strings that hold backslashes
there already get one more, so taking one off restores the text exactly.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
#: Control strings of this and other common templates (fixed values), cut after the first character.
CONTROL = "\\|[A-Za-z0-9_]+\\|>|/?s>|/?INST\\]"


@dataclass(frozen=True)
class Layout:
    """``turns``: (role, path) in order; ``each``: array of structs with a role and a text field."""

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    turns: tuple[tuple[str, str], ...] = ()
    each: tuple[str, str, str] | None = None
    row: tuple[str, str] | None = None


LAYOUTS = (
    Layout("turn rows", (), ("role", "text"), row=("role", "text")),
    Layout("messages", ("messages[].role",), ("messages[].content", "system"),
           (("system", "system"),), each=("messages", "role", "content")),
    Layout("shared conversations", ("conversations[].from",), ("conversations[].value", "system"),
           (("system", "system"),), each=("conversations", "from", "value")),
    Layout("instruction", ("instruction",), ("input", "output", "system"),
           (("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("prompt", ("prompt",), ("completion", "response", "system"),
           (("system", "system"), ("user", "prompt"), ("assistant", "completion"), ("assistant", "response"))),
    Layout("question", ("question",), ("answer", "context"),
           (("system", "context"), ("user", "question"), ("assistant", "answer"))),
)
#: Names that other layouts use for the roles (fixed values).
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
PATHS = sorted({p for x in LAYOUTS for p in (*x.required, *x.optional)})


def paths_hash(paths: tuple[str, ...]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def mappings() -> dict[str, Layout]:
    """Fingerprint to layout; where two layouts give the same paths, the first listed counts."""
    found: dict[str, Layout] = {}
    for layout in LAYOUTS:
        for n in range(len(layout.optional) + 1):
            for more in combinations(layout.optional, n):
                found.setdefault(paths_hash((*layout.required, *more)), layout)
    return found


def value(schema: T.StructType, path: str) -> Column | None:
    """The column of a path without arrays, if the schema has it as text."""
    if path in schema.fieldNames() and isinstance(schema[path].dataType, T.StringType):
        return F.col(f"`{path}`")
    return None


def fills(schema: T.StructType, path: str) -> Column | None:
    """Whether a record has a value at the path; None when the schema has no such path."""
    outer, nested, field = path.partition("[].")
    if not nested:
        column = value(schema, path)
        return None if column is None else column.isNotNull()
    if outer not in schema.fieldNames():
        return None
    kind = schema[outer].dataType
    inside = kind.elementType if isinstance(kind, T.ArrayType) else None
    if not isinstance(inside, T.StructType) or field not in inside.fieldNames():
        return None
    return F.coalesce(F.exists(F.col(f"`{outer}`"), lambda x: x[field].isNotNull()), F.lit(False))


def fingerprint(schema: T.StructType, paths: list[str]) -> Column:
    """Hash of those of the paths that a record fills, in order of name."""
    present = [F.when(test, F.lit(p)) for p in paths if (test := fills(schema, p)) is not None]
    return F.sha2(F.concat_ws("\n", *present), 256)


def canonical(records: DataFrame, conv_id: str = "conv_id", order: str | None = None) -> DataFrame:
    """Turns (conv_id, turn, part, role, text, layout) of records in any of the layouts.

    ``order`` names the column by which the records of one conversation follow each other; ``part``
    counts the turns inside a record.  In a table with role and text columns, a record that fills one
    of them is a turn row, whatever else it fills; a record that no other layout fits is one as soon
    as the table has either column.  Any other record that no layout fits gives one row whose layout
    is null, and stays visible as a row without segment.  Roles and texts that are null become empty, except that
    the absent optional parts of a layout give no turn.  Columns with other names do not matter.
    """
    schema = records.schema
    kind = "array<struct<role:string,text:string>>"

    def turns(layout: Layout) -> Column:
        if layout.row:
            role, text = (value(schema, p) for p in layout.row)
            none = F.lit("")
            return F.array(
                F.struct(
                    (none if role is None else F.coalesce(role, none)).alias("role"),
                    (none if text is None else F.coalesce(text, none)).alias("text"),
                )
            ).cast(kind)
        single = [
            F.when(c.isNotNull(), F.struct(F.lit(role).alias("role"), c.alias("text")))
            for role, path in layout.turns
            if (c := value(schema, path)) is not None
        ]
        parts = F.filter(F.array(*single).cast(kind), lambda t: t.isNotNull())
        if layout.each and fills(schema, f"{layout.each[0]}[].{layout.each[1]}") is not None:
            name, role, text = layout.each
            has_text = fills(schema, f"{name}[].{text}") is not None
            renamed = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
            parts = F.concat(
                parts,
                F.transform(
                    F.col(f"`{name}`"),
                    lambda x: F.struct(
                        F.coalesce(F.try_element_at(renamed, x[role]), x[role], F.lit("")).alias("role"),
                        F.coalesce(x[text], F.lit("")).alias("text") if has_text else F.lit("").alias("text"),
                    ),
                ).cast(kind),
            )
        return parts

    table = mappings()
    name = F.create_map(*[F.lit(x) for h, y in table.items() for x in (h, y.name)])
    usable = [
        x
        for x in LAYOUTS
        if all(fills(schema, p) is not None for p in x.required)
        and (x.row is None or any(value(schema, p) is not None for p in x.row))
    ]
    chosen = F.try_element_at(name, fingerprint(schema, PATHS))
    row = next(x for x in LAYOUTS if x.row)
    given = [t for p in row.row if (t := fills(schema, p)) is not None]
    if given:
        others = [p for p in PATHS if p not in row.row]
        fitting = F.coalesce(F.try_element_at(name, fingerprint(schema, others)), F.lit(row.name))
        chosen = F.when(given[0] | given[1], F.lit(row.name)).otherwise(fitting) if len(given) > 1 else fitting
    chosen = F.when(chosen.isin([x.name for x in usable]), chosen)
    picked = F.lit(None).cast(kind)
    for layout in reversed(usable):
        picked = F.when(F.col("__layout") == layout.name, turns(layout)).otherwise(picked)
    position = F.col(order).cast("bigint") if order else F.lit(0).cast("bigint")
    return (
        records.withColumn("__layout", chosen)
        .select(
            F.col(conv_id).alias("conv_id"),
            position.alias("turn"),
            F.col("__layout").alias("layout"),
            F.posexplode_outer(picked).alias("part", "t"),
        )
        .select("conv_id", "turn", "part", "t.role", "t.text", "layout")
    )


def escape(text: Column) -> Column:
    return F.regexp_replace(text, f"([<\\[])(\\\\*)({CONTROL})", "$1\\\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, f"([<\\[])\\\\(\\\\*)({CONTROL})", "$1$2$3")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    # An escaped role holds no line break, so breaks can stand for doubled backslashes meanwhile.
    pieces = F.split(F.replace(unescape(role), F.lit("\\\\"), F.lit("\n")), "\n")
    return F.array_join(F.transform(pieces, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def format_turns(turns: DataFrame) -> DataFrame:
    """Segments (conv_id, turn, part, segment, loss_start, loss_end): one formatted turn each.

    The loss mask covers an assistant's text: code points of the segment, end exclusive; null for
    other roles.  A conversation's formatted text is its segments in order of turn and part.  A record
    that no layout fits keeps its row, with a null segment.
    """
    role, text = escape_role(F.col("role")), escape(F.col("text"))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    loss = F.col("role") == "assistant"
    return turns.filter("role IS NOT NULL OR layout IS NULL").select(
        "conv_id",
        "turn",
        "part",
        F.concat(head, text, F.lit(f"{END}\n")).alias("segment"),
        F.when(loss, F.length(head)).cast("bigint").alias("loss_start"),
        F.when(loss, F.length(head) + F.length(text)).cast("bigint").alias("loss_end"),
    )


def read_back(segments: DataFrame) -> DataFrame:
    """Turns parsed from formatted segments alone, with the text that the loss mask covers."""
    body = F.substr("segment", F.lit(len(START) + 1), F.length("segment") - len(START) - len(END) - 1)
    head = F.substring_index(F.col("body"), "\n", 1)
    return segments.withColumn("body", body).select(
        "conv_id",
        "turn",
        "part",
        unescape_role(head).alias("role"),
        unescape(F.substr("body", F.length(head) + 2)).alias("text"),
        F.when(
            F.col("loss_start").isNotNull(),
            unescape(
                F.substr(
                    "segment", F.col("loss_start").cast("int") + 1, (F.col("loss_end") - F.col("loss_start")).cast("int")
                )
            ),
        ).alias("loss_text"),
        F.length("segment").alias("chars"),
    )


def assemble(segments: DataFrame) -> DataFrame:
    """Training examples: conv_id, formatted text.  An example is one row, so it must fit one."""
    return segments.filter("segment IS NOT NULL").groupBy("conv_id").agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("turn", "part", "segment"))), lambda s: s["segment"]
            ),
            "",
        ).alias("formatted")
    )
