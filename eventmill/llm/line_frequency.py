"""Quality rules with cross-document line frequency.  DataFrame functions only.

Lines are normalised (lower case, one space between words) and hashed.  For each host, here the
document's source, distinct texts that hold a line are counted; exact copies count once, as they
are another operator's work.  A line that more than ``max_share`` of a host's texts hold, or more
than ``most_texts`` of them however large the host, and at least ``min_texts``, is removed from all
but one of them (the one with the smallest digest), so that no content leaves the corpus altogether.  A document that loses more than
``max_lost`` of its words is depleted and rejected.

The verdict depends on host and text alone, so rows are joined by host and digest and no row
number is needed.  Hot lines and hot hosts are pre-aggregated before each shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.llm.common import BLANKS, GAP, let, stage, words

MIN_WORDS = 50
#: Characters that count as symbols (fixed value).
SYMBOLS = "#*$%&|<>"


def repeated_words(ws: Column) -> Column:
    """Words that lie in a window of three words found twice or more in the text."""

    def covered(hashes):
        def positions(by_hash):
            twice = F.filter(
                by_hash,
                lambda x, i: (x["h"] == F.get(by_hash, i - 1)["h"]) | (x["h"] == F.get(by_hash, i + 1)["h"]),
            )
            return F.sort_array(F.transform(twice, lambda x: x["p"]))

        def count(at):
            return F.aggregate(
                F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3)))),
                F.lit(0).cast("bigint"),
                lambda total, x: total + x,
            )

        by_hash = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(
            let(by_hash, lambda s: let(positions(s), count))
        )

    windows = F.transform(
        F.sequence(F.lit(0), F.size(ws) - 3),
        lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)),
    )
    return F.when(F.size(ws) < 3, F.lit(0).cast("bigint")).otherwise(let(windows, covered))


def line_keys(text: Column) -> Column:
    """For each line split at \\n: hash of its normalised form and its number of words."""
    plain = F.lower(F.trim(F.regexp_replace(text, "[\\x20\\x09\\x0B-\\x0D]+", " ")))
    return F.transform(
        F.split(plain, "\\x20?\\n\\x20?"),
        lambda x: F.struct(
            F.xxhash64(x).alias("line"),
            F.when(x == "", 0).otherwise(F.size(F.split(x, " "))).alias("n"),
        ),
    )


def base_columns(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text."""

    def build(ws):
        lines = F.filter(F.split(text, "\\n"), lambda x: F.translate(x, BLANKS, "") != "")
        return F.struct(
            F.size(ws).cast("bigint").alias("n_words"),
            F.length(F.translate(text, BLANKS, "")).cast("bigint").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")).alias("n_dup_lines"),
            repeated_words(ws).alias("n_repeat_words"),
        )

    return let(words(text), build)


def removed_lines(
    texts: DataFrame, *, max_share: float = 0.25, min_texts: int = 20, most_texts: int = 30
) -> DataFrame:
    """For each host and digest with lines to remove: their positions ``at`` and words ``lost``.

    ``texts`` has host, digest and text; rows with equal host and digest count once.
    """
    lines = stage(
        texts.select("host", "digest", F.posexplode(line_keys(F.col("text"))).alias("at", "key"))
        .select("host", "digest", "at", "key.line", "key.n")
        .filter("n > 0"),
        "lines",
    )
    held = lines.select("host", "line", "digest").distinct()
    of_host = lines.select("host", "digest").distinct().groupBy("host").agg(F.count("*").alias("texts"))
    frequent = stage(
        held.groupBy("host", "line")
        .agg(F.count("*").alias("held_by"), F.min("digest").alias("keeper"))
        .filter(F.col("held_by") >= min_texts)
        .alias("l")
        .join(of_host.alias("h"), F.expr("l.host <=> h.host"))
        .filter(F.col("held_by") > F.least(max_share * F.col("texts"), F.lit(most_texts)))
        .select("l.host", "line", "keeper"),
        "frequent-lines",
    )
    return stage(
        lines.alias("l")
        .join(frequent.alias("f"), F.expr("l.host <=> f.host AND l.line = f.line AND l.digest <> f.keeper"))
        .select("l.host", "l.digest", "at", "n")
        .distinct()
        .groupBy("host", "digest")
        .agg(F.sum("n").alias("lost"), F.sort_array(F.collect_list("at")).alias("at")),
        "removed",
    )


def judge(
    docs: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    host: str = "source",
    max_share: float = 0.25,
    min_texts: int = 20,
    most_texts: int = 30,
    max_lost: float = 0.7,
) -> DataFrame:
    """One row per document with the base counts, the verdict, the words lost and the struct ``row``.

    A null text has no words and fails the base rule; a null host is a host of its own.  Equal
    rows get equal verdicts.  An empty table gives no rows.  Extra columns travel in ``row``.
    """
    whole = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(host).alias("host"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("digest"),
        F.struct("*").alias("row"),
    )
    removed = removed_lines(
        whole.select("host", "digest", "text"), max_share=max_share, min_texts=min_texts, most_texts=most_texts
    )
    return (
        whole.withColumn("base", base_columns(F.col("text")))
        .alias("d")
        .join(removed.alias("r"), F.expr("d.host <=> r.host AND d.digest = r.digest"), "left")
        .select(
            "doc_id",
            "base.*",
            F.coalesce("lost", F.lit(0)).cast("bigint").alias("n_lost_words"),
            F.col("at").alias("lost_lines"),
            "row",
        )
        .withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words"))
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_lost_words") <= max_lost * F.col("n_words")))
    )


def clean(docs: DataFrame, *, text: str = "text", n_chars: str = "n_chars", **names) -> DataFrame:
    """The documents kept, without their removed lines, with the columns of the input."""

    def without(lines, at):
        return F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), at), lambda i: F.get(lines, i)
            ),
            "\n",
        )

    judged = judge(docs, text=text, **names).filter("kept")
    old = F.col(f"row.`{text}`")
    new = F.when(F.col("lost_lines").isNull(), old).otherwise(
        let(F.split(old, "\\n"), lambda lines: without(lines, F.col("lost_lines")))
    )
    row = F.col("row").withField(f"`{text}`", new)
    if n_chars in docs.columns:
        kind = docs.schema[n_chars].dataType
        row = row.withField(
            f"`{n_chars}`",
            F.when(F.col("lost_lines").isNull(), F.col(f"row.`{n_chars}`")).otherwise(F.length(new).cast(kind)),
        )
    return judged.select(row.alias("row")).select("row.*")
