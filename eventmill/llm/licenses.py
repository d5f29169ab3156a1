"""License scan: phrases, and an exact containment join of text blocks with license notices.

DataFrame functions only.  A block is a line, or the whole text with its line breaks as spaces, cut
into overlapping windows where it is long; so a notice wrapped over lines stands in one block.  It
meets a template when it holds at least ``threshold`` of the template's distinct words, all of them if
the template has ``SHORT`` or fewer; among them all that tell licenses apart, and none of those that
name another license of the family.  Words are ordered by their frequency in the corpus, rarest first, so that:

* prefix filter: a block that shares ``need`` words with a template of ``size`` words has one of
  the template's ``size - need + 1`` rarest words, at a place that leaves room in the block;
* length filter: a block with fewer than ``need`` words of the templates' vocabulary is out;
* positional filter: after the first shared word, both sides must have words enough left.

What passes is checked word by word, so the filters lose nothing.  Words outside the templates
cannot be shared and are left out of blocks.  Everything broadcast has the size of the templates,
which is checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.llm.common import let, stage

#: Phrases and their labels (fixed values).
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Notices as they stand in files (fixed values), and their labels.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the "
                 "license at http www apache org licenses license 2 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "you can redistribute it and or modify it under the terms of the gnu general public license as "
              "published by the free software foundation either version 3 of the license"),
    ("gpl-2", "under the terms of the gnu general public license as published by the free software foundation "
              "version 2"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
)

#: Words of a template that a block must hold, and those that it may hold only if the template does (fixed values).
TELLING = ("mit", "apache", "gnu", "mozilla", "cc", "attribution", "version", "v", "2", "3")
FAMILY = ("lesser", "affero", "sharealike", "noncommercial", "noderivatives", "nc", "nd", "sa")
#: Templates of so many different words are met by all of them only.
SHORT = 8

MAX_TEMPLATE_WORDS = 10_000
WINDOW = 64


def plain(text: Column) -> Column:
    """A-Z in lower case; words joined by one space, with one at either end; line breaks kept."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.concat(
        F.lit(" "), F.regexp_replace(lowered, "[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", " "), F.lit(" ")
    )


def spaced(lines: Column) -> Column:
    return F.regexp_replace(lines, "[\\x20\\n]+", " ")


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def phrase_columns(norm: Column) -> Column:
    """Struct of n_words, n_base, first_word, last_word and labels of the phrases."""

    def one(phrase: str) -> Column:
        mark = f" {phrase} "
        back = F.reverse(norm)
        size = len(phrase.split())
        first = spaces(F.substr(norm, F.lit(1), F.instr(norm, mark))) - 1
        after = spaces(F.substr(back, F.lit(1), F.instr(back, mark[::-1]))) - 1
        found = F.struct(
            (F.size(F.split(norm, f" {phrase}(?= )")) - 1).cast("bigint").alias("n"),
            first.cast("bigint").alias("first"),
            (spaces(norm) - 1 - after - size).cast("bigint").alias("last"),
            F.lit(PHRASES[phrase]).alias("label"),
        )
        return F.when(F.contains(norm, F.lit(mark)), found)

    found = F.filter(F.array(*[one(p) for p in PHRASES]), lambda x: x.isNotNull())
    return let(
        found,
        lambda x: F.struct(
            F.greatest(spaces(norm) - 1, F.lit(0)).cast("bigint").alias("n_words"),
            F.aggregate(x, F.lit(0).cast("bigint"), lambda n, y: n + y["n"]).alias("n_base"),
            F.array_min(F.transform(x, lambda y: y["first"])).alias("first_word"),
            F.array_max(F.transform(x, lambda y: y["last"])).alias("last_word"),
            F.transform(x, lambda y: y["label"]).alias("base"),
        ),
    )


def windows(line: Column) -> Column:
    """A line's words, as one block or as overlapping windows of ``WINDOW`` words."""
    half = WINDOW // 2
    return let(
        F.filter(F.split(line, " "), lambda w: w != ""),
        lambda ws: F.transform(
            F.sequence(F.lit(0), F.greatest(F.ceil(F.size(ws) / half) - 2, F.lit(0)).cast("int")),
            lambda i: F.array_distinct(F.slice(ws, i * half + 1, F.lit(WINDOW))),
        ),
    )


def needed(size: int, threshold: float) -> int:
    return size if size <= SHORT else -int(-threshold * size // 1)


def markers(words: list[str]) -> tuple[list[str], list[str]]:
    """Words that a block must hold to meet the template of these words, and those that it must not."""
    return [w for w in words if w in TELLING + FAMILY], [w for w in FAMILY if w not in words]


def contained(
    texts: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = 0.8
) -> DataFrame:
    """(digest, label, score): the best containment of each label that some block of a text reaches.

    ``texts`` has digest and lines, the latter from ``plain``; equal digests count as one text.
    """
    sets = [(i, label, sorted(set(text.split()))) for i, (label, text) in enumerate(templates)]
    if sum(len(ws) for _, _, ws in sets) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates hold more than {MAX_TEMPLATE_WORDS} words, too many to broadcast")
    if any(len(ws) > WINDOW // 2 for _, _, ws in sets):
        raise ValueError(f"a template may have {WINDOW // 2} different words, half a window")
    spark = texts.sparkSession
    vocabulary = sorted({w for _, _, ws in sets for w in ws} | set(FAMILY))
    known = F.array(*[F.lit(w) for w in vocabulary])
    seen = (
        texts.select(F.explode(F.array_intersect(F.split(F.col("lines"), "[\\x20\\n]+"), known)).alias("word"))
        .groupBy("word")
        .count()
    )
    counts = {r["word"]: r["count"] for r in seen.collect()}  # a row for each word of the templates at most
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}

    prefixes = []
    for i, label, ws in sets:
        need = needed(len(ws), threshold)
        ranks = sorted(rank[w] for w in ws)
        must, never = ([rank[w] for w in words] for words in markers(ws))
        prefixes += [
            (i, label, r, at, len(ws), need, ranks, must, never)
            for at, r in enumerate(ranks[: len(ws) - need + 1])
        ]
    index = spark.createDataFrame(
        prefixes,
        "template int, label string, word int, at int, size int, need int, ranks array<int>, "
        "must array<int>, never array<int>",
    )
    least = min(p[5] for p in prefixes)
    rare = sorted({order[p[2]] for p in prefixes})
    ordered = F.array(*[F.lit(w) for w in order])
    has_rare = F.col("lines").rlike("[\\x20\\n](" + "|".join(rare) + ")[\\x20\\n]")

    def ranked(block: Column) -> Column:
        shared = F.array_intersect(block, ordered)
        return F.array_sort(F.transform(shared, lambda w: (F.array_position(ordered, w) - 1).cast("int")))

    blocks = (
        texts.filter(has_rare)
        .select("digest", F.explode(F.array_union(F.split("lines", "\\n"), F.array(spaced(F.col("lines"))))).alias("line"))
        .filter(F.concat(F.lit(" "), "line", F.lit(" ")).rlike("\\x20(" + "|".join(rare) + ")\\x20"))
        .select("digest", F.explode(windows(F.col("line"))).alias("block"))
        .select("digest", ranked(F.col("block")).alias("block"))
        .filter(F.size("block") >= least)
    )
    candidates = (
        blocks.select("digest", "block", F.posexplode("block").alias("place", "word"))
        .filter(F.col("place") <= F.size("block") - least)
        .join(F.broadcast(index), "word")
        .filter(F.size("block") >= F.col("need"))
        .filter(F.least(F.size("block") - F.col("place"), F.col("size") - F.col("at")) >= F.col("need"))
    )
    shared = F.size(F.array_intersect("block", "ranks"))
    return (
        candidates.filter(shared >= F.col("need"))
        .filter((F.size(F.array_intersect("block", "must")) == F.size("must")) & ~F.arrays_overlap("block", "never"))
        .groupBy("digest", "label")
        .agg(F.max(shared / F.col("size")).alias("score"))
    )


def scan(
    docs: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = 0.8,
) -> DataFrame:
    """One row per document: counts and places of the phrases, base_labels, labels and score.

    A null text is empty: no words, no labels, score 0.  The score is 1 where a phrase stands, or
    the best containment.  Equal rows get equal results; an empty table gives no rows.  Other
    columns are left out, whatever their names.
    """
    plain_text = F.coalesce(F.col(text), F.lit(""))
    lines = docs.select(
        F.col(doc_id).alias("doc_id"), F.unhex(F.md5(plain_text)).alias("digest"), plain(plain_text).alias("lines")
    )
    hits = stage(
        contained(lines, templates, threshold)
        .groupBy("digest")
        .agg(F.collect_set("label").alias("more"), F.max("score").alias("best")),
        "licenses",
    )
    based = lines.select("doc_id", "digest", let(spaced(F.col("lines")), phrase_columns).alias("f"))
    return based.join(hits, "digest", "left").select(
        "doc_id",
        "f.n_words",
        "f.n_base",
        "f.first_word",
        "f.last_word",
        F.array_join(F.array_sort(F.array_distinct("f.base")), ",").alias("base_labels"),
        F.array_join(
            F.array_sort(F.array_distinct(F.concat("f.base", F.coalesce("more", F.array().cast("array<string>"))))),
            ",",
        ).alias("labels"),
        F.when(F.col("f.n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
