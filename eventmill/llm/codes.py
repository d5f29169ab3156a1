"""Vector code compression: each quarter of a vector becomes the index of its nearest entry.

Components become integers.  The nearest entry is found on integer Walsh-Hadamard transforms of
the zero-padded parts and entries: a transform of width n multiplies squared distances by n, and
with the coefficients in sequency order (by their number of sign changes) the first few usually
hold most of the difference.  Squared differences are added up in that order; an entry whose sum
exceeds the whole distance of the most promising one is dropped.  All of it is integer arithmetic,
in 64 bits where the largest component allows it and in unbounded integers where not.

Spark deals out the vectors; a task adds up its parts for each entry before anything is shuffled,
and what the driver holds is the codebook alone: 4 x 256 entries, whatever the input.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.llm.common import join_split, stage

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
BLOCK = 256

Codebook = list[np.ndarray]  # for each part: entries x components


def finite(vector: Column) -> Column:
    """Whether a vector and all its components are there and finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def integers(vectors: list[np.ndarray], width: int, kind: type) -> np.ndarray:
    """floor(1024 * x) of all components, zero-padded at the end to four parts of ``width``."""
    full = np.zeros((len(vectors), PARTS * width), dtype=kind)
    for row, v in zip(full, vectors):
        if kind is object:
            # A double of 2 ** 53 or more is an integer already, and times 1024 it could overflow.
            row[: len(v)] = [math.floor(SCALE * x) if abs(x) < 2**53 else SCALE * int(x) for x in map(float, v)]
        else:
            row[: len(v)] = np.floor(v.astype(np.float64) * SCALE).astype(np.int64)
    return full.reshape(len(vectors), PARTS, width)


def transform(parts: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transforms of the rows, zero-padded to a power of two, in sequency order."""

    def butterflies(x: np.ndarray) -> np.ndarray:
        half = 1
        while half < x.shape[1]:
            pairs = x.reshape(len(x), -1, 2, half)
            x = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2)
            x = x.reshape(len(x), -1)
            half *= 2
        return x

    n = 1 << max(0, parts.shape[1] - 1).bit_length()
    padded = np.zeros((len(parts), n), dtype=parts.dtype)
    padded[:, : parts.shape[1]] = parts
    walsh = butterflies(np.eye(n, dtype=np.int64))
    changes = (walsh[:, 1:] != walsh[:, :-1]).sum(axis=1)
    return butterflies(padded)[:, np.argsort(changes)]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``parts``: its nearest entry (the lower index on ties) and the squared distance."""
    found = np.zeros(len(parts), dtype=np.int64)
    distance = np.zeros(len(parts), dtype=parts.dtype)
    e = transform(entries)
    n = e.shape[1]
    lead = max(1, n // 8)
    for a in range(0, len(parts), BLOCK):
        p = transform(parts[a : a + BLOCK])
        sums = np.zeros((len(p), len(e)), dtype=p.dtype)
        limit = None
        for start in range(0, n, lead):
            for j in range(start, start + lead):
                difference = p[:, j, None] - e[None, :, j]
                difference *= difference
                sums += difference
            if limit is None:
                limit = ((p - e[sums.argmin(axis=1)]) ** 2).sum(axis=1)
            open_ = sums <= limit[:, None]
            if np.count_nonzero(open_) * 16 <= open_.size:  # few: go on with these pairs alone
                break
        row, entry = np.nonzero(open_)
        total = sums[row, entry]
        for j in range(start + lead, n, lead):
            total = total + ((p[row, j : j + lead] - e[entry, j : j + lead]) ** 2).sum(axis=1)
            left = total <= limit[row]
            row, entry, total = row[left], entry[left], total[left]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        best = np.minimum.reduceat(total, first)
        tied = total == best[row]  # every row has its guess at least, so rows are 0, 1, 2 ...
        _, at = np.unique(row[tied], return_index=True)
        found[a : a + BLOCK] = entry[tied][at]
        distance[a : a + BLOCK] = best // n
    return found, distance


def sums_by_entry(codebook: Codebook, width: int, kind: type):
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """(part, entry, n, sums) of all vectors of a task, the sums as decimal text."""
        count = np.zeros((PARTS, len(codebook[0])), dtype=np.int64)
        total = np.zeros((PARTS, len(codebook[0]), width), dtype=kind)
        for batch in batches:
            x = integers(batch["vector"].tolist(), width, kind)
            for part, entries in enumerate(codebook):
                code, _ = nearest(x[:, part], entries)
                np.add.at(total[part], code, x[:, part])
                count[part] += np.bincount(code, minlength=len(entries))
        part, entry = np.nonzero(count)
        sums = [",".join(map(str, row)) for row in total[part, entry].tolist()]
        rows = zip(part.tolist(), entry.tolist(), count[part, entry].tolist(), sums)
        yield pd.DataFrame(list(rows), columns=["part", "entry", "n", "sums"])

    return add


def mean_entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The floors of the entries' means: at most a codebook is held."""
    held: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for batch in batches:
        for part, entry, n, text in zip(batch["part"], batch["entry"], batch["n"].tolist(), batch["sums"]):
            sums = [int(x) for x in text.split(",")] if text else []
            if (part, entry) in held:
                more, others = held[part, entry]
                n, sums = n + more, [x + y for x, y in zip(sums, others)]
            held[part, entry] = n, sums
    rows = [(*key, ",".join(str(x // n) for x in sums)) for key, (n, sums) in held.items()]
    yield pd.DataFrame(rows, columns=["part", "entry", "mean"])


def coded(codebook: Codebook, width: int, kind: type):
    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = integers(batch["vector"].tolist(), width, kind)
            digits, error = [""] * len(batch), [0] * len(batch)
            for part, entries in enumerate(codebook):
                index, distance = nearest(x[:, part], entries)
                digits = [d + f"{i:02x}" for d, i in zip(digits, index.tolist())]
                error = [e + int(y) for e, y in zip(error, distance)]
            yield pd.DataFrame(
                {
                    "vec_id": batch["vec_id"].astype("Int64"),
                    "label": batch["label"],
                    "code": digits,
                    "error": pd.array([e if e < 2**63 else None for e in error], dtype="Int64"),
                }
            )

    return code


def digest(codebook: Codebook) -> str:
    return hashlib.sha256(",".join(str(x) for book in codebook for x in book.ravel().tolist()).encode()).hexdigest()


def compress(
    vectors: DataFrame, *, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label"
) -> tuple[DataFrame, Codebook]:
    """(rows, codebook): vec_id, label as text, code, error, label_error of the kept rows; and the entries.

    Rows whose vector is null or has null or non-finite components are dropped.  Vectors are cut into
    four equal parts; where lengths differ or four does not divide them, all are padded with zeros
    at the end to the least length that fits.  The entries start as the parts of the 256 vectors with
    the smallest ids, null ids last, repeated ids in order of their vectors; with fewer vectors, of
    all.  Null labels are one label.  An error, or a sum of them, beyond 64 bits is null.  An empty
    table gives no rows and an empty codebook.  Other columns are left out, whatever their names.
    """
    kept = stage(
        vectors.filter(finite(F.col(vector))).select(
            F.col(vec_id).cast("bigint").alias("vec_id"),
            F.col(label).cast("string").alias("label"),
            F.col(vector).alias("vector"),
        ),
        "vectors",
    )
    longest, largest = kept.agg(
        F.max(F.size("vector")), F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double")))))
    ).first()
    width = -(-(longest or 0) // PARTS)
    n = 1 << max(0, width - 1).bit_length()
    # Four parts' distances times the transform's width stay below 2 ** 62.
    kind = np.int64 if ((largest or 0) + 1) * SCALE * 2 * n <= 2**30 else object
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(ENTRIES).collect()
    start = integers([np.array(r["vector"], dtype=np.float64) for r in first], width, kind)
    codebook = [start[:, part].copy() for part in range(PARTS)]
    if not first:
        empty = kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"))
        return empty.withColumn("label_error", F.col("error")), codebook
    for _ in range(ROUNDS):
        means = (
            kept.select("vector")
            .mapInPandas(sums_by_entry(codebook, width, kind), "part int, entry int, n long, sums string")
            .repartition("part", "entry")
            .mapInPandas(mean_entries, "part int, entry int, mean string")
            .collect()
        )
        codebook = [book.copy() for book in codebook]
        for r in means:
            codebook[r["part"]][r["entry"]] = [int(x) for x in r["mean"].split(",")] if width else []
    rows = stage(
        kept.mapInPandas(coded(codebook, width, kind), "vec_id long, label string, code string, error long"), "codes"
    )
    totals = rows.groupBy("label").agg(
        F.sum(F.col("error").cast("decimal(38,0)")).alias("sum"),
        F.count("*").alias("n"),
        F.count("error").alias("known"),
    )
    totals = totals.select(
        "label", "n", F.expr("CASE WHEN n = known THEN try_cast(sum AS bigint) END").alias("label_error")
    )
    return join_split(rows, totals, ["label"], rows.count()), codebook
