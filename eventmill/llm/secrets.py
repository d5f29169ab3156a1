"""Secret scan: known formats, and a randomness battery under false-discovery control.

Every run of 20 or more characters of the usual encodings is a candidate.  Its encoding is the
smallest alphabet that holds it.  Three tests ask whether it could be random: chi-squared of the
symbols against uniform, runs above and below the alphabet's middle, and serial correlation of
neighbours; Fisher's method combines them, and what they reject is no secret.  Many ordinary words
pass, the more the shorter they are.  So each candidate is also tested against the null hypothesis
that it is ordinary text, whose symbol frequencies come from the whole corpus: ``z`` says how much
more even its symbols are than text of that length would have them.  Benjamini and Hochberg's
procedure, run within each encoding and class of length, sets the bound on ``z``.

One pass over the texts writes candidates; frequencies and bounds are small aggregates of bounded
size (symbols, and bins of ``z`` in each class).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.llm.common import stage

KINDS = ("assign", "access", "hex", "random")
#: Base patterns (fixed values).
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ASSIGN_HINTS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}")

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: From the smallest alphabet to the largest; a candidate takes the first that holds it.
ALPHABETS = {
    "digits": _DIGITS,
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "lower": _LOWER,
    "upper": _UPPER,
    "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER,
    "BASE36": _DIGITS + _UPPER,
    "letters": _UPPER + _LOWER,
    "base62": _UPPER + _LOWER + _DIGITS,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
    "mixed": _UPPER + _LOWER + _DIGITS + "+/-_",
}
NAMES = list(ALPHABETS)
RANDOM_LEVEL = 0.001
DISCOVERY_RATE = 0.01
BINS = (-400, 100)  # of z, in tenths

SCHEMA = (
    "doc_id long, base array<struct<start:long,kind:int,end:long>>, "
    "tested array<struct<start:long,end:long,encoding:int,n:int,chi:double,p:double>>, symbols array<long>"
)


def normal_tail(z: np.ndarray) -> np.ndarray:
    """Two-sided tail probability."""
    return np.array([math.erfc(abs(x) / math.sqrt(2)) for x in z])


def battery(tokens: list[bytes]) -> list[tuple[int, float, float]]:
    """Encoding, chi-squared statistic and combined probability of each candidate."""
    if not tokens:
        return []
    sizes = np.array([len(t) for t in tokens])
    symbols = np.frombuffer(b"".join(tokens), dtype=np.uint8)
    owner = np.repeat(np.arange(len(tokens)), sizes)
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    encoding = np.full(len(tokens), len(NAMES) - 1)
    index = np.zeros((len(NAMES), 128), dtype=np.int64)
    for i in range(len(NAMES) - 1, -1, -1):
        letters = np.frombuffer(ALPHABETS[NAMES[i]].encode(), dtype=np.uint8)
        index[i, letters] = np.arange(len(letters))
        member = np.zeros(128, dtype=bool)
        member[letters] = True
        encoding[np.logical_and.reduceat(member[symbols], begin)] = i
    width = np.array([len(ALPHABETS[n]) for n in NAMES])[encoding]
    x = index[encoding[owner], symbols]

    counts = np.unique(owner * 128 + x, return_counts=True)
    squares = np.bincount(counts[0] // 128, weights=counts[1].astype(float) ** 2, minlength=len(tokens))
    chi = width / sizes * squares - sizes
    df = width - 1.0
    # Wilson and Hilferty's cube root makes chi-squared nearly normal.
    z = (np.cbrt(np.maximum(chi, 0) / df) - (1 - 2 / (9 * df))) / np.sqrt(2 / (9 * df))
    p_even = np.array([0.5 * math.erfc(v / math.sqrt(2)) for v in z])

    first = np.zeros(len(x), dtype=bool)
    first[begin] = True
    above = x * 2 >= width[owner]
    change = np.zeros(len(x))
    change[1:] = (above[1:] != above[:-1]) & ~first[1:]
    n1 = np.add.reduceat(above.astype(float), begin)
    n0 = sizes - n1
    runs = 1 + np.add.reduceat(change, begin)
    mean = 1 + 2 * n0 * n1 / sizes
    variance = np.maximum((mean - 1) * (mean - 2) / np.maximum(sizes - 1, 1), 1e-9)
    p_runs = np.where((n0 == 0) | (n1 == 0), 2.0 ** (1.0 - sizes), normal_tail((runs - mean) / np.sqrt(variance)))

    centred = x - (np.add.reduceat(x.astype(float), begin) / sizes)[owner]
    product = np.zeros(len(x))
    product[:-1] = centred[:-1] * centred[1:]
    product[np.concatenate([begin[1:], [len(x)]]) - 1] = 0
    spread = np.add.reduceat(centred**2, begin)
    serial = np.add.reduceat(product, begin) / np.maximum(spread, 1e-9)
    p_serial = np.where(spread == 0, 0.0, normal_tail((serial + 1 / sizes) * np.sqrt(sizes)))

    half = -sum(np.log(np.maximum(p, 1e-300)) for p in (p_even, p_runs, p_serial))
    p = np.exp(-half) * (1 + half + half**2 / 2)
    return list(zip(encoding.tolist(), chi.tolist(), p.tolist()))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed formats, by start, then kind."""
    found = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def examine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        base, tokens, places = [], [], []
        symbols = np.zeros(128, dtype=np.int64)
        for i, text in enumerate(batch["text"]):
            raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
            symbols += np.bincount(raw, minlength=256)[:128]
            spans = base_spans(text)
            base.append([{"start": a, "kind": k, "end": b} for a, k, b in spans])
            for m in CANDIDATE.finditer(text):
                if all(m.end() <= a or b <= m.start() for a, _, b in spans):
                    tokens.append(m[0].encode())
                    places.append((i, m.start(), m.end()))
        tested: list[list[dict]] = [[] for _ in base]
        for (i, start, end), (encoding, chi, p) in zip(places, battery(tokens)):
            tested[i].append({"start": start, "end": end, "encoding": encoding, "n": end - start, "chi": chi, "p": p})
        counted = [None] * len(base)
        if base:
            counted[0] = symbols.tolist()
        yield pd.DataFrame({"doc_id": batch["doc_id"], "base": base, "tested": tested, "symbols": counted})


def text_evenness(frequencies: dict[int, int]) -> dict[int, tuple[float, float, float]]:
    """For each encoding: width, sum of squares and of cubes of its symbols' shares in the corpus."""
    found = {}
    for i, name in enumerate(NAMES):
        counts = np.array([frequencies.get(ord(c), 0) + 1.0 for c in ALPHABETS[name]])
        share = counts / counts.sum()
        found[i] = (float(len(share)), float((share**2).sum()), float((share**3).sum()))
    return found


def bounds(bins: list[tuple[int, int, int, int]], rate: float) -> dict[tuple[int, int], float]:
    """Benjamini and Hochberg's bound on z for each class, from (encoding, length, bin, count) rows."""
    classes: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for encoding, length, at, count in bins:
        classes.setdefault((encoding, length), []).append((at, count))
    found = {}
    for key, counts in classes.items():
        total, below = sum(n for _, n in counts), 0
        for at, n in sorted(counts):
            below += n
            edge = (at + 1) / 10
            if 0.5 * math.erfc(-edge / math.sqrt(2)) <= rate * below / total:
                found[key] = edge
    return found


def scan(
    docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", rate: float = DISCOVERY_RATE
) -> DataFrame:
    """One row per document: doc_id and ``spans``, array of (start, kind, end) by start, then kind.

    A null text is empty.  Pure digits are never secrets.  Candidates that touch a span of a fixed
    format are not tested.  Repeated rows and null ids are kept; an empty table gives no rows;
    other columns are left out, whatever their names.
    """
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = stage(plain.mapInPandas(examine, SCHEMA), "secrets")
    counted = found.filter("symbols IS NOT NULL").select(F.posexplode("symbols").alias("symbol", "n"))
    frequencies = {r["symbol"]: r["n"] for r in counted.groupBy("symbol").agg(F.sum("n").alias("n")).collect()}
    table = text_evenness(frequencies)

    def of(encoding: Column, k: int) -> Column:
        return F.get(F.array(*[F.lit(table[i][k]) for i in range(len(NAMES))]), encoding)

    def z(c: Column) -> Column:
        width, squares, cubes = (of(c["encoding"], k) for k in range(3))
        mean = width * (1 - squares + c["n"] * squares) - c["n"]
        variance = width * width * (4 * c["n"] * (cubes - squares * squares) + 2 * squares * squares)
        return (c["chi"] - mean) / F.sqrt(variance)

    def length(c: Column) -> Column:
        return F.floor(F.log2(c["n"].cast("double"))).cast("int")

    tested = F.filter("tested", lambda c: (c["p"] >= RANDOM_LEVEL) & (c["encoding"] != NAMES.index("digits")))
    each = found.select(F.explode(F.filter("tested", lambda c: c["encoding"] != NAMES.index("digits"))).alias("c"))
    bins = each.groupBy(
        F.col("c.encoding").alias("encoding"),
        length(F.col("c")).alias("length"),
        F.floor(F.greatest(F.lit(BINS[0]), F.least(F.lit(BINS[1]), z(F.col("c")) * 10))).cast("int").alias("bin"),
    ).count()
    limit = bounds([tuple(r) for r in bins.collect()], rate)
    keys = [F.lit(x) for (e, n), edge in limit.items() for x in (e * 100 + n, edge)]

    def discovered(c: Column) -> Column:
        if not keys:
            return F.lit(False)
        edge = F.try_element_at(F.create_map(*keys), c["encoding"] * 100 + length(c))
        return F.coalesce(z(c) < edge, F.lit(False))

    random = F.transform(
        F.filter(tested, discovered),
        lambda c: F.struct(c["start"], F.lit(KINDS.index("random")).alias("kind"), c["end"]),
    )
    return found.select("doc_id", F.array_sort(F.concat("base", random)).alias("spans"))


def joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )
