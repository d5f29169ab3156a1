"""Lexical retrieval packing.

Texts become token ids; every full window is a sequence of its own, decided where the text lies.
What is left of each document, less than a window, goes to shards of bounded size.  A shard builds
a BM25 inverted index over its pieces' token ids.  The longest unused piece is the seed of a
window; its strongest terms query the index, and the unused neighbours fill the window, best
first, whole where they fit.  The best that does not fit is cut to close the window and its rest
stays in the pool.  The shard's last window is cut into sequences whose lengths are powers of two,
so no sequence needs padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmill.llm.common import stage
from eventmill.llm.tokens import WordTokens

WINDOW = 2048
END_ID = 1
SHARD_TOKENS = 1_500_000
QUERY_TERMS = 48
NEIGHBOURS = 48
K1, B = 1.2, 0.75

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_open: dict[str, WordTokens] = {}


def windows(path: str):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Pieces of up to a window, ids as unsigned 16-bit."""
        if path not in _open:  # a worker keeps its words from task to task
            _open[path] = WordTokens(path)
        words, end = _open[path], np.array([END_ID], dtype="<u2").tobytes()
        for batch in batches:
            for a in range(0, len(batch), 256):  # output batches stay small whatever the texts
                part = batch.iloc[a : a + 256]
                rows = []
                for doc_id, ids in zip(part["doc_id"], words.ids(part["text"])):
                    ids += end
                    total = len(ids) // 2
                    for start in range(0, total, WINDOW):
                        stop = min(start + WINDOW, total)
                        rows.append((doc_id, start, stop - start, total, ids[2 * start : 2 * stop]))
                out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "doc_tokens", "ids"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    return cut


class Index:
    """BM25 weights of a shard's pieces by term, with the terms of each piece, strongest first."""

    def __init__(self, pieces: list[np.ndarray]):
        n = len(pieces)
        sizes = np.array([len(p) for p in pieces])
        owner = np.repeat(np.arange(n), sizes)
        keys, tf = np.unique(np.concatenate(pieces).astype(np.int64) * n + owner, return_counts=True)
        term, self.doc = keys // n, keys % n
        self.terms, first, df = np.unique(term, return_index=True, return_counts=True)
        self.first = np.append(first, len(term))
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        slot = np.repeat(np.arange(len(df)), df)
        length = 1 - B + B * sizes[self.doc] / max(sizes.mean(), 1)
        self.weight = (idf[slot] * tf * (K1 + 1) / (tf + K1 * length)).astype(np.float32)
        if n <= 65_536:  # piece, weight and term fit 64 bits, whose plain sort is faster
            falling = 0xFFFF_FFFF - self.weight.view(np.uint32).astype(np.uint64)
            key = self.doc.astype(np.uint64) << np.uint64(48) | falling << np.uint64(16) | slot.astype(np.uint64)
            key.sort()
            self.of_doc = (key & np.uint64(0xFFFF)).astype(np.int64)
        else:
            self.of_doc = slot[np.lexsort((-self.weight, self.doc))]
        self.doc_first = np.append(0, np.cumsum(np.bincount(self.doc, minlength=n)))
        self.n = n

    def scores(self, piece: int) -> np.ndarray:
        a = self.doc_first[piece]
        strongest = self.of_doc[a : min(a + QUERY_TERMS, self.doc_first[piece + 1])]
        sizes = self.first[strongest + 1] - self.first[strongest]
        ends = np.cumsum(sizes)
        at = np.repeat(self.first[strongest] + sizes - ends, sizes) + np.arange(sizes.sum())
        return np.bincount(self.doc[at], weights=self.weight[at], minlength=self.n)


def pack_shard(pieces: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Sequences of (piece, from, to); all are full but the last ones, which are powers of two."""
    index = Index(pieces)
    begin = np.zeros(len(pieces), dtype=np.int64)  # what is used of each piece
    stop = np.array([len(p) for p in pieces])
    left = stop.copy()
    by_length = np.argsort(-stop, kind="stable")
    at = 0
    sequences: list[list[tuple[int, int, int]]] = []
    while True:
        while at < len(by_length) and left[by_length[at]] == 0:
            at += 1
        if at == len(by_length):
            break
        room, window = WINDOW, []

        def take(piece: int, n: int) -> None:
            nonlocal room
            window.append((piece, int(begin[piece]), int(begin[piece]) + n))
            begin[piece] += n
            left[piece] -= n
            room -= n

        seed = int(by_length[at])
        take(seed, int(left[seed]))
        scores = index.scores(seed)
        scores[left == 0] = -1
        k = min(NEIGHBOURS, len(scores) - 1)
        near = np.argpartition(-scores, k)[: k + 1]
        near = near[scores[near] > 0]
        near = near[np.argsort(-scores[near], kind="stable")]
        for piece in near:
            if 0 < left[piece] <= room:
                take(int(piece), int(left[piece]))
        for piece in near:
            if room and left[piece]:
                take(int(piece), int(min(room, left[piece])))
        rest = at
        while room and rest < len(by_length):
            piece = int(by_length[rest])
            if left[piece]:
                take(piece, int(min(room, left[piece])))
            rest += 1
        sequences.append(window)
    if sequences and sum(b - a for _, a, b in sequences[-1]) < WINDOW:
        sequences += powers(sequences.pop())
    return sequences


def powers(window: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """A window cut into sequences whose lengths are powers of two, the longest first."""
    total = sum(b - a for _, a, b in window)
    found, parts = [], list(window)
    for bit in range(total.bit_length() - 1, -1, -1):
        room = total & (1 << bit)
        sequence = []
        while room:
            piece, a, b = parts.pop(0)
            n = min(room, b - a)
            sequence.append((piece, a, a + n))
            if a + n < b:
                parts.insert(0, (piece, a + n, b))
            room -= n
        if sequence:
            found.append(sequence)
    return found


PACKED = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def wide(ids: np.ndarray) -> bytes:
    return ids.astype("<u4").tobytes()


def pack_group(shard: pd.DataFrame) -> pd.DataFrame:
    pieces = [np.frombuffer(x, dtype="<u2") for x in shard["ids"]]
    rows = []
    number = int(shard["shard"].iloc[0]) << 24
    doc_ids, starts, totals = (shard[c].tolist() for c in ("doc_id", "start", "doc_tokens"))
    for k, sequence in enumerate(pack_shard(pieces)):
        offset = 0
        for piece, a, b in sequence:
            rows.append(
                (doc_ids[piece], starts[piece] + a, b - a, totals[piece], (number + k) * 2, offset, wide(pieces[piece][a:b]))
            )
            offset += b - a
    out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
    out["doc_id"] = out["doc_id"].astype("Int64")
    return out


def widen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        batch["doc_id"] = batch["doc_id"].astype("Int64")
        batch["ids"] = [wide(np.frombuffer(x, dtype="<u2")) for x in batch["ids"]]
        yield batch


def pack(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", tokenizer: str | None = None) -> DataFrame:
    """Pieces with their place: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    ``ids`` are little-endian unsigned 32-bit.  A document ends with the id 1; a null text is
    empty and has that id alone.  Repeated rows and null ids are packed like others; an empty
    table gives no rows.  Other columns are left out, whatever their names.  ``tokenizer`` is the
    file of a ``tokenizers`` model that ends words with ``</w>``.
    """
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    pieces = stage(
        plain.mapInPandas(windows(tokenizer or tokenizer_path()), PIECES).select(
            "*", F.monotonically_increasing_id().alias("piece_no")
        ),
        "pieces",
    )
    tokens = pieces.filter(F.col("length") < WINDOW).agg(F.sum("length")).first()[0] or 0
    shards = max(1, -(-tokens // SHARD_TOKENS))
    full = pieces.filter(F.col("length") == WINDOW).select(
        "doc_id",
        "start",
        "length",
        "doc_tokens",
        (F.col("piece_no") * 2 + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        "ids",
    )
    rest = pieces.filter(F.col("length") < WINDOW).withColumn(
        "shard", F.pmod(F.xxhash64("piece_no"), F.lit(shards))
    )
    packed = rest.groupBy("shard").applyInPandas(pack_group, PACKED)
    return packed.unionByName(full.mapInPandas(widen, PACKED))
