"""Hashed maximum-entropy language model with class-factored softmax.

The words of the training texts are counted first; the counts are a table of the cluster's.  The
``VOCABULARY`` most frequent words, a bounded table, go to every task.  Each of the ``RANKED`` most
frequent words has a slot of its own; all others, known or not, share ``SHARED`` slots by a hash.  The
model predicts the slot of every word from its context, in steps: a softmax over ``CLASSES`` classes of
``MEMBERS`` words, which are the most frequent ones by rank, and ``REST`` classes of all other slots;
then one over the words of the class, or, for the other slots, ``DEPTH`` softmaxes over ``BRANCH``
branches each, down a tree over the slots.  In a shared slot a word's probability is its smoothed share of the slot's
counts.  Features of all softmaxes are the previous word, the one before it (skip) and the pair, hashed
into rows whose number grows with the square root of the training tokens.

Training takes ``ROUNDS`` distributed updates, each from another slice of the training texts, so
that every training token is used.  A task sums the gradient of its texts; parts of the gradient
are added up across tasks by a shuffle, and each weight moves by its gradient over the expected
curvature.  As the tables grow, fewer tasks sum them up, so what they shuffle stays in proportion to
the texts.  Texts are encoded once; scoring works on batches of token ids with sparse lookups, and long
texts are cut into pieces that carry the two words before them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmill.llm.common import stage

VOCABULARY = 200_000
CLASSES, MEMBERS = 15, 32
HEAD = CLASSES * MEMBERS
#: Slots of tokens: ranks first, all others share hashed ones up to 65,535.
SLOTS, RANKED = 65_536, 49_152
SHARED = SLOTS - RANKED
REST, BRANCH, DEPTH = 2, 8, 5  # REST * BRANCH ** DEPTH == SLOTS
#: Rows of the tables up to GROWING training tokens; beyond, they grow with the square root, to so many times.
ROWS, MEMBER_ROWS, REST_ROWS = 8_192, 16_384, 32_768
GROWING, MOST_TIMES = 1 << 25, 32
ROUNDS = 3
STEP, DAMPING = 0.2, 20.0  # three features move together for each token, so a step is a third or less
PART = 16_384  # weights in a row of the gradient's shuffle
BATCH_TOKENS = 65_536
LEVELS = 8  # members of a group that is added up together with others
FLUSH_WORDS = 300_000
END = b""  # the end token; no word is empty

ENCODED = (
    "doc_id long, row_no long, held_out boolean, slice int, n long, ids binary, known long, log_counts double, "
    "shared_log_counts double, tail array<binary>"
)


def tokens(text: str) -> list[bytes]:
    ws = text.encode().lower().split()  # bytes: only A-Z change, only \x20 and \x09-\x0D split
    ws.append(END)
    return ws


def count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter[bytes] = Counter()
    for batch in batches:
        for text in batch["text"]:
            counts.update(tokens(text))
            if len(counts) >= FLUSH_WORDS:
                yield pd.DataFrame({"word": list(counts), "c": list(counts.values())})
                counts.clear()
    if counts:
        yield pd.DataFrame({"word": list(counts), "c": list(counts.values())})


def frequent(counts: DataFrame) -> list[tuple[bytes, int]]:
    """Up to ``VOCABULARY`` words, the most frequent first, ties by word.

    The least count that keeps the number within bounds comes from a histogram of the counts'
    logarithms, so no task sorts the whole vocabulary.  Words of one bin come or stay out together.
    """
    bin_ = F.floor(F.log2(F.col("c").cast("double")) * 16).cast("int")
    bins = sorted(counts.groupBy(bin_.alias("bin")).count().collect(), reverse=True)
    total, least = 0, None
    for b, n in bins:
        total += n
        if total > VOCABULARY:
            break
        least = b
    if least is None:
        return []
    rows = counts.filter(bin_ >= least).collect()  # bounded by VOCABULARY
    return sorted(((bytes(r["word"]), r["c"]) for r in rows), key=lambda x: (-x[1], x[0]))


def hashed_id(word: bytes) -> int:
    return RANKED + xxhash.xxh64_intdigest(word, 42) % SHARED  # as Spark's xxhash64


class Ranks(dict):
    """Rank of a word; words out of the vocabulary share the last rank and are not stored."""

    def __missing__(self, word: bytes) -> int:
        return len(self)


def encode(vocabulary):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranked = vocabulary.value
        ranks, out = Ranks((w, i) for i, (w, _) in enumerate(ranked)), len(ranked)
        ids = np.array([i if i < RANKED else hashed_id(w) for i, (w, _) in enumerate(ranked)] + [0], dtype="<u2")
        logs = np.append(np.log10(np.array([c for _, c in ranked], dtype=float) + 0.1), 0.0)
        shared_logs = np.where(np.arange(len(logs)) < RANKED, 0.0, logs)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                ws = tokens(text)
                at = np.fromiter(map(ranks.__getitem__, ws), dtype=np.int64, count=len(ws))
                x = ids[at]
                unknown = np.flatnonzero(at == out)
                tail = [ws[i] for i in unknown]
                x[unknown] = [hashed_id(w) for w in tail]
                rows.append(
                    (
                        len(ws),
                        x.tobytes(),
                        len(ws) - len(tail),
                        logs[at].sum(),
                        shared_logs[at].sum(),
                        tail,
                    )
                )
            made = pd.DataFrame(
                rows, columns=["n", "ids", "known", "log_counts", "shared_log_counts", "tail"]
            )
            kept = batch[["doc_id", "row_no", "held_out", "slice"]].reset_index(drop=True)
            kept["doc_id"] = kept["doc_id"].astype("Int64")
            yield pd.concat([kept, made], axis=1)

    return run


def slots(counts: DataFrame, ranked: list[tuple[bytes, int]]) -> np.ndarray:
    """Weight of each slot: the smoothed counts of its words, and of an unknown one if it is shared."""
    found = np.zeros(SLOTS)
    own = ranked[:RANKED]
    found[: len(own)] = np.array([c for _, c in own], dtype=float) + 0.1
    found[RANKED:] = 0.1
    for w, c in ranked[RANKED:]:
        found[hashed_id(w)] += c + 0.1
    rare = counts.filter(F.col("c") < ranked[-1][1]) if ranked else counts
    slot = F.pmod(F.xxhash64("word"), F.lit(SHARED)).cast("int")
    for r in rare.groupBy(slot.alias("slot")).agg(F.sum(F.col("c") + 0.1).alias("weight")).collect():
        found[RANKED + r["slot"]] += r["weight"]
    return found


def times(tokens: float) -> int:
    """By how much the tables are larger than their least size: a power of two."""
    return min(MOST_TIMES, 1 << max(0, round(np.log2(max(tokens, 1) / GROWING) / 2)))


def mixed(a: np.ndarray) -> np.ndarray:
    return (a.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)


def hashed(a: np.ndarray, b: np.ndarray | int, rows: int) -> np.ndarray:
    """Rows of mixed keys."""
    x = a + np.asarray(b, dtype=np.uint64)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(40)).astype(np.uint32) & np.uint32(rows - 1)  # of a power of two rows


def log_shares(weights: np.ndarray) -> np.ndarray:
    """Logarithms of the shares in a row; those without weight are out of reach."""
    total = np.maximum(weights.sum(axis=1, keepdims=True), 1e-30)
    return np.where(weights > 0, np.log(np.maximum(weights / total, 1e-30)), -1e9).astype(np.float32)


class Model:
    """Weights in one flat array: rows of class weights, of member weights, of weights in the tree."""

    def __init__(self, weights: np.ndarray, total: float):
        """``weights`` of the slots; ``total`` training tokens."""
        head = np.maximum(weights[:HEAD], 0.1).reshape(CLASSES, MEMBERS)
        rest = np.append(np.zeros(HEAD), weights[HEAD:])
        classes = np.append(head.sum(axis=1), rest.reshape(REST, -1).sum(axis=1))
        self.class_bias = log_shares(classes[None, :])[0]
        self.member_bias = log_shares(head)
        self.rest_bias = [log_shares(rest.reshape(REST * BRANCH**d, BRANCH, -1).sum(axis=2)) for d in range(DEPTH)]
        self.shared_log10 = np.log10(weights[RANKED:])
        self.shapes = [
            (rows * times(total), width)
            for rows, width in ((ROWS, CLASSES + REST), (MEMBER_ROWS, MEMBERS), (REST_ROWS, BRANCH))
        ]
        self.weights = np.zeros(sum(a * b for a, b in self.shapes), dtype=np.float32)

    def tables(self, flat: np.ndarray) -> list[np.ndarray]:
        cuts = np.cumsum([a * b for a, b in self.shapes])
        return [x.reshape(shape) for x, shape in zip(np.split(flat, cuts[:-1]), self.shapes)]

    def features(self, ids: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
        """Keys of the features of each token: previous word, the one before, and both."""
        edge = np.uint64(70_000)
        one = np.empty(len(ids), dtype=np.uint64)
        one[1:], one[0] = ids[:-1], edge
        one[first] = edge
        two = np.empty(len(ids), dtype=np.uint64)
        two[1:], two[0] = one[:-1], edge
        two[first] = edge
        return [mixed(x) for x in (one, two + np.uint64(1 << 20), (one << np.uint64(21)) + two + np.uint64(1 << 42))]

    def steps(self, ids: np.ndarray, first: np.ndarray, lead: int = 0):
        """For each softmax: number of its table, tokens, rows of their features, probabilities, targets.

        The first ``lead`` tokens are context only.
        """
        tables = self.tables(self.weights)
        keys = [k[lead:] for k in self.features(ids, first)]
        ids = ids[lead:]

        def softmax(table, bias, keys, salt):
            rows = [hashed(k, salt, self.shapes[table][0]) for k in keys]
            z = np.take(tables[table], rows[0], axis=0)  # much faster than indexing, for whole rows
            z += bias
            for r in rows[1:]:
                z += np.take(tables[table], r, axis=0)
            z -= z.max(axis=1, keepdims=True)
            np.exp(z, out=z)
            z /= z.sum(axis=1, keepdims=True)
            return rows, z

        of_class = np.where(ids < HEAD, ids // MEMBERS, CLASSES + ids * REST // SLOTS)
        yield 0, np.arange(len(ids)), *softmax(0, self.class_bias, keys, 0), of_class
        at = np.flatnonzero(ids < HEAD)
        if len(at):
            of = of_class[at]
            bias = np.take(self.member_bias, of, axis=0)
            yield 1, at, *softmax(1, bias, [k[at] for k in keys], of + 1), ids[at] % MEMBERS
        at = np.flatnonzero(ids >= HEAD)
        if len(at):
            keys, ids = [k[at] for k in keys], ids[at]
            for d in range(DEPTH):
                below = ids // (SLOTS // REST // BRANCH ** (d + 1))
                node = below // BRANCH
                bias = np.take(self.rest_bias[d], node, axis=0)
                yield 2, at, *softmax(2, bias, keys, node + REST * BRANCH**d), below % BRANCH

    def log10(self, ids: np.ndarray, first: np.ndarray, lead: int = 0) -> np.ndarray:
        """Of each token behind the lead: its slot; for shared slots, divided by the slot's weight."""
        found = np.zeros(len(ids) - lead)
        for _, at, _, p, target in self.steps(ids, first, lead):
            found[at] += np.log10(np.maximum(p[np.arange(len(at)), target], 1e-30))
        shared = np.flatnonzero(ids[lead:] >= RANKED)
        found[shared] -= self.shared_log10[ids[lead:][shared] - RANKED]
        return found

    def gradient(self, ids: np.ndarray, first: np.ndarray, lead: int, into: np.ndarray, curve: np.ndarray) -> None:
        """Add the gradient and the expected curvature of these tokens."""
        g, h = self.tables(into), self.tables(curve)
        for table, _, rows, p, target in self.steps(ids, first, lead):
            add(g[table], h[table], rows, p, target)


def by_row(rows: np.ndarray) -> np.ndarray:
    """Stable order of the rows; numbers of 16 bits are sorted fastest."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    high = rows >> np.uint32(16)
    return order[np.argsort(high[order].astype(np.uint16), kind="stable")] if high.any() else order


def add(g: np.ndarray, h: np.ndarray, rows: list[np.ndarray], p: np.ndarray, target: np.ndarray) -> None:
    width = p.shape[1]
    both = np.empty((len(p), 2 * width), dtype=p.dtype)  # slope and spread, so that each row is moved once
    slope = np.negative(p, out=both[:, :width])
    slope[np.arange(len(p)), target] += 1
    np.multiply(p, 1 - p, out=both[:, width:])
    for r in rows:
        order = by_row(r)
        sorted_rows = r[order]
        begin = np.flatnonzero(np.append(True, sorted_rows[1:] != sorted_rows[:-1]))
        sizes = np.diff(np.append(begin, len(order)))
        large_first = np.argsort(-sizes, kind="stable")
        begin, sizes = begin[large_first], sizes[large_first]
        at = sorted_rows[begin]
        sums = group_sums(both, order, begin, sizes)
        g[at] += sums[:, :width]
        h[at] += sums[:, width:]


def group_sums(values: np.ndarray, order: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of the values at ``order[begin[i] : begin[i] + sizes[i]]``; the largest groups come first.

    Groups are many and most are small.  Of those of up to ``LEVELS`` members, the k-th members of
    all groups are added at once; only larger ones are added up group by group.  Members are added
    in the order in which numpy adds so few, so the sums have its very bits.
    """
    sums = np.empty((len(begin), values.shape[1]), dtype=values.dtype)
    large = int(np.searchsorted(-sizes, -LEVELS))
    if large:
        ends = np.cumsum(sizes[:large])
        at = np.repeat(begin[:large] + sizes[:large] - ends, sizes[:large]) + np.arange(ends[-1])
        np.add.reduceat(np.take(values, order[at], axis=0), ends - sizes[:large], axis=0, out=sums[:large])
    small, begin, sizes = sums[large:], begin[large:], sizes[large:]
    np.take(values, order[begin], axis=0, out=small)
    others = None
    for k in range(1, LEVELS):
        more = int(np.searchsorted(-sizes, -k))  # groups that have a member k
        if not more:
            break
        members = np.take(values, order[begin[:more] + k], axis=0)
        if others is None:
            others = members
        else:
            others[:more] += members
    if others is not None:
        small[: len(others)] += others
    return sums


def chunks(batch: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray]]:
    """(ids, first tokens' positions, length of the lead, documents' numbers), of a bounded size.

    Whole documents, or a piece of a long one, behind a lead of two tokens if it has some before it.
    """
    sizes = batch["n"].to_numpy()
    a = 0
    while a < len(sizes):
        b, total = a + 1, int(sizes[a])
        while b < len(sizes) and total + sizes[b] <= BATCH_TOKENS:
            total += int(sizes[b])
            b += 1
        ids = np.frombuffer(b"".join(batch["ids"].iloc[a:b]), dtype="<u2")
        first = np.concatenate([[0], np.cumsum(sizes[a:b])[:-1]])
        if b == a + 1:
            for start in range(0, len(ids), BATCH_TOKENS):
                lead = min(start, 2)
                yield ids[start - lead : start + BATCH_TOKENS].astype(np.int64), first, lead, np.arange(a, b)
        else:
            yield ids.astype(np.int64), first, 0, np.arange(a, b)
        a = b


def gradients(model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model.value
        g, h = np.zeros_like(m.weights), np.zeros_like(m.weights)
        for batch in batches:
            for ids, first, lead, _ in chunks(batch):
                m.gradient(ids, first, lead, g, h)
        for a in range(0, len(g), PART):
            if h[a : a + PART].any():
                pair = np.stack([g[a : a + PART], h[a : a + PART]])
                yield pd.DataFrame({"part": [a], "sums": [pair.astype("<f4").tobytes()]})

    return run


def add_parts(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.frombuffer(rows["sums"].iloc[0], dtype="<f4").astype(np.float64)
    for x in rows["sums"].iloc[1:]:
        total = total + np.frombuffer(x, dtype="<f4")
    return pd.DataFrame({"part": [rows["part"].iloc[0]], "sums": [total.astype("<f4").tobytes()]})


def train(encoded: DataFrame, model: Model, total: float) -> Model:
    context = encoded.sparkSession.sparkContext
    for k in range(ROUNDS):
        sent = context.broadcast(model)
        texts = encoded.filter((F.col("slice") == k) & ~F.col("held_out")).select("n", "ids")
        if times(total) > 1:
            tasks = texts.rdd.getNumPartitions() // times(total)
            texts = texts.coalesce(max(tasks, context.defaultParallelism))
        parts = texts.mapInPandas(gradients(sent), "part long, sums binary")
        moved = parts.groupBy("part").applyInPandas(add_parts, "part long, sums binary").collect()
        for r in moved:  # as many as the model has parts, whatever the input
            g, h = np.frombuffer(r["sums"], dtype="<f4").reshape(2, -1)
            a = r["part"]
            model.weights[a : a + len(g[:])] += STEP * g / (h + DAMPING)
        sent.unpersist()
    return model


def score_batches(model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model.value
        for batch in batches:
            scores = np.zeros(len(batch))
            for ids, first, lead, numbers in chunks(batch):
                scores[numbers] += np.add.reduceat(m.log10(ids, first, lead), first)
            out = batch[["row_no"]].reset_index(drop=True)
            out["model_score"] = scores
            yield out

    return run


def score(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A text is held out from training if the CRC-32 of its id's text leaves 0 by 10; a null id
    counts as empty and is held out.  A null text is empty and has the end token alone.  Repeated
    rows train and score like others; an empty table gives no rows.  Other columns are left out,
    whatever their names.
    """
    spark = docs.sparkSession
    crc = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    plain = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        (crc % 10 == 0).alias("held_out"),
    )
    counts = stage(
        plain.filter("NOT held_out")
        .select("text")
        .mapInPandas(count_words, "word binary, c long")
        .groupBy("word")
        .agg(F.sum("c").alias("c")),
        "counts",
    )
    sums = counts.agg(F.sum("c"), F.count("*")).first()
    total, distinct = sums[0] or 0, sums[1]
    ranked = frequent(counts)
    vocabulary = spark.sparkContext.broadcast(ranked)
    encoded = stage(
        plain.select(
            "doc_id",
            F.monotonically_increasing_id().alias("row_no"),
            "held_out",
            F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(ROUNDS)).cast("int").alias("slice"),
            "text",
        ).mapInPandas(encode(vocabulary), ENCODED),
        "encoded",
        "slice",
    )
    model = train(encoded, Model(slots(counts, ranked), total), total)
    least = ranked[-1][1] if ranked else 0
    of_tail = (
        encoded.select("row_no", F.explode("tail").alias("word"))
        .join(counts.filter(F.col("c") <= least) if ranked else counts, "word", "left")
        .groupBy("row_no")
        .agg(F.count("c").alias("tail_known"), F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.1)).alias("tail_logs"))
    )
    scored = encoded.select("row_no", "n", "ids").mapInPandas(
        score_batches(spark.sparkContext.broadcast(model)), "row_no long, model_score double"
    )
    zero = F.lit(0)
    smooth = float(np.log10(total + 0.1 * (distinct + 1)))
    tail_logs = F.coalesce("tail_logs", F.lit(0.0))
    return (
        encoded.select("doc_id", "row_no", "held_out", "n", "known", "log_counts", "shared_log_counts")
        .join(scored, "row_no")
        .join(of_tail, "row_no", "left")
        .select(
            "doc_id",
            "held_out",
            F.col("n").alias("n_tokens"),
            (F.col("known") + F.coalesce("tail_known", zero)).cast("long").alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            (F.col("log_counts") + tail_logs - F.col("n") * smooth).alias("base_score"),
            (F.col("model_score") + F.col("shared_log_counts") + tail_logs).alias("score"),
        )
    )
