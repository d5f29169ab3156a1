"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source is cut into blocks by a hash of the document id and its blocks are put in a random
order, a new one for each repetition.  The source's target, in words, draws blocks from that order;
the last one is drawn in part, document by document, the last document cut at a word.  So quotas
are exact.  A binary tree then deals the drawn blocks out to output shards: each node draws, from
the counts of blocks by source that it holds, how many of each go to its left half, which is a
multivariate hypergeometric draw.  A node's draw depends on the seed and its place only, so any
task finds the shard of any block by walking down from the root; nobody holds the whole table.
Inside a shard, rows are put in random order.

Blocks number 200,000 or so at most, whatever the input, as their size grows with it; that is why
the table of drawn blocks may be broadcast and documents need no shuffle to find theirs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmill.llm.common import GAP, stage, words

WEIGHTS = (3, 1, 2)
LEAST_BLOCK = 65_536  # words
MOST_BLOCKS = 200_000  # of all sources, but for one each; bounds what is broadcast
MOST_SOURCES = 100_000


def fill(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; the excess is reshared."""
    target = [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), total
    while open_ and left > 0:
        weight = sum(weights[i] for i in open_)
        full = {i for i in open_ if left * weights[i] / weight >= most * sizes[i]}
        if not full:
            for i in open_:
                target[i] = left * weights[i] / weight
            break
        for i in full:
            target[i] = float(most * sizes[i])
        left -= sum(target[i] for i in full)
        open_ -= full
    return target


class Tree:
    """Deals ``quotas`` blocks of each source out to ``2 ** depth`` shards."""

    def __init__(self, quotas: list[int], depth: int, seed: int):
        self.depth, self.seed = depth, seed
        self.root = tuple(quotas)
        self.left = lru_cache(maxsize=65_536)(self._left)

    def _left(self, level: int, place: int, held: tuple[int, ...]) -> tuple[int, ...]:
        rng = np.random.Generator(np.random.Philox(key=[self.seed, (level << 48) | place]))
        total = sum(held)
        half = total // 2 + (total % 2 and int(rng.integers(2)))
        drawn = []
        for n in held:  # one source after the other: hypergeometric against all that are left
            k = int(rng.hypergeometric(n, total - n, half)) if total and half else 0
            drawn.append(k)
            total, half = total - n, half - k
        return tuple(drawn)

    def shard(self, source: int, block: int) -> int:
        """The shard of the source's ``block``-th drawn block."""
        held, place = self.root, 0
        for level in range(self.depth):
            left = self.left(level, place, held)
            if block < left[source]:
                held, place = left, place * 2
            else:
                block -= left[source]
                held, place = tuple(a - b for a, b in zip(held, left)), place * 2 + 1
        return place


def size(text: Column) -> Column:
    return F.coalesce(F.size(words(text)), F.lit(0)).cast("bigint")


def order(seed: int, *columns: str | Column) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def mix(
    docs: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    shard_words: int = 8_000_000,
    seed: int = 7,
    carry: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(rows, draws): all documents with size, source_size and target; and what the mix takes.

    ``draws`` has one row for each time a document is drawn: doc_id, shard, repetition, taken (its
    first ``taken`` words) and, if ``carry``, the struct ``row``.  Sources go by code point, a null
    source last; their weights are ``weights``, repeating.  A null text has size 0 and is never
    drawn.  Equal rows are drawn like any others.  The mix depends on seed, ids and sizes only, so
    reruns agree.  An empty table gives no rows.
    """
    row = [F.struct("*").alias("row")] if carry else []
    plain = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(source).alias("source"),
        size(F.col(text)).alias("size"),
        order(seed, F.col(doc_id)).alias("place"),
        F.monotonically_increasing_id().alias("row_no"),
        *row,
    )
    # Texts are not written here: what is drawn is read from the input again.
    sized = stage(plain.drop("row") if carry else plain, "sized")
    spark = docs.sparkSession
    # One row a source: the user names a weight for each, so they are few.
    found = sized.groupBy("source").agg(F.sum("size").alias("words")).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: weigh groups of them")
    found.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [r["words"] for r in found]
    total = sum(sizes)
    targets = fill(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share * total, most)
    block_words = max(LEAST_BLOCK, total // MOST_BLOCKS)
    sources = spark.createDataFrame(
        [
            (r["source"], i, r["words"], t, int(round(t)), max(1, -(-r["words"] // block_words)))
            for i, (r, t) in enumerate(zip(found, targets))
        ],
        "source string, source_no int, source_size long, target double, quota long, n_blocks long",
    )

    def place(rows: DataFrame) -> DataFrame:
        return (
            rows.alias("d")
            .join(F.broadcast(sources).alias("s"), F.expr("d.source <=> s.source"))
            .drop(F.col("s.source"))
            .withColumn("block", F.pmod("place", "n_blocks"))
        )

    placed = place(sized)
    rounds = max([1, *(int(-(-t // s)) for t, s in zip(targets, sizes) if s)])
    repeated = F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("repetition")
    shape = ("source_no", "source_size", "quota")

    blocks = (
        placed.filter("size > 0").groupBy(*shape, "block").agg(F.sum("size").alias("words")).select("*", repeated)
    )
    in_order = Window.partitionBy("source_no", "repetition").orderBy(order(seed + 1, "source_no", "repetition", "block"), "block")
    drawn = (
        blocks.withColumn("ends", F.sum("words").over(in_order))
        .withColumn("nth", F.row_number().over(in_order) - 1)
        .withColumn("left", F.expr("quota - repetition * source_size - (ends - words)"))
        .filter("left > 0")
    )
    drawn = stage(drawn.select("source_no", "block", "repetition", "nth", "words", "left"), "drawn-blocks")
    quotas = {
        (r["source_no"], r["repetition"]): r["n"]
        for r in drawn.groupBy("source_no", "repetition").agg(F.count("*").alias("n")).collect()
    }
    of_source = [sum(n for (s, _), n in quotas.items() if s == i) for i in range(len(sizes))]
    earlier = {(s, e): sum(n for (t, f), n in quotas.items() if t == s and f < e) for s, e in quotas}
    depth = max(0, int(share * total) // shard_words).bit_length()

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = Tree(of_source, depth, seed)
        for batch in batches:
            at = zip(batch["source_no"], batch["repetition"], batch["nth"])
            batch["shard"] = [tree.shard(s, earlier[s, e] + n) for s, e, n in at]
            yield batch[["source_no", "block", "repetition", "words", "left", "shard"]]

    dealt = stage(
        drawn.mapInPandas(
            deal, "source_no int, block long, repetition int, words long, left long, shard long"
        ),
        "dealt-blocks",
    )
    carried = ["row"] if carry else []
    drawn_from = place(plain) if carry else placed
    taken = drawn_from.filter("size > 0").join(F.broadcast(dealt), ["source_no", "block"])
    whole = taken.filter("left >= words").withColumn("taken", F.col("size"))
    inside = Window.partitionBy("source_no", "block", "repetition").orderBy("place", "doc_id", "size", "row_no")
    part = (
        taken.filter("left < words")
        .withColumn(
            "taken",
            F.least(
                F.col("size"),
                F.col("left") - F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) + F.col("size"),
            ),
        )
        .filter("taken > 0")
    )
    columns = ["row_no", "doc_id", "size", "place", "shard", "repetition", "taken", *carried]
    draws = whole.select(columns).unionByName(part.select(columns))
    return placed.select("row_no", "doc_id", "source", "size", "source_size", "target"), draws


def taken_by_document(rows: DataFrame, draws: DataFrame) -> DataFrame:
    """The documents with ``taken``, the words that the mix takes of each, repeats counted, and ``shards``.

    ``shards`` names the output shard of each draw and its words, ``shard:words`` by repetition, of which
    there are as many as the target needs; it is empty for a document that is never drawn.
    """
    each = F.transform(
        F.array_sort(F.collect_list(F.struct("repetition", "shard", "taken"))),
        lambda d: F.concat_ws(":", d["shard"], d["taken"]),
    )
    sums = draws.groupBy("row_no").agg(F.sum("taken").alias("taken"), F.array_join(each, ",").alias("shards"))
    return rows.join(sums, "row_no", "left").withColumns(
        {"taken": F.coalesce("taken", F.lit(0)).cast("bigint"), "shards": F.coalesce("shards", F.lit(""))}
    )


def materialise(draws: DataFrame, *, text: str = "text", n_chars: str = "n_chars", seed: int = 7) -> DataFrame:
    """The mixed documents, shard by shard in random order, with the columns of the input.

    A document that is drawn in part keeps its first ``taken`` words.
    """

    def first_words(t: Column, n: Column) -> Column:
        each = F.regexp_extract_all(t, F.lit(f"({GAP}|^)[^\\x20\\x09-\\x0D]+"), 0)
        return F.array_join(F.slice(each, F.lit(1), n.cast("int")), "")

    old = F.col(f"row.`{text}`")
    new = F.when(F.col("taken") < F.col("size"), first_words(old, F.col("taken"))).otherwise(old)
    row = F.col("row").withField(f"`{text}`", new)
    fields = draws.schema["row"].dataType
    if n_chars in fields.fieldNames():
        kind = fields[n_chars].dataType
        row = row.withField(
            f"`{n_chars}`",
            F.when(F.col("taken") < F.col("size"), F.length(new).cast(kind)).otherwise(F.col(f"row.`{n_chars}`")),
        )
    return (
        draws.withColumn("row", row)
        .repartition("shard")
        .sortWithinPartitions("shard", order(seed + 2, "place", "repetition"))
        .select("row.*")
    )
