"""Prefix trie of conversations with subtree totals by time-forward processing.

A prefix of d turns is named by the sums of its turns' hashes (two of 64 bits, each over place, role
and text), so prefixes of a conversation of any length come from running sums over chunks of it,
and nodes from one aggregate.

Totals go up the trie by time-forward processing: a task has its shard's nodes sorted by reverse
level order (Spark's external sort) and sends each node's totals forward to its parent through a
priority queue that spills.  Nodes that more than ``light`` conversations share are few (rows over
``light``) and are shards of their own; below them, a shard is a subtree cut every ``band`` levels,
so it is of bounded size however popular a first turn or however long a conversation is.  Then the
shard roots send their totals to the shards above them; as chains of shards may be long, a message
covers 1, 2, 4 ... shards a round.  Shards with others below them pass their totals once more.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmill.llm.common import join_split, stage, words

SHARED = 20
MOST_BORROWED = 4
CHUNK = 4096
LIGHT = 1024
BAND = 1024
SHARD_NODES = 500_000
QUEUE = 200_000
IDS_A_BLOCK = 512


class SpillingQueue:
    """A priority queue of tuples that holds about ``limit`` of them and the rest in sorted runs on disk.

    Like Spark's own spills, the runs are nameless files of the task and vanish with it.
    """

    def __init__(self, limit: int = QUEUE):
        self.limit = limit
        self.held: list[tuple] = []
        self.heads: list[tuple] = []  # (first item of a run, its number, the run)
        self.spills = 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.held, item)
        if len(self.held) > self.limit:
            self._spill()

    def _spill(self) -> None:
        # A sorted list is a heap, so the first half stays and the later half becomes a run.
        self.held.sort()
        keep = self.limit // 2
        file = tempfile.TemporaryFile()
        for a in range(keep, len(self.held), 1000):
            pickle.dump(self.held[a : a + 1000], file)
        del self.held[keep:]
        file.seek(0)
        self.spills += 1
        self._advance(self._read(file), self.spills)

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def _advance(self, run: Iterator[tuple], number: int) -> None:
        head = next(run, None)
        if head is not None:
            heapq.heappush(self.heads, (head, number, run))

    def first(self) -> tuple | None:
        if self.heads and (not self.held or self.heads[0][0] < self.held[0]):
            return self.heads[0][0]
        return self.held[0] if self.held else None

    def pop(self) -> tuple:
        if self.heads and (not self.held or self.heads[0][0] < self.held[0]):
            head, number, run = heapq.heappop(self.heads)
            self._advance(run, number)
            return head
        return heapq.heappop(self.held)


def forward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(a, b, leaves, saved): totals of the nodes of sorted shards, deepest first, then by name.

    A message has the order of the node it is for, so it is on top of the queue when that node comes.
    """
    queue: SpillingQueue | None = None
    shard = None
    for batch in batches:
        leaves, saved = [], []
        columns = (batch[c].tolist() for c in ("shard", "depth", "a", "b", "up_a", "up_b", "same", "leaves", "saved"))
        for at, depth, a, b, up_a, up_b, same, n, words_ in zip(*columns):
            if at != shard:
                queue, shard = SpillingQueue(), at
            me = (-depth, a, b)
            while (message := queue.first()) is not None and message[:3] <= me:
                queue.pop()
                if message[:3] == me:
                    n, words_ = n + message[3], words_ + message[4]
            leaves.append(n)
            saved.append(words_)
            if same:
                queue.push((1 - depth, up_a, up_b, n, words_))
        yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "leaves": leaves, "saved": saved})


def pass_up(nodes: DataFrame, shards: int) -> DataFrame:
    """Totals inside shards.  A node goes to its top's shard and sends up while it is not the top."""
    return (
        nodes.withColumn("shard", F.pmod(F.xxhash64("top_a", "top_b"), F.lit(shards)))
        .withColumn("same", (F.col("a") != F.col("top_a")) | (F.col("b") != F.col("top_b")))
        .select("shard", "depth", "a", "b", "up_a", "up_b", "same", "leaves", "saved")
        .repartition("shard")
        .sortWithinPartitions("shard", F.desc("depth"), "a", "b")
        .mapInPandas(forward, "a decimal(38,0), b decimal(38,0), leaves long, saved long")
    )


def across(tops: DataFrame) -> DataFrame:
    """Totals (a, b, leaves, saved) of shard roots with all below them; ``up_a``, ``up_b`` is the root above.

    After k rounds a root has the totals of all that lie less than 2 ** k shards below it.
    """
    total = stage(tops.select("a", "b", "leaves", "saved", "up_a", "up_b"), "roots")
    while True:
        sent = (
            total.filter("up_a IS NOT NULL")
            .groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b"))
            .agg(F.sum("leaves").cast("bigint").alias("more_leaves"), F.sum("saved").cast("bigint").alias("more_saved"))
        )
        above = total.select(
            F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("up_a").alias("next_a"), F.col("up_b").alias("next_b")
        )
        total = stage(
            total.join(sent, ["a", "b"], "left")
            .join(above, ["up_a", "up_b"], "left")
            .select(
                "a",
                "b",
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
                F.col("next_a").alias("up_a"),
                F.col("next_b").alias("up_b"),
            ),
            "roots",
        )
        if total.filter("up_a IS NOT NULL").isEmpty():
            return total.select("a", "b", "leaves", "saved")


def places(turns: DataFrame) -> DataFrame:
    """The turns with ``place`` in their conversation, from 1, however long it is."""
    order = [F.col("conv_id"), F.col("turn"), F.col("digest")]
    numbered = stage(
        turns.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", "digest", "n_words", F.monotonically_increasing_id().alias("row_no")),
        "turns",
    ).withColumn("task", F.shiftright("row_no", 33))
    spans = numbered.groupBy("conv_id", "task").agg(F.min("row_no").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("place_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return (
        numbered.alias("t")
        .join(spans.alias("s"), F.expr("t.conv_id <=> s.conv_id AND t.task = s.task"))
        .select("t.conv_id", "digest", "n_words", F.expr("row_no - first + place_before + 1").alias("place"))
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations with n_turns, turns with depth): a shared start from another one, then the own rest."""
    placed = stage(places(turns), "places")
    convs = placed.groupBy("conv_id").agg(F.max("place").alias("own"))
    crc = F.coalesce(F.crc32(F.col("conv_id").cast("string")), F.lit(0))
    convs = convs.withColumn("h", F.pmod(crc, F.lit(MOST_BORROWED))).withColumn(
        "donor", F.expr(f"conv_id - conv_id % {SHARED}")
    )
    lengths = convs.select(F.col("conv_id").alias("donor"), F.col("own").alias("donor_turns"))
    convs = stage(
        convs.join(lengths, "donor", "left")
        .withColumn("given", F.least("h", F.coalesce("donor_turns", F.lit(0))))
        .withColumn("n_turns", F.col("given") + F.greatest(F.col("own") - F.col("h"), F.lit(0))),
        "conversations",
    )
    total = placed.count()
    starts = placed.filter(F.col("place") < MOST_BORROWED).select(
        F.col("conv_id").alias("donor"), "place", "digest", "n_words"
    )
    borrowed = (
        convs.filter("given > 0")
        .select("conv_id", "donor", F.explode(F.expr("sequence(1L, given)")).alias("place"))
        .join(starts, ["donor", "place"])
        .select("conv_id", F.col("place").alias("depth"), "digest", "n_words")
    )
    shifts = convs.select("conv_id", F.col("own").alias("n"), "h", "given")
    own = (
        join_split(placed, shifts, ["conv_id"], total)
        .filter("place > h")
        .select("conv_id", F.expr("place - h + given").alias("depth"), "digest", "n_words")
    )
    return convs.select("conv_id", "n_turns"), own.unionByName(borrowed)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, up_a, up_b, n_words): the names of each turn's prefix and of the one before."""
    parts = stage(
        turns.select(
            "conv_id",
            "depth",
            "n_words",
            F.floor((F.col("depth") - 1) / CHUNK).alias("chunk"),
            *[F.xxhash64(F.lit(i), "depth", "digest").cast("decimal(38,0)").alias(k) for i, k in ((1, "a"), (2, "b"))],
        ),
        "turn-hashes",
    )
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)

    def total(column, window):
        return F.sum(column).over(window).cast("decimal(38,0)")

    zero = F.lit(0).cast("decimal(38,0)")
    chunks = (
        parts.groupBy("conv_id", "chunk")
        .agg(F.sum("a").cast("decimal(38,0)").alias("a"), F.sum("b").cast("decimal(38,0)").alias("b"))
        .select("conv_id", "chunk", *[F.coalesce(total(k, earlier), zero).alias(f"{k}0") for k in "ab"])
    )
    inside = Window.partitionBy("conv_id", "chunk").orderBy("depth")
    sums = parts.select("*", *[total(k, inside).alias(f"{k}1") for k in "ab"])
    return (
        sums.alias("s")
        .join(chunks.alias("c"), F.expr("s.conv_id <=> c.conv_id AND s.chunk = c.chunk"))
        .select(
            "s.conv_id",
            "depth",
            "n_words",
            *[(F.col(f"{k}0") + F.col(f"{k}1")).cast("decimal(38,0)").alias(k) for k in "ab"],
            *[(F.col(f"{k}0") + F.col(f"{k}1") - F.col(k)).cast("decimal(38,0)").alias(f"up_{k}") for k in "ab"],
        )
    )


def id_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (a, b, id, row_no) as blocks of ids joined by commas; a null id is empty and last."""
    for batch in batches:
        rows: list[tuple] = []  # (a, b, row_no of the first, ids)
        for a, b, row_no, one in zip(batch["a"], batch["b"], batch["row_no"], batch["id"]):
            if not rows or rows[-1][:2] != (a, b) or len(rows[-1][3]) == IDS_A_BLOCK:
                rows.append((a, b, row_no, []))
            rows[-1][3].append(one)
        yield pd.DataFrame([(*r[:3], ",".join(r[3])) for r in rows], columns=["a", "b", "row_no", "ids"])


def id_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One digest for each node of sorted blocks; only the hash's state is held."""
    last, state = None, None

    def row():
        return pd.DataFrame([(*last, state.hexdigest())], columns=["a", "b", "ends_sha256"])

    for batch in batches:
        done = []
        for a, b, ids in zip(batch["a"], batch["b"], batch["ids"]):
            if (a, b) != last:
                if last is not None:
                    done.append(row())
                last, state = (a, b), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield pd.concat(done)
    if last is not None:
        yield row()


def ends(full: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) of the nodes where conversations (a, b, conv_id) end.

    A digest of many ids is one chain of updates.  Ids are sorted and joined in blocks by many tasks;
    the chain itself reads one row for up to 512 ids and holds none.
    """
    order = ["a", "b", F.col("conv_id").asc_nulls_last()]
    sorted_ids = (
        full.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "a", "b", F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("id"),
            F.monotonically_increasing_id().alias("row_no"),
        )
    )
    name = "a decimal(38,0), b decimal(38,0)"
    blocks = stage(sorted_ids.mapInPandas(id_blocks, f"{name}, row_no long, ids string"), "end-blocks")
    return (
        blocks.repartition("a", "b")
        .sortWithinPartitions("a", "b", "row_no")
        .mapInPandas(id_digests, f"{name}, ends_sha256 string")
    )


def nodes(
    rows: DataFrame,
    *,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    light: int = LIGHT,
    band: int = BAND,
) -> DataFrame:
    """One row per trie node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations are ordered by turn, null first, equal turns by the hash of role and text; a null
    role or text is empty.  Each begins with up to three turns of the one whose id is the last
    multiple of 20 (towards 0), by its id's CRC.  A null id is a conversation of its own that borrows
    nothing, the largest id, and empty in lists of ids.  Repeated rows are turns like others.  The
    root has depth 0; an empty table has no nodes.  Other columns are left out, whatever their names.
    """
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    turns = rows.select(
        F.col(conv_id).cast("bigint").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_), 256)).alias("digest"),
        F.size(words(text_)).cast("bigint").alias("n_words"),
    )
    convs, turned = rebuilt(turns)
    path = stage(prefixes(turned), "prefixes")
    names = ["a", "b"]
    node = stage(
        path.groupBy(*names).agg(
            F.min("conv_id").alias("conv_id"),
            F.first("depth").alias("depth"),
            F.first("up_a").alias("up_a"),
            F.first("up_b").alias("up_b"),
            F.first("n_words").alias("n_words"),
            F.count("*").alias("n_convs"),
        ),
        "nodes",
    )
    children = node.groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count("*").alias("n_children"))
    total = node.count()

    # The first light level of each conversation that has heavy nodes; elsewhere it is 1.
    heavy = stage(node.filter(F.col("n_convs") > light).select(*names, F.col("n_convs").alias("n")), "heavy")
    on_heavy = join_split(path.select("conv_id", "depth", *names), heavy, names, path.count())
    levels = on_heavy.groupBy("conv_id").agg((F.max("depth") + 1).alias("light_from"))
    owned = node.groupBy("conv_id").agg(F.count("*").alias("n")).join(levels, "conv_id")
    seen = stage(
        join_split(node, owned, ["conv_id"], total, how="left")
        .withColumn("light_from", F.coalesce("light_from", F.lit(1)))
        .withColumn("is_light", F.col("n_convs") <= light),
        "levels",
    )

    def top_depth(depth: str) -> str:
        return f"greatest(light_from, {depth} - {depth} % {band})"

    def at(level, prefix):
        """The name of a conversation's prefix at a level."""
        return path.select(
            F.col("conv_id").alias("c"), F.col("depth").alias("l"), *[F.col(k).alias(f"{prefix}_{k}") for k in names]
        ), F.expr(f"conv_id <=> c AND {level} = l")

    light_nodes = seen.filter("is_light").withColumn("top_level", F.expr(top_depth("depth")))
    lookup, on = at("top_level", "top")
    pieces = stage(
        light_nodes.join(lookup, on)
        .drop("c", "l")
        .join(children, names, "left")
        .withColumn("leaves", F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("n_words")),
        "pieces",
    )
    shards = max(1, -(-total // SHARD_NODES))
    local = stage(pass_up(pieces, shards), "local-totals")

    # Shard roots are heavy nodes, the trie's root and tops of light subtrees.  A top with no shard
    # below it is complete; those under one node are added up first.
    tops = stage(
        pieces.filter("a = top_a AND b = top_b")
        .drop("leaves", "saved")
        .join(local, names)
        .withColumn("hangs", F.col("depth") > F.col("light_from"))
        .withColumn("above_level", F.expr(f"IF(hangs, {top_depth('(depth - 1)')}, NULL)")),
        "tops",
    )
    lookup, on = at("above_level", "above")
    hung = stage(tops.filter("hangs").join(lookup, on).drop("c", "l"), "hung-shards")
    above = hung.select(F.col("above_a").alias("a"), F.col("above_b").alias("b")).distinct()
    under_heavy = tops.filter("NOT hangs")
    added = (
        under_heavy.join(above, names, "left_anti")
        .groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b"))
        .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    )

    def plus(column: str):
        return (F.col(column) + F.coalesce(f"more_{column}", F.lit(0))).cast("bigint").alias(column)

    zero, none = (F.lit(x).cast("decimal(38,0)") for x in (0, None))
    summary = convs.agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("n_turns").alias("longest")
    ).filter("n_convs > 0")
    tall = (
        seen.filter("NOT is_light")
        .join(children, names, "left")
        .select(
            *names,
            F.when(F.col("n_children").isNull(), 1).otherwise(0).alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved"),
            "up_a",
            "up_b",
        )
        .unionByName(
            summary.select(
                zero.alias("a"),
                zero.alias("b"),
                F.when(F.col("longest") == 0, 1).otherwise(0).alias("leaves"),
                F.lit(0).cast("bigint").alias("saved"),
                none.alias("up_a"),
                none.alias("up_b"),
            )
        )
        .join(added, names, "left")
        .select(*names, plus("leaves"), plus("saved"), "up_a", "up_b")
    )
    linked = under_heavy.join(above, names).select(*names, "leaves", "saved", "up_a", "up_b")
    chained = hung.select(*names, "leaves", "saved", F.col("above_a").alias("up_a"), F.col("above_b").alias("up_b"))
    at_roots = across(tall.unionByName(linked).unionByName(chained))

    # Shards with others below them pass their totals once more, with those of the shards below.
    if hung.isEmpty():
        inner = local
    else:
        again = above.toDF("top_a", "top_b")
        more = (
            hung.select(*names, "up_a", "up_b")
            .join(at_roots, names)
            .groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b"))
            .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        )
        redone = pass_up(
            pieces.join(again, ["top_a", "top_b"])
            .join(more, names, "left")
            .withColumns({"leaves": plus("leaves"), "saved": plus("saved")}),
            shards,
        )
        settled = pieces.join(again, ["top_a", "top_b"], "left_anti").select(*names).join(local, names)
        inner = settled.unionByName(redone)
    tall_names = heavy.select(*names).unionByName(summary.select(zero.alias("a"), zero.alias("b")))
    totals = inner.unionByName(tall_names.join(at_roots, names))
    complete = (
        convs.filter("n_turns > 0")
        .alias("e")
        .join(path.alias("p"), F.expr("e.conv_id <=> p.conv_id AND e.n_turns = p.depth"))
        .select("p.a", "p.b", "p.conv_id")
        .unionByName(convs.filter("n_turns = 0").select(zero.alias("a"), zero.alias("b"), "conv_id"))
    )
    every = node.select("conv_id", "depth", *names, "up_a", "up_b", "n_convs").unionByName(
        summary.select(
            "conv_id",
            F.lit(0).cast("bigint").alias("depth"),
            zero.alias("a"),
            zero.alias("b"),
            none.alias("up_a"),
            none.alias("up_b"),
            "n_convs",
        )
    )
    parents = stage(every.select(*names, F.col("conv_id").alias("parent_conv_id")), "parents")
    up = children.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("n_children").alias("n")).join(
        parents.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), "parent_conv_id"), ["up_a", "up_b"]
    )
    with_parent = join_split(stage(every, "every-node"), up, ["up_a", "up_b"], total, how="left")
    return (
        with_parent.join(children, names, "left")
        .join(totals, names)
        .join(ends(complete), names, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )
