"""N-gram Jaccard join by prefixes, exact.

Each text is the set of its five-word shingles.  All shingles have one order: those that are frequent
in a sample of the texts come last, by frequency, the others by hash.  Any order gives all links, a good
one gives few candidates.  Two sets that reach the threshold share a shingle among the first
``n - ceil(threshold * n) + 1`` of each, its prefix.

Sets that share prefix shingles meet in tiles.  A set's head is the prefix shingle that most sets share;
sets of one head and of similar size make a tile, or several of bounded size.  Two tiles are compared if
any of their sets share prefix shingles, so each pair of sets is compared at most once, however many
shingles it shares and however large its group is.  Only those parts of two tiles come together, sets
of about one size, whose sizes and number of shared prefix shingles allow a link: shingles that texts
share by chance grow with the square of the input, but few of them pass.  Bits of parity bound how much
a pair differs; what passes the bound is compared by its whole sets.  A pair of tiles reports a spanning
forest of its links and how many links each set has, not all pairs.  Equal sets are one node from the
start.

Groups of similar texts cost comparisons with the square of their size, in tasks of bounded size.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventmill.llm.common import MAP_ROWS, keyed, stage, without

WIDTH = 5
#: Sets of a tile, about.
CHUNK = 240
#: Shingles of a tile's sets together, about.
TILE_SHINGLES = 2_000_000
#: Parts, by size, of the sets of a tile.
PARTS = 16
#: Texts, about, whose shingles are counted for the order, and shingles that are known as frequent.
SAMPLE_TEXTS = 8192
FREQUENT = 50_000
FREQUENT_FROM = 3
CACHED_WORDS = 400_000

_MIX = [np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]
_PLACE = np.array([xxhash.xxh64_intdigest(f"place{i}") | 1 for i in range(WIDTH)], dtype=np.uint64)
_LAST = np.uint64(1 << 63)
#: Rounding of a product with the threshold never unlinks a pair.
SLACK = 1e-9


class WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(33))


def shingles(text: str, hashes: WordHash) -> np.ndarray:
    """Sorted distinct shingle hashes.  A text of one to four words is one shingle."""
    ws = text.lower().encode("utf-8", "replace").split()
    if not ws:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(hashes.__getitem__, ws), dtype=np.uint64, count=len(ws))
    n = max(len(h) - WIDTH + 1, 1)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(min(WIDTH, len(h))):
        total += h[i : i + n] * _PLACE[i]
    return np.unique(mixed(total + np.uint64(min(len(h), WIDTH))))


def sample_shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(shingle, c): in how many texts of a batch each shingle is."""
    hashes = WordHash()
    for batch in batches:
        sets = [shingles(t, hashes) for t in batch["text"]]
        found, c = np.unique(np.concatenate([*sets, np.zeros(0, dtype=np.uint64)]), return_counts=True)
        yield pd.DataFrame({"shingle": found.view(np.int64), "c": c})


def frequent_shingles(texts: DataFrame) -> np.ndarray:
    """Shingles of many texts of a sample of bounded size, the rarer ones first, at most ``FREQUENT``."""
    share = max(1, texts.count() // SAMPLE_TEXTS)
    sample = texts.select("text").filter(F.pmod(F.xxhash64("text"), F.lit(share)) == 0).distinct()
    rows = (
        sample.mapInPandas(sample_shingles, "shingle long, c long")
        .groupBy("shingle")
        .agg(F.sum("c").alias("c"))
        .filter(F.col("c") >= FREQUENT_FROM)
        .orderBy(F.desc("c"), "shingle")
        .limit(FREQUENT)
        .collect()
    )
    return np.array([r["shingle"] for r in rows[::-1]], dtype=np.int64).view(np.uint64)


def prefix_size(n: int, threshold: float) -> int:
    return n - math.ceil(threshold * n - SLACK) + 1


def parities(s: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls into each of 2 ** k >= 2 * len(s) cells, as bits.

    Two sets differ in at least as many shingles as their bits do.
    """
    cells = max(64, 1 << (2 * len(s) - 1).bit_length())
    odd = np.bincount((s & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The bits of fewer cells."""
    while len(bits) > words:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def sketch(frequent, threshold: float):
    """(node, doc_id, row_no, md5, digest, n, prefix, often, odd); the digest is null for texts without words.

    A prefix holds places in the common order, ascending as unsigned numbers; those of frequent
    shingles are negative as signed ones and stand in ``often``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, often = WordHash(), frequent.value
        rank = np.argsort(often).astype(np.uint64)
        often = np.sort(often)
        for batch in batches:
            digests, counts, prefixes, frequent_places, odd = [], [], [], [], []
            for text in batch["text"]:
                s = shingles(text, hashes)
                counts.append(len(s))
                if not len(s):
                    digests.append(None)
                    prefixes.append(None)
                    frequent_places.append(None)
                    odd.append(None)
                    continue
                odd.append(parities(s).tobytes())
                digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                place = s >> np.uint64(1)
                if len(often):
                    at = np.minimum(np.searchsorted(often, s), len(often) - 1)
                    known = often[at] == s
                    place = np.concatenate([place[~known], np.sort(rank[at[known]]) | _LAST])
                place = place[: prefix_size(len(s), threshold)].view(np.int64)
                cut = len(place) - int((place < 0).sum())
                prefixes.append(place[:cut])
                frequent_places.append(place[cut:])
            yield pd.DataFrame(
                {k: batch[k] for k in ("node", "doc_id", "row_no", "md5")}
                | {"digest": digests, "n": counts, "prefix": prefixes, "often": frequent_places, "odd": odd}
            )

    return run


def tiles(sets: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(tile, part, node) of the sets that share prefix shingles, and (pair, side, tile, part) to compare.

    ``sets`` has node, n, prefix and often.
    """
    # Frequent shingles are few, and some are in very many prefixes: these rows stay where they are.
    hot = sets.select("node", "n", F.explode("often").alias("place"))
    often = hot.groupBy("place").agg(F.count("*").alias("members"))
    rare = sets.select("node", "n", F.explode("prefix").alias("place")).withColumn(
        "members", F.count("*").over(W.partitionBy("place"))
    )
    shared = stage(
        hot.join(F.broadcast(often), "place").unionByName(rare, allowMissingColumns=True).filter("members > 1"),
        "shared",
    )
    # Linked sets are of one class or of neighbouring ones.
    width = max(1.01 * math.log(1 / threshold), 0.01)
    heads = stage(
        shared.groupBy("node").agg(
            F.max(F.struct("members", "place"))["place"].alias("head"),
            F.floor(F.log(F.first("n")) / width).cast("int").alias("size_class"),
            F.floor(F.log(F.first("n")) / width * PARTS).cast("int").alias("part"),
            F.first("n").alias("n"),
            F.collect_list("place").alias("places"),  # as many as the prefix has, at most
        ),
        "heads",
    )
    crowds = stage(
        heads.groupBy("head", "size_class")
        .agg(F.ceil(F.greatest(F.count("*") / CHUNK, F.sum("n") / TILE_SHINGLES)).alias("chunks"))
        .filter("chunks > 1"),
        "crowds",
    )
    chunk = F.pmod(F.xxhash64("node"), F.coalesce("chunks", F.lit(1).cast("bigint")))
    of = stage(
        heads.join(crowds, ["head", "size_class"], "left").select(
            F.xxhash64("head", "size_class", chunk).alias("tile"), "part", "node", "n", "places"
        ),
        "tiles",
    )
    met = stage(
        of.select("tile", "part", "n", F.explode("places").alias("place"))
        .groupBy("place", "tile", "part")
        .agg(F.min("n").alias("least"), F.max("n").alias("most")),
        "tile-shingles",
    )
    # Sets of a and b shingles, a >= b, reach the threshold only if b >= t * a and their prefixes share at
    # least t / (1 + t) * (b - t * a) shingles, whichever prefix ends first.
    need = threshold / (1 + threshold) * (F.col("least") - threshold * F.col("most"))
    sizes = f"a.most >= {threshold!r} * b.least - 1e-6 AND b.most >= {threshold!r} * a.least - 1e-6"
    apart = stage(
        met.alias("a")
        .join(met.alias("b"), "place")
        .filter(f"a.tile < b.tile AND {sizes}")
        .groupBy(
            F.col("a.tile").alias("first"),
            F.col("a.part").alias("first_part"),
            F.col("b.tile").alias("second"),
            F.col("b.part").alias("second_part"),
        )
        .agg(
            F.count("*").alias("common"),
            F.min(F.least("a.least", "b.least")).alias("least"),
            F.max(F.greatest("a.most", "b.most")).alias("most"),
        )
        .filter(F.col("common") >= need - 1e-6)
        .select("first", "first_part", "second", "second_part"),
        "tile-parts",
    )
    inside = of.groupBy("tile").count().filter("count > 1").select(F.col("tile").alias("first"), F.col("tile").alias("second"))
    pairs = stage(
        apart.select("first", "second").distinct().unionByName(inside).withColumn("pair", F.monotonically_increasing_id()),
        "tile-pairs",
    )
    sides = [
        F.struct(F.lit(side).alias("side"), F.col(tile).alias("tile"), F.col(f"{tile}_part").alias("part"))
        for side, tile in enumerate(("first", "second"))
    ]
    across = (
        pairs.join(apart, ["first", "second"]).select("pair", F.explode(F.array(*sides)).alias("x")).select("pair", "x.*")
    ).distinct()
    own = (
        pairs.filter("first = second")
        .withColumnRenamed("first", "tile")
        .join(of.select("tile", "part").distinct(), "tile")
        .select("pair", F.lit(0).alias("side"), "tile", "part")
    )
    return of.select("tile", "part", "node"), across.unionByName(own)


def grouped(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Groups of rows that follow each other with equal key, across batches."""
    open_: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch[key].to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1), len(batch)]
        for a, b in zip(cuts, cuts[1:]):
            if open_ and open_[0][key].iloc[0] != keys[a]:
                yield pd.concat(open_) if len(open_) > 1 else open_[0]
                open_ = []
            open_.append(batch.iloc[a:b])
    if open_:
        yield pd.concat(open_) if len(open_) > 1 else open_[0]


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of 0/1 matrices over the shared shingles."""
    m = len(sets)
    if m == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]])
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    use = shared[column]
    owner, column = owner[use], number[column[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    result = np.zeros((m, m), dtype=np.int64)
    for start in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        block = np.zeros((m, 4096), dtype=np.float32)
        block[owner[a:b], column[a:b] - start] = 1
        result += np.rint(block @ block.T).astype(np.int64)
    return result


def to_compare(side: np.ndarray) -> np.ndarray:
    """Which members of a pair of tiles are compared: those of different tiles, or all of a single tile."""
    if side.min() == side.max():
        return ~np.eye(len(side), dtype=bool)
    return side[:, None] != side[None, :]


def alike_parities(threshold: float):
    """Members of sorted pairs of tiles whose parities allow a link with another member."""
    share = (1 - threshold) / (1 + threshold)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in grouped(batches, "pair"):
            if len(group) < 2:
                continue
            n = group["n"].to_numpy().astype(np.int64)
            bits = [np.frombuffer(x, dtype=np.uint64) for x in group["odd"]]
            words = min(map(len, bits))
            bits = np.stack([folded(x, words) for x in bits])
            apart = np.stack([np.bitwise_count(bits ^ x).sum(axis=1, dtype=np.int64) for x in bits])
            may = apart <= share * (n[:, None] + n[None, :]) + 1e-6
            active = (may & to_compare(group["side"].to_numpy())).any(axis=1)
            if active.any():
                yield group.loc[active, ["pair", "side", "node"]]

    return run


def links(threshold: float):
    """Links of sorted pairs of tiles with exact Jaccard similarity of the threshold or more.

    Rows (a, b, n) with b are spanning links; rows without b say how many documents of the pair of
    tiles link with set a.
    """

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in grouped(batches, "pair"):
            if len(group) < 2:
                continue
            # By node, so that a dense group hangs on the same few sets in every pair of tiles.
            group = group.sort_values("node")
            nodes = group["node"].tolist()
            sets = [np.frombuffer(s, dtype=np.uint64) for s in group["shingles"]]
            size = np.array([len(s) for s in sets])
            both = overlaps(sets)
            union = size[:, None] + size[None, :] - both
            linked = (both >= threshold * union - SLACK) & to_compare(group["side"].to_numpy())
            seen = np.zeros(len(sets), dtype=bool)
            rows = []
            for root in range(len(sets)):
                if seen[root]:
                    continue
                seen[root] = True
                edge = deque([root])
                while edge:
                    at = edge.popleft()
                    for other in np.flatnonzero(linked[at] & ~seen):
                        seen[other] = True
                        edge.append(int(other))
                        rows.append((nodes[at], nodes[int(other)], 0))
            if not rows:
                continue
            number = linked @ group["copies"].to_numpy()
            rows += [(nodes[k], None, int(number[k])) for k in np.flatnonzero(number)]
            out = pd.DataFrame(rows, columns=["a", "b", "n"])
            out["b"] = out["b"].astype("Int64")
            yield out

    return solve


def shingle_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHash()
    for batch in batches:
        sets = [shingles(t, hashes).tobytes() for t in batch["text"]]
        yield pd.DataFrame({"node": batch["node"], "shingles": sets})


def marked(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose md5 may be among the wanted ones: all that are, and few others.

    Wanted digests are marked in a bit map of ``MAP_ROWS`` rows, so what is broadcast does not grow
    with the data.  A fuller map lets more rows through to the join that follows, and loses none.
    """
    at = F.pmod(F.xxhash64("md5"), F.lit(MAP_ROWS))
    bit = F.pmod(F.xxhash64("md5", F.lit(1)), F.lit(64)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    bits = wanted.groupBy(at.alias("map_row")).agg(F.bit_or(one).alias("bits"))
    return (
        rows.withColumn("map_row", at)
        .join(F.broadcast(bits), "map_row")
        .filter(F.getbit("bits", bit) == 1)
        .drop("map_row", "bits")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of (a, b) is connected to.

    Each round takes the smallest label among neighbours and then the label's own label, so paths
    shorten by halves; its result is written to the shared folder.
    """
    both = stage(edges.union(edges.select("b", "a")).toDF("a", "b").distinct(), "links")
    labels = stage(both.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")), "labels")
    while True:
        least = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("least"))
        )
        near = stage(
            labels.join(least, "node").select("node", F.col("label").alias("old"), F.least("label", "least").alias("label")),
            "near-labels",
        )
        hop = near.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = stage(near.join(hop, "label").select("node", "old", F.col("further").alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            return labels


def classes(
    docs: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    row_no: str | None = None,
    threshold: float = 0.8,
) -> DataFrame:
    """One row per document: doc_id, row_no, class_id, n_links and class_key, null without words.

    ``class_id`` is the smallest id among the documents that links connect; ``n_links`` counts the other
    documents that a document links with, those with the same shingles too.  Both are exact.  Words are
    compared in lower case.  Texts without words, null ones too, are
    classes of their own with no links; a null id counts as the largest, and a class of null ids
    only has a null class_id.  Repeated rows are copies
    of each other.  An empty table gives no rows.  Other columns are left out, whatever their names.
    """
    number = F.col(row_no) if row_no else F.monotonically_increasing_id()
    number_type = docs.schema[row_no].dataType.simpleString() if row_no else "bigint"
    plain = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        number.alias("row_no"),
        F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("md5"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(plain))
    sketched = stage(
        plain.select(F.monotonically_increasing_id().alias("node"), "*").mapInPandas(
            sketch(frequent, threshold),
            f"node long, doc_id long, row_no {number_type}, md5 binary, digest binary, n int, prefix array<long>, "
            "often array<long>, odd binary",
        ),
        "sketches",
    )
    wordy = sketched.filter("digest IS NOT NULL")
    # Names and digests move; prefixes and bits, which are much more, are read where they lie.
    nodes = stage(
        wordy.groupBy("digest")
        .agg(
            F.min(F.struct("md5", "doc_id", "node")).alias("one"),
            F.min("doc_id").alias("least_id"),
            F.count("*").alias("copies"),
        )
        .select("digest", "one.*", "least_id", "copies"),
        "sets",
    )
    repeated = stage(wordy.select("node").join(nodes.select("node"), "node", "left_anti"), "repeated")

    def texts(wanted: DataFrame) -> DataFrame:
        """(node, text) of some nodes."""
        wanted = stage(wanted.join(nodes.select("node", "md5", "doc_id"), "node"), "wanted")
        return (
            marked(plain.select("md5", "doc_id", "text"), wanted)
            .alias("t")
            .join(wanted.alias("w"), F.expr("t.md5 = w.md5 AND t.doc_id <=> w.doc_id"))
            .select("node", "text")
            .dropDuplicates(["node"])
        )

    of, parts = tiles(without(wordy.select("node", "n", "prefix", "often"), repeated, "node"), threshold)
    members = parts.join(of.join(sketched.select("node", "n", "odd"), "node"), ["tile", "part"])
    alike = stage(
        members.select("pair", "side", "node", "n", "odd")
        .repartition("pair")
        .sortWithinPartitions("pair")
        .mapInPandas(alike_parities(threshold), "pair long, side int, node long"),
        "alike",
    )
    sets = texts(alike.select("node").distinct()).mapInPandas(shingle_sets, "node long, shingles binary")
    known = sets.join(nodes.select("node", "copies"), "node")
    found = stage(
        alike.join(known, "node")
        .repartition("pair")
        .sortWithinPartitions("pair")
        .mapInPandas(links(threshold), "a long, b long, n long"),
        "links",
    )
    edges = found.filter("b IS NOT NULL").select("a", "b")
    degree = found.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    labelled = (
        nodes.select("node", "digest", "least_id", "copies")
        .join(components(edges).withColumnRenamed("label", "class_node"), "node", "left")
        .join(degree, "node", "left")
        .withColumn("label", F.coalesce("class_node", "node"))
    )
    of_class = labelled.groupBy("label").agg(F.min("least_id").alias("class_id"))
    per_set = stage(
        labelled.join(of_class, "label").select(
            "digest", "label", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
        ),
        "classes",
    )
    return (
        sketched.select("doc_id", "row_no", "digest")
        .join(per_set, "digest", "left")
        .select(
            "doc_id",
            "row_no",
            F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.col("label").alias("class_key"),
        )
    )


def keep_one(docs: DataFrame, **names) -> DataFrame:
    """The documents with one of each class, the first by id, with the columns of the input."""
    rows = keyed(docs)
    text, doc_id = names.pop("text", "text"), names.pop("doc_id", "doc_id")
    flat = rows.select("row_key", F.col(f"row.`{doc_id}`").alias("doc_id"), F.col(f"row.`{text}`").alias("text"))
    found = stage(classes(flat, row_no="row_key", **names), "document-classes")
    best = found.filter("class_key IS NOT NULL").groupBy("class_key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_no"))["row_no"].alias("row_no"),
    )
    rest = found.filter("class_key IS NOT NULL").select("row_no").join(best.select("row_no"), "row_no", "left_anti")
    return without(rows, stage(rest.withColumnRenamed("row_no", "row_key"), "dropped"), "row_key").select("row.*")
