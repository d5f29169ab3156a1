"""Near duplicates among vectors by PCA-ordered tiled comparison.

Equal vectors of a label become one node with a count.  Nodes are sorted by label and by their
leading principal components and cut into tiles.  Unit vectors whose cosine reaches the threshold
lie at most ``sqrt(2 - 2 * threshold)`` apart, so two tiles meet only where the boxes of their
leading components come that close.  Inside a pair of tiles products are added up with the leading
components first; what the others can still add is at most the product of the two suffix norms
(Cauchy-Schwarz), and a pair of vectors is dropped as soon as its cosine cannot reach the threshold.

A pair of tiles reports the number of links of each node and a spanning forest, never all links,
so a group in which all are near each other costs rows in proportion to its size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmill.llm.codes import finite
from eventmill.llm.common import join_split, stage
from eventmill.llm.jaccard_join import components, grouped

LEADING = 3
TILE = 4096
#: Bytes of a tile's rotated vectors, at most; long vectors have smaller tiles.
TILE_BYTES = 1 << 24
#: Vectors of more components are compared in the order of their columns, as the matrix would grow.
MOST_ROTATED = 1024
STEP = 128
#: Beyond the rounding of sums of double products.
SLACK = 1e-9
SALTS = 32


def unit(vectors: list[np.ndarray], size: int) -> np.ndarray:
    """Rows of length one in double precision, zero-padded."""
    x = np.zeros((len(vectors), size))
    for row, v in zip(x, vectors):
        row[: len(v)] = v
    x /= np.abs(x).max(axis=1, initial=0, keepdims=True)  # no component of a square over- or underflows
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def moments(size: int):
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size))
        for batch in batches:
            x = unit(batch["vector"].tolist(), size)
            total += x.T @ x
        yield pd.DataFrame({"column": range(size), "sums": [row.tobytes() for row in total]})

    return add


def sum_columns(group: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(s) for s in group["sums"]], axis=0)
    return pd.DataFrame({"column": group["column"].iloc[:1], "sums": [total.tobytes()]})


def principal(nodes: DataFrame, size: int) -> np.ndarray:
    """Principal axes of all unit vectors as columns, the strongest first.

    Results do not depend on them, only how early pairs can be dropped.
    """
    if not 1 < size <= MOST_ROTATED:
        return np.zeros((size, 0))
    columns = (
        nodes.select("vector")
        .mapInPandas(moments(size), "column int, sums binary")
        .groupBy("column")
        .applyInPandas(sum_columns, "column int, sums binary")
        .collect()
    )
    matrix = np.zeros((size, size))
    for r in columns:
        matrix[r["column"]] = np.frombuffer(r["sums"])
    return np.linalg.eigh((matrix + matrix.T) / 2)[1][:, ::-1]


def rotated(vectors: list[np.ndarray], size: int, axes: np.ndarray) -> np.ndarray:
    x = unit(vectors, size)
    return x @ axes if axes.size else x


def leading(size: int, axes: np.ndarray, cell: float):
    """Adds the leading components ``c0`` ... and the cells of the first two, by which rows are sorted."""

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            z = np.zeros((len(batch), LEADING))
            if size:
                part = rotated(batch["vector"].tolist(), size, axes)[:, :LEADING]
                z[:, : part.shape[1]] = part
            out = {k: batch[k] for k in ("node", "label", "length", "copies", "vector")}
            out |= {f"c{i}": z[:, i] for i in range(LEADING)}
            out |= {f"g{i}": np.floor(z[:, i] / cell).astype(np.int64) for i in range(2)}
            yield pd.DataFrame(out)

    return project


def cut(rows: int):
    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Tiles of sorted rows: the next one begins with a new label or length, or when one is full."""
        tile = (TaskContext.get().partitionId() << 32) - 1
        last, held = None, 0
        for batch in batches:
            tiles, places = [], []
            for key in zip(batch["label"], batch["length"]):
                if key != last or held == rows:
                    last, held, tile = key, 0, tile + 1
                tiles.append(tile)
                places.append(held)
                held += 1
            yield batch.drop(columns=["g0", "g1"]).assign(tile=tiles, place=places)

    return number


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """The cosine of two vectors as their own components give it, sums rounded once."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return math.fsum(a * b) / (math.sqrt(math.fsum(a * a)) * math.sqrt(math.fsum(b * b)))


def alike(a: np.ndarray, b: np.ndarray, at_least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, row of b, product) of rotated unit vectors that may reach ``at_least``."""
    size = a.shape[1]
    lead = min(size, max(LEADING, size // 4))
    goal = at_least - SLACK

    def norms(x: np.ndarray, start: int) -> np.ndarray:
        return np.sqrt((x[:, start:] ** 2).sum(axis=1))

    sums = a[:, :lead] @ b[:, :lead].T
    i, j = np.nonzero(sums + norms(a, lead)[:, None] * norms(b, lead)[None, :] >= goal)
    total = sums[i, j]
    for start in range(lead, size, lead):
        stop = min(start + lead, size)
        parts = []
        for k in range(0, len(i), 1 << 16):  # bounded however many are left
            parts.append(np.einsum("ij,ij->i", a[i[k : k + 65536], start:stop], b[j[k : k + 65536], start:stop]))
        total = total + (np.concatenate(parts) if parts else 0)
        open_ = total + norms(a, stop)[i] * norms(b, stop)[j] >= goal
        i, j, total = i[open_], j[open_], total[open_]
    return i, j, total


def compare(threshold: float, size: int, axes: np.ndarray, reach: float):
    """For sorted pairs of tiles: (a, b, null) spanning links, (a, null, n) numbers of links."""

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in grouped(batches, "pair"):
            node = group["node"].to_numpy()
            copies = group["copies"].to_numpy()
            vectors = group["vector"].tolist()
            box = group[[f"c{i}" for i in range(LEADING)]].to_numpy()
            z = rotated(vectors, size, axes)
            tiles = group["tile"].to_numpy()
            split = int(np.searchsorted(tiles, tiles[-1]))  # 0 when a tile meets itself
            alone = split == 0
            rows = np.arange(len(z) if alone else split)
            count = np.zeros(len(z), dtype=np.int64)
            root = np.arange(len(z))
            links: list[tuple[int, int]] = []
            for a in range(0, len(rows), STEP):
                block = rows[a : a + STEP]
                low, high = box[block].min(axis=0) - reach, box[block].max(axis=0) + reach
                near = ((box >= low) & (box <= high)).all(axis=1)
                near[: a if alone else split] = False
                others = np.flatnonzero(near)
                if not len(others):
                    continue
                i, j, product = alike(z[block], z[others], threshold)
                i, j = block[i], others[j]
                keep = (product >= threshold) & (i < j)
                for k in np.flatnonzero((np.abs(product - threshold) <= SLACK) & (i < j)):
                    keep[k] = cosine(vectors[i[k]], vectors[j[k]]) >= threshold
                i, j = i[keep], j[keep]
                count += np.bincount(i, weights=copies[j], minlength=len(z)).astype(np.int64)
                count += np.bincount(j, weights=copies[i], minlength=len(z)).astype(np.int64)
                starts = np.flatnonzero(np.diff(i, prepend=-1))
                for at, stop in zip(starts, [*starts[1:], len(i)]):
                    mine, theirs = i[at], j[at:stop]
                    others_roots, first = np.unique(root[theirs], return_index=True)
                    for r, k in zip(others_roots, first):
                        if r != root[mine]:
                            root[root == r] = root[mine]
                            links.append((node[mine], node[theirs[k]]))
            linked = np.flatnonzero(count)
            if len(linked):
                a, b = zip(*links)
                yield pd.DataFrame(
                    {
                        "a": [*a, *node[linked]],
                        "b": pd.array([*b, *[None] * len(linked)], dtype="Int64"),
                        "n": pd.array([*[None] * len(a), *count[linked]], dtype="Int64"),
                    }
                )

    return solve


def tile_pairs(tiled: DataFrame, reach: float) -> DataFrame:
    """(pair, tile): the tiles to compare, each with itself and with those its box comes near to."""
    boxes = stage(
        tiled.groupBy("tile").agg(
            F.first("label").alias("label"),
            F.first("length").alias("length"),
            *[f(f"c{i}").alias(f"{f.__name__}{i}") for i in range(LEADING) for f in (F.min, F.max)],
        ),
        "tiles",
    )
    # A label may have many tiles: one side is dealt out over SALTS tasks, the other repeated there.
    left = boxes.withColumn("salt", F.pmod(F.xxhash64("tile"), F.lit(SALTS)))
    right = boxes.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    gap = F.lit(0.0)
    for i in range(LEADING):
        g = F.expr(f"greatest(0D, a.min{i} - b.max{i}, b.min{i} - a.max{i})")
        gap = gap + g * g
    met = (
        left.alias("a")
        .join(right.alias("b"), F.expr("a.label = b.label AND a.length = b.length AND a.salt = b.salt AND a.tile <= b.tile"))
        .filter(gap <= reach * reach)
        .select(F.monotonically_increasing_id().alias("pair"), F.col("a.tile").alias("x"), F.col("b.tile").alias("y"))
    )
    return stage(met, "tile-pairs").select("pair", F.explode(F.array_distinct(F.array("x", "y"))).alias("tile"))


def mark(
    vectors: DataFrame,
    *,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    label: str = "label",
    threshold: float = 0.98,
    tile: int = TILE,
) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Rows are linked when their labels are equal and not null, their vectors have the same length and
    their cosine, in double precision, is ``threshold`` or more, which must be above 0.
    ``n_links`` counts all rows linked directly, ``component_id`` is the smallest id that links reach
    and ``kept`` says whether it is the row's own.  Vectors that are null, empty or zero, or have null or
    non-finite components, link with nothing.  Repeated rows link with each other.  A null id counts
    as the largest; a component of null ids alone has a null component_id and is kept.  An empty table
    gives no rows.  Other columns are left out, whatever their names.
    """
    value = F.col(vector)
    usable = F.col(label).isNotNull() & finite(value) & F.coalesce(F.exists(value, lambda x: x != 0), F.lit(False))
    plain = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.when(usable, F.col(label).cast("string")).alias("label"),
        F.when(usable, F.xxhash64(F.lit(1), value)).alias("k1"),
        F.when(usable, F.xxhash64(F.lit(2), value)).alias("k2"),
        F.when(usable, value).alias("vector"),
    )
    keys = ["label", "k1", "k2"]
    rows = stage(plain.drop("vector"), "keys")
    nodes = stage(
        plain.filter("label IS NOT NULL")
        .groupBy(*keys)
        .agg(
            F.first("vector").alias("vector"),
            F.count("*").alias("copies"),
            F.min("vec_id").alias("least_id"),
        )
        .select("*", F.size("vector").alias("length"), F.monotonically_increasing_id().alias("node")),
        "nodes",
    )
    size = nodes.agg(F.max("length")).first()[0] or 0
    axes = principal(nodes, size)
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    element = "double" if "double" in dict(plain.dtypes)["vector"] else "float"
    shape = f"node long, label string, length int, copies long, vector array<{element}>"
    centres = "".join(f", c{i} double" for i in range(LEADING))
    placed = (
        nodes.select("node", "label", "length", "copies", F.col("vector").cast(f"array<{element}>").alias("vector"))
        .mapInPandas(leading(size, axes, max(reach, 1e-6)), f"{shape}{centres}, g0 long, g1 long")
    )
    order = ["label", "length", "g0", "g1", "c2", "node"]
    most = max(STEP, min(tile, TILE_BYTES // (8 * max(size, 1))))
    tiled = stage(
        placed.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInPandas(cut(most), f"{shape}{centres}, tile long, place int"),
        "tiled",
    )
    met = (
        tile_pairs(tiled, reach)
        .join(tiled.drop("label", "length"), "tile")
        .repartition("pair")
        .sortWithinPartitions("pair", "tile", "place")
    )
    found = stage(met.mapInPandas(compare(threshold, size, axes, reach), "a long, b long, n long"), "near-links")
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    labels = components(found.filter("b IS NOT NULL").select("a", "b"))
    joined = (
        nodes.select(*keys, "node", "copies", "least_id")
        .join(counts, "node", "left")
        .join(labels.withColumnRenamed("label", "root"), "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .filter("others IS NOT NULL OR copies > 1")
    )
    least = joined.groupBy("root").agg(F.min("least_id").alias("component_id"))
    linked = stage(
        joined.join(least, "root").select(
            *keys,
            F.col("copies").alias("n"),
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).cast("bigint").alias("n_links"),
            "component_id",
        ),
        "linked",
    )
    result = join_split(rows.filter("label IS NOT NULL"), linked, keys, rows.count(), how="left")
    return result.unionByName(rows.filter("label IS NULL"), allowMissingColumns=True).select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(F.col("n_links").isNull(), True)
        .otherwise(F.col("vec_id").eqNullSafe(F.col("component_id")))
        .alias("kept"),
    )
