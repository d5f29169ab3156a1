"""Vector codes, near vectors and the prefix trie: brute force, hard inputs, hot groups."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventmill.llm import codes, near_vectors, prefix_trie

VECTORS = "vec_id long, embedding array<double>, label int, code string, error string, n long, node string, row string"
TURNS = "conv_id long, turn long, role string, text string, depth string, a string, n long, digest string"


def vectors(spark, rows):
    """Rows of (vec_id, vector, label) with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, v, label, "x", "x", 1, "x", "x") for i, v, label in rows], VECTORS)


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", 1, "x") for r in rows], TURNS)


# Vector codes


def brute_codes(rows):
    """The contract in plain Python integers."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 4)

    def whole(x):
        n, d = x.as_integer_ratio()
        return 1024 * n // d

    full = [[whole(float(x)) for x in v] + [0] * (4 * width - len(v)) for _, v, _ in kept]
    parts = [[f[p * width : (p + 1) * width] for p in range(4)] for f in full]
    book = [[parts[r][p] for r in range(min(256, len(parts)))] for p in range(4)]

    def assign():
        out = []
        for x in parts:
            best = []
            for p in range(4):
                best.append(min((sum((a - b) ** 2 for a, b in zip(x[p], e)), i) for i, e in enumerate(book[p])))
            out.append(best)
        return out

    for _ in range(4):
        found = assign()
        for p in range(4):
            for e in range(len(book[p])):
                mine = [parts[r][p] for r in range(len(parts)) if found[r][p][1] == e]
                if mine:
                    book[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    found = assign()
    errors = [sum(d for d, _ in best) for best in found]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e

    def fit(e):
        return e if e < 2**63 else None

    text = ",".join(str(c) for p in book for e in p for c in e)
    return (
        sorted(
            (
                (i, "".join(f"{e:02x}" for _, e in best), fit(err), fit(by_label[label]))
                for (i, _, label), best, err in zip(kept, found, errors)
            ),
            key=repr,
        ),
        hashlib.sha256(text.encode()).hexdigest(),
    )


def codes_of(df):
    rows, book = codes.compress(df)
    found = [tuple(r) for r in rows.select("vec_id", "code", "error", "label_error").collect()]
    return sorted(found, key=repr), codes.digest(book)


def test_codes_of_random_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=20).round(2).tolist(), i % 3 if i % 7 else None) for i in range(700)]
    rows += [(i + 700, rows[5][1], 1) for i in range(400)]  # a group of copies
    assert codes_of(vectors(spark, rows)) == brute_codes(rows)


def test_codes_of_hard_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (3, [nan, 1.0], 1), (4, [inf], 2), (5, [None, 1.0], 2), (6, [0.0] * 5, None),
        (6, [0.0] * 5, None), (None, [-0.5, 0.25, 3.0], 2), (7, [-1.0, 2.0, 1e-9], None), (8, [0.3] * 6, 2),
    ]
    assert codes_of(vectors(spark, rows)) == brute_codes(rows)
    assert codes_of(vectors(spark, [(1, [], 1), (2, [], 1)])) == brute_codes([(1, [], 1), (2, [], 1)])
    assert codes_of(vectors(spark, [(1, None, 1)]))[0] == []


def test_codes_beyond_64_bits(spark):
    rows = [(i, [1e300 * i, -5e15, 2.0**60 + i, 1.5 * i], 0) for i in range(6)] + [(9, [1.0, 2.0, 3.0, 4.0], 1)]
    assert codes_of(vectors(spark, rows)) == brute_codes(rows)


@pytest.mark.parametrize("width", [1, 3, 8, 13])
def test_early_elimination_is_exact(width):
    rng = np.random.default_rng(width)
    parts, entries = rng.integers(-9, 9, (3000, width)), rng.integers(-9, 9, (256, width))
    plain = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    index, distance = codes.nearest(parts, entries)
    assert (index == plain.argmin(axis=1)).all() and (distance == plain.min(axis=1)).all()


def test_transform_is_in_sequency_order():
    rows = codes.transform(np.eye(16, dtype=np.int64)).T
    assert [(r[1:] != r[:-1]).sum() for r in rows] == list(range(16))


# Near vectors


def brute_near(rows, threshold=0.98):
    """Links by cosine of all pairs, components by search."""

    def usable(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    near = [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            (_, x, k), (_, y, m) = rows[i], rows[j]
            if k != m or not usable(x, k) or not usable(y, m) or len(x) != len(y):
                continue
            if near_vectors.cosine(np.array(x), np.array(y)) >= threshold:
                near[i].append(j)
                near[j].append(i)
    out = []
    for i in range(n):
        seen, edge = {i}, [i]
        while edge:
            for j in near[edge.pop()]:
                if j not in seen:
                    seen.add(j)
                    edge.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((rows[i][0], len(near[i]), least, rows[i][0] == least))
    return sorted(out, key=repr)


def near_of(df, **names):
    return sorted((tuple(r) for r in near_vectors.mark(df, **names).collect()), key=repr)


def clustered(seed, n, size=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, size))
    rows = []
    for i in range(n):
        v = centres[rng.integers(12)] + rng.normal(size=size) * rng.choice([0.05, 0.2, 1.0])
        rows.append((i, (v * rng.choice([0.1, 1, 30])).tolist(), int(rng.integers(3)) if i % 11 else None))
    return rows


def test_near_vectors_of_clusters(spark):
    rows = clustered(3, 500)
    rows += [(1000 + i, rows[1][1], rows[1][2]) for i in range(150)]  # a group of copies
    want = brute_near(rows)
    assert near_of(vectors(spark, rows)) == want
    assert near_of(vectors(spark, rows), tile=1) == want  # many tiles: the least size is 128 rows


def test_a_large_group_of_near_copies_is_linked_whole(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=32)
    rows = [(i, (centre + 0.01 * rng.normal(size=32)).tolist(), 0) for i in range(1500)]
    found = near_vectors.mark(vectors(spark, rows), tile=256).collect()
    assert {(r["n_links"], r["component_id"]) for r in found} == {(1499, 0)}
    assert sum(r["kept"] for r in found) == 1


def test_near_vectors_of_hard_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (2, [], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, [None, 1.0], 1),
        (6, [0.0, 0.0], 1), (7, [0.0, 0.0], 1), (8, [1.0, 0.0], 1), (9, [1e300, 1e280], 1), (10, [1e-300, 0.0], 1),
        (11, [1.0, 0.0, 0.0], 1), (12, [1.0, 0.0], None), (13, [1.0, 0.0], None), (None, [-1.0, 0.0], 1),
        (None, [-2.0, 0.0], 1), (8, [1.0, 0.0], 1), (14, [0.98, math.sqrt(1 - 0.98**2)], 1), (15, [1.0, 0.0], 2),
    ]
    assert near_of(vectors(spark, rows)) == brute_near(rows)
    assert near_of(vectors(spark, [])) == []
    assert near_of(vectors(spark, [(1, None, 1)])) == [(1, 0, 1, True)]


# Prefix trie


def brute_trie(rows):
    def key(r):
        role, text = r[2] or "", r[3] or ""
        digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        return (r[1] is not None, r[1] or 0, digest)

    convs = {}
    for r in sorted(rows, key=key):
        convs.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    built = {}
    for c, own in convs.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 4
        donor = [] if c is None else convs.get(c - int(math.fmod(c, 20)), [])
        built[c] = tuple(donor[:h] + own[h:])
    members, ends = {}, {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    last = (1, 0)

    def order(c):
        return last if c is None else (0, c)

    def words(t):
        return len([w for w in prefix_trie_words(t) if w])

    children, leaves, saved = {}, {}, {}
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * words(path[-1][1]) if path else 0
        leaves[path] = leaves.get(path, 0) or 1
        saved[path] = saved.get(path, 0) + own
        if path:
            up = path[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[path]
            saved[up] = saved.get(up, 0) + saved[path]
    out = []
    for path, ids in members.items():
        done = ",".join("" if c is None else str(c) for c in sorted(ends.get(path, []), key=order))
        out.append(
            (
                min(ids, key=order), len(path), min(members[path[:-1]], key=order) if path else None, len(ids),
                children.get(path, 0), leaves[path], saved[path], hashlib.sha256(done.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def prefix_trie_words(text):
    for blank in "\t\n\x0b\f\r":
        text = text.replace(blank, " ")
    return text.split(" ")


def trie_of(df, **names):
    return sorted((tuple(r) for r in prefix_trie.nodes(df, **names).collect()), key=repr)


def talks(seed, n):
    rng = random.Random(seed)
    return [
        (c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["a b", "hello", "x  y\tz", "", None]))
        for c in range(n)
        for t in range(rng.randint(1, 6))
    ]


@pytest.mark.parametrize("light,band", [(1024, 1024), (1, 1), (2, 2), (3, 1), (1000, 2)])
def test_trie_in_shards_of_any_size(spark, light, band):
    rows = talks(5, 130)
    assert trie_of(turns(spark, rows), light=light, band=band) == brute_trie(rows)


def test_trie_of_a_long_conversation_and_a_hot_one(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 64)
    rows = [(7, t, "user", f"turn {t % 5}") for t in range(700)]
    rows += [(100 + c, t, "user", f"turn {t % 5}") for c in range(60) for t in range(5)]
    for light, band in ((1024, 1024), (8, 16), (1024, 16)):
        assert trie_of(turns(spark, rows), light=light, band=band) == brute_trie(rows)


def test_trie_of_hard_turns(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 1, "user", "a b"),
        (None, 0, "user", None), (40, 0, "user", "hi"), (41, 0, "user", "hi"), (59, 0, "x", " \n"), (-5, 0, "user", "neg"),
        (60, 5, "user", "a " * 30_000), (61, 5, "user", "1:user"),
    ]
    assert trie_of(turns(spark, rows)) == brute_trie(rows)
    assert trie_of(turns(spark, [])) == []
    # Turnless after rebuilding: the first turns go and the one to borrow from is absent.
    gone = [(c, 0, "user", "t") for c in range(1, 12) if zlib.crc32(str(c).encode()) % 4]
    assert trie_of(turns(spark, gone)) == brute_trie(gone) and len(brute_trie(gone)) == 1


def test_queue_spills_and_keeps_order():
    queue, rng = prefix_trie.SpillingQueue(limit=50), random.Random(1)
    items = [(rng.randint(-20, 0), rng.random(), i) for i in range(5000)]
    out = []
    for i, item in enumerate(items):
        queue.push(item)
        if i % 3 == 0:
            out.append(queue.pop())
            queue.push(out.pop())
    assert queue.spills > 10
    while queue.first() is not None:
        out.append(queue.pop())
    assert out == sorted(items)


def test_many_ends_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_A_BLOCK", 7)
    rows = [(20 * c, 0, "user", "same") for c in range(300)]
    assert trie_of(turns(spark, rows)) == brute_trie(rows)
