"""Integer k-means by tables and product codes by active entries against plain rescans."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rowsmith.llm import lookup_clusters as C
from rowsmith.llm import part_codes as P
from rowsmith.llm import vectors as V

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance string, code string, ids string"
DIMS = 8


def table(seed, n):
    rng = random.Random(seed)
    centre = [[rng.uniform(-0.6, 0.6) for _ in range(DIMS)] for _ in range(5)]
    rows = []
    for i in range(n):
        v = [float(np.float32(x + rng.gauss(0, 0.1))) for x in rng.choice(centre)]
        if rng.random() < 0.3:
            v = rows[0][1] if rows else v  # one very common vector
        rows.append((i, v, rng.choice([1, 1, 1, 2, None])))
    bad = [None, [], v[:-1], v + [0.1], [None, *v[1:]], [float("nan"), *v[1:]], [float("inf"), *v[1:]], [*v[:-1], float("-inf")]]
    rows += [(n + i, b, 3) for i, b in enumerate(bad)]
    rows += [(2 * n, [0.0] * DIMS, 9), (2 * n, [-0.0] * DIMS, 9), (-7, [-0.001] * DIMS, 9), rows[3], rows[3], (None, rows[5][1], None)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(partitions)


def kept(rows, scale):
    whole = [r for r in rows if r[1] is not None and len(r[1]) == DIMS and all(x is not None and math.isfinite(x) for x in r[1])]
    return [(i, [math.floor(scale * x) for x in v], label) for i, v, label in whole]


def apart(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def nearest(v, entries):
    return min((apart(v, e), i) for i, e in enumerate(entries))


def moved(vectors, near, entries):
    out = []
    for i, e in enumerate(entries):
        own = [v for v, (_, j) in zip(vectors, near, strict=True) if j == i]
        out.append([sum(c) // len(own) for c in zip(*own, strict=True)] if own else e)
    return out


def brute_clusters(rows, k, rounds):
    rows = kept(rows, 1024)
    key = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    entries = [r[1] for r in sorted(rows, key=key)[:k]]
    vectors = [r[1] for r in rows]
    for _ in range(rounds):
        entries = moved(vectors, [nearest(v, entries) for v in vectors], entries)
    near = [nearest(v, entries) for v in vectors]
    inertia = Counter()
    for d, c in near:
        inertia[c] += d
    sha = [hashlib.sha256(",".join(map(str, e)).encode()).hexdigest() for e in entries]
    return Counter((r[0], c, d, inertia[c], sum(inertia.values()), sha[c]) for r, (d, c) in zip(rows, near, strict=True))


@pytest.mark.parametrize("seed,n,partitions", [(1, 300, 3), (2, 40, 7), (3, 1, 1)])
def test_clusters_match_brute_force(spark, seed, n, partitions, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 32)
    rows = table(seed, n)
    got = C.cluster_vectors(frame(spark, rows, partitions), 8, 4, dims=DIMS).collect()
    assert Counter(map(tuple, got)) == brute_clusters(rows, 8, 4)


def test_table_distances_are_the_squared_distances():
    rng = np.random.default_rng(4)
    ints, centroids = rng.integers(-40, 40, (200, 5)), rng.integers(-60, 60, (7, 5))
    found = [np.unique(ints[:, d], return_inverse=True) for d in range(5)]
    ranges = np.cumsum([0, *[len(v) for v, _ in found]])
    got = C.table_distances(np.concatenate([v for v, _ in found]), ranges, np.stack([p for _, p in found]), centroids)
    assert (got == np.square(ints[:, None] - centroids[None]).sum(axis=2)).all()


def brute_codes(rows, parts, entries, rounds):
    rows = kept(rows, 4096)
    width = DIMS // parts
    cut = lambda v: [v[i : i + width] for i in range(0, DIMS, width)]
    least = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(r[1])[p] for r in least] for p in range(parts)]
    xs = [[cut(r[1])[p] for r in rows] for p in range(parts)]
    for _ in range(rounds):
        books = [moved(x, [nearest(v, b) for v in x], b) for x, b in zip(xs, books, strict=True)]
    near = [[nearest(v, b) for v in x] for x, b in zip(xs, books, strict=True)]
    error = [sum(near[p][i][0] for p in range(parts)) for i in range(len(rows))]
    by_label = Counter()
    for r, e in zip(rows, error, strict=True):
        by_label[r[2]] += e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    code = ["".join(f"{near[p][i][1]:02x}" for p in range(parts)) for i in range(len(rows))]
    return Counter((r[0], c, e, by_label[r[2]], sha) for r, c, e in zip(rows, code, error, strict=True))


@pytest.mark.parametrize("seed,n,rounds,partitions", [(1, 300, 6, 3), (2, 60, 3, 5), (3, 2, 6, 1)])
def test_codes_match_brute_force(spark, seed, n, rounds, partitions, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 32)
    rows = table(seed, n)
    got = P.compress_vectors(frame(spark, rows, partitions), 4, 16, rounds, dims=DIMS).collect()
    assert Counter(map(tuple, got)) == brute_codes(rows, 4, 16, rounds)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(*[st.integers(-3, 3)] * 2), min_size=1, max_size=30), st.integers(1, 5), st.randoms())
def test_active_entries_give_what_a_full_scan_gives(points, entries, rng):
    x = np.array(points)
    book = np.array([[rng.randint(-3, 3), rng.randint(-3, 3)] for _ in range(entries)])
    code, distance = P.scan(x, book)
    for _ in range(4):
        new = book.copy()
        for e in range(entries):
            if rng.random() < 0.4:
                new[e] = [rng.randint(-3, 3), rng.randint(-3, 3)]
        code, distance = P.reassign(x, new, (new != book).any(axis=1), code, distance)
        want = [nearest(v, new.tolist()) for v in x.tolist()]
        assert list(zip(distance.tolist(), code.tolist(), strict=True)) == want
        book = new


def test_nothing_kept(spark):
    for rows in ([], [(1, None, 1), (2, [1.0], None)]):
        df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)
        for out in (C.cluster_vectors(df, dims=DIMS), P.compress_vectors(df, dims=DIMS)):
            assert out.count() == 0


def test_components_too_large_are_told(spark):
    df = spark.createDataFrame([(1, [1e30] * DIMS, 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(ValueError, match="beyond"):
        C.cluster_vectors(df, dims=DIMS)
    with pytest.raises(ValueError, match="beyond"):
        P.compress_vectors(df, dims=DIMS)
