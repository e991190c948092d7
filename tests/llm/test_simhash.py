"""SimHash near-duplicates against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from rowsmith.llm.components import Forest
from rowsmith.llm.simhash_gray import GrayIndex, gray_rank, near_duplicates, near_links

SCHEMA = "doc_id long, text string, fp string, component_id string"


def brute_fingerprint(text, width=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    sh = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, max_bits):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= max_bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def clustered(seed, n):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(n // 8)]
    out = {0, (1 << 64) - 1}
    while len(out) < n:
        x = rng.choice(centres)
        for _ in range(rng.randint(0, 6)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


def test_gray_rank_is_the_inverse_of_the_gray_code():
    i = np.arange(1000, dtype=np.uint64)
    assert (gray_rank(i ^ (i >> np.uint64(1))) == i).all()


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_all_links_of_each_bucket(seed):
    fps = clustered(seed, 400)
    buckets = np.array([x % 3 for x in range(len(fps))], np.int64)
    index = GrayIndex(buckets, np.array(fps, np.uint64))
    forest = Forest(len(fps))
    index.links(3, forest)
    got = {}
    for place, root in enumerate(forest.roots().tolist()):
        got.setdefault(root, set()).add(int(index.fps[place]) * 3 + int(buckets[index.order[place]]))
    want = {}
    for b in range(3):
        own = [x for x, k in zip(fps, buckets, strict=True) if k == b]
        for x, c in zip(own, brute_components(own, 3), strict=True):
            want.setdefault((b, c), set()).add(x * 3 + b)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_large_buckets_are_cut_without_loss(spark):
    fps = clustered(9, 300)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    edges = near_links(df, 3, bucket_rows=6).collect()
    at = {x: i for i, x in enumerate(signed)}
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for e in edges:
        assert bin((e.a ^ e.b) & (2**64 - 1)).count("1") <= 64
        a, b = find(at[e.a]), find(at[e.b])
        parent[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(fps))] == brute_components(fps, 3)


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(5)
    vocab = ["alpha", "Beta", "gamma\t", "délta", "  eps", "zeta", "eta\x0b", "theta", "iota", "kappa"]
    texts = ["", None, " \n", "one", "ONE", "two words", "z " * 50000]
    for _ in range(40):
        base = [rng.choice(vocab) for _ in range(rng.randint(40, 200))]
        texts.append(" ".join(base))
        for _ in range(3):
            near = list(base)
            near[rng.randrange(len(near))] = rng.choice(vocab)
            texts.append(" ".join(near))
    texts += [texts[10]] * 30
    rows = [(1000 - i, t, "clash", "clash") for i, t in enumerate(texts)]
    rows += [rows[20], rows[20], (None, texts[12], None, None), (None, "only here and nowhere else", None, None)]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    fps = [brute_fingerprint(t) for _, t, *_ in rows]
    groups = brute_components(fps, 3)
    least = {}
    for (d, *_), g in zip(rows, groups, strict=True):
        if d is not None:
            least[g] = min(least.get(g, d), d)
    want = Counter((d, f"{f:016x}", least.get(g)) for (d, *_), f, g in zip(rows, fps, groups, strict=True))
    assert Counter(map(tuple, got)) == want
    assert max(Counter(r.component_id for r in got).values()) > 30


def test_near_duplicates_of_nothing(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
