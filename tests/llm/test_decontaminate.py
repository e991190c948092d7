"""The positional index against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest

from rowsmith.llm import decontaminate as D

DOCS = "doc_id long, text string, item string, n_words string, segment string"
ITEMS = "item_id long, text string, doc_id string, terms string"


def words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def data(seed):
    rng = random.Random(seed)
    vocab = ["the", "The", "of", "and", "é", "日本", "a1"] + [f"w{i}" for i in range(40)]
    run = lambda n, sep=" ": sep.join(rng.choice(vocab) for _ in range(n))
    items = [(i, run(rng.randint(10, 30))) for i in range(12)] + [(20, run(4)), (21, ""), (22, None), (23, " .,;"), (24, "the the the")]
    items += [(25, items[3][1]), (3, items[4][1]), (None, run(12))]
    texts = [None, "", "...", "the", "the the the the", "x " * 30000 + (items[0][1] or "")]
    for _ in range(60):
        part = words(rng.choice(items)[1])
        k = rng.randint(0, max(0, len(part) - 5))
        texts.append(run(rng.randint(0, 40)) + "--" + ", ".join(part[k : k + rng.randint(3, 14)]).upper() + "\n" + run(rng.randint(0, 9), "_"))
    texts += [texts[-1]] * 30 + [" ".join(words(items[1][1])[:5]), " ".join(words(items[1][1])[5:])]
    rows = [(i, t, "clash", "clash", "clash") for i, t in enumerate(texts)] + [(None, items[2][1], None, None, None)]
    return rows + [rows[7], rows[7]], [(i, t, "clash", "clash") for i, t in items]


def brute(rows, items, size):
    phrases = {}
    for i, t, *_ in items:
        w = words(t)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            phrases.setdefault(tuple(w[k : k + n]), set()).add("" if i is None else str(i))
    lengths = {len(p) for p in phrases}
    out = []
    for d, t, *_ in rows:
        w, hit, got = words(t), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in phrases:
                    hit |= set(range(k, k + n))
                    got |= phrases[tuple(w[k : k + n])]
        out.append((d, len(w), len(hit), len(got), hashlib.sha256(",".join(sorted(got)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


@pytest.mark.parametrize("size,block_bytes,restricted", [(10, 1 << 24, False), (10, 1 << 24, True), (4, 300, False)])
def test_exact_matches(spark, monkeypatch, size, block_bytes, restricted):
    monkeypatch.setattr(D, "SEGMENT_BYTES", 500)
    rows, items = data(size)
    got = D.contamination_report(
        spark.createDataFrame(rows, DOCS).repartition(4), spark.createDataFrame(items, ITEMS), size, block_bytes=block_bytes, restricted=restricted
    ).collect()
    assert Counter(map(tuple, got)) == brute(rows, items, size)


def test_proximity(spark):
    rows, items = data(3)
    items = [(i, t, None, None) for i, t, *_ in items if i in (0, 1, 2)]
    docs = [(i, t, "", "", "") for i, t, *_ in rows if i is not None and t and len(t) < 5000]
    got = D.find_benchmark(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), 5, 8).collect()
    count = Counter(w for _, t, *_ in docs for w in words(t))
    near = Counter()
    for d, t, *_ in docs:
        w, names, exact = words(t), set(), set()
        for i, it, *_ in items:
            p = words(it)
            for k in range(len(p) - 4):
                phrase = p[k : k + 5]
                few = min(count[x] for x in phrase)
                # which of equally rare terms leads is free: all or none of them must do
                leads = {x for x in phrase if count[x] == few}
                def ok(lead, phrase=phrase, w=w):
                    return any(all(x in w[max(0, j - 8) : j + 9] for x in phrase) for j, y in enumerate(w) if y == lead)
                if all(map(ok, leads)):
                    names.add(str(i))
                if any(map(ok, leads)):
                    exact.add(str(i))
        near[d, tuple(sorted(names)), tuple(sorted(exact))] += 1
    for r in got:
        low, high = next((lo, hi) for (d, lo, hi) in near if d == r.doc_id)
        assert set(low) <= set(r.near_items) <= set(high)
        assert set(r.items) <= set(r.near_items)
    assert any(set(r.near_items) - set(r.items) for r in got)


def test_empty_tables(spark):
    rows, items = data(1)
    none_docs, none_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert D.contamination_report(none_docs, spark.createDataFrame(items, ITEMS)).count() == 0
    got = D.contamination_report(spark.createDataFrame(rows, DOCS), none_items).collect()
    assert len(got) == len(rows) and not any(r.contaminated for r in got)


def test_index_holds_every_posting(spark):
    texts = ["one two one", "two three", "", None, "one"]
    index = D.build_index(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), 11)
    assert sum(sum(r.counts) for r in index.collect()) == 6
