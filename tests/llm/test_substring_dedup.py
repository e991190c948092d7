"""Substring dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from rowsmith.llm import textops as T
from rowsmith.llm.substring_dedup import merged_sketch, remove_repeats

SCHEMA = "doc_id long, text string, n_words string, firsts string"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def brute(rows, size):
    first = {}
    for d, t, *_ in rows:
        w = words(t)
        for i in range(len(w) - size + 1):
            at = (d is None, d or 0, i)
            key = tuple(w[i : i + size])
            first[key] = min(first.get(key, at), at)
    out = []
    for d, t, *_ in rows:
        w = words(t)
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < (d is None, d or 0, i):
                gone |= set(range(i, i + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return Counter(out)


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["é", "日本", "the", "the"]
    run = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    passage, twenty = run(60), run(20)
    texts = [None, "", " \t\n", "a", "the " * 30, run(25) + " " + twenty, twenty, twenty + " " + run(30), "x " * 20000]
    texts += [run(rng.randint(1, 80)) + "\n" + passage + "\x0b" + run(rng.randint(0, 9)) for _ in range(40)]
    texts += [texts[-1]] * 20 + [run(rng.randint(1, 400)) for _ in range(60)]
    rows = [(500 - i, t, "clash", "clash") for i, t in enumerate(texts)]
    return rows + [rows[30], rows[30], (None, texts[30], None, None)]


@pytest.mark.parametrize("size,cells", [(20, 1 << 30), (5, 1 << 30), (20, 1)])
def test_matches_brute_force(spark, size, cells):
    rows = corpus(size)
    got = remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(5), size, max_cells=cells).collect()
    assert Counter(map(tuple, got)) == brute(rows, size)


def test_nothing(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sketch_counts_every_repeated_window(spark):
    from rowsmith.llm.substring_dedup import Windows

    rows = corpus(3)
    sketch = merged_sketch(spark.createDataFrame(rows, SCHEMA).select("text").repartition(7), 20)
    seen, where = Counter(), {}
    for chunk in T.chunks(pa.array([t for _, t, *_ in rows])):
        w = Windows(chunk, 20)
        seen.update(w.hash.tolist())
        where.update(zip(w.hash.tolist(), sketch.repeated(w.anchor).tolist(), strict=True))
    assert all(where[h] for h, n in seen.items() if n > 1)
    single = [h for h, n in seen.items() if n == 1]
    assert sum(where[h] for h in single) < 0.2 * len(single)


def test_word_spans_and_chunks():
    texts = ["ab c", None, "", "  ", "é x\ty", "no" * 9] * 3
    for limit in (1, 7, 1 << 20):
        got = []
        for chunk in T.chunks(pa.array(texts).slice(1), limit):
            s, e, r = T.word_spans(chunk.buf, chunk.offsets, T.NOT_SPACE)
            for k in range(chunk.n):
                got.append([chunk.buf[a:b].tobytes().decode() for a, b in zip(s[r[k] : r[k + 1]], e[r[k] : r[k + 1]], strict=True)])
        assert got == [words(t) for t in texts[1:]]
