"""The neighbour vote against brute force, and held-out accuracy."""

import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from rowsmith.llm import quality_knn as Q
from rowsmith.llm import textops as T

SCHEMA = "doc_id long, text string, score string, label string"
SF = "/root/testdata/sf0.01"


def texts(n, seed):
    rng = random.Random(seed)
    clean = lambda: " ".join(rng.choice(["the", "Home", "of", "river,", "stone", "été", "blue."]) for _ in range(rng.randint(5, 60)))
    junk = lambda: " ".join(rng.choice(["BUY!!", "NOW!!", "a$$$", "x###", "| cell |"]) for _ in range(rng.randint(5, 60)))
    return [(clean(), 1) if i % 2 else (junk(), 0) for i in range(n)]


def all_terms(rows):
    out = []
    for chunk in T.chunks(pa.array(rows)):
        text, term, counts = Q.term_counts(chunk)
        out += [(term[text == i], counts[text == i]) for i in range(chunk.n)]
    return out


def test_vote_is_exact():
    data = texts(80, 1)
    terms = all_terms([t for t, _ in data] + ["", None])
    labels = np.array([y for _, y in data])
    model = Q.fit(terms[:60], labels[:60], 8, 5)
    ask = terms[60:]
    text = np.repeat(np.arange(len(ask)), [len(t) for t, _ in ask])
    got = model.scores(text, np.concatenate([t for t, _ in ask]), np.concatenate([c for _, c in ask]), len(ask))
    for i, (term, counts) in enumerate(ask):
        v = Q._matrix(np.zeros(len(term), np.int64), term, counts, 1, model.idf)[0] @ model.projection
        if not np.linalg.norm(v):
            assert got[i] == model.labels.mean()
            continue
        cosine = [float(v @ x / np.linalg.norm(v)) for x in model.vectors]
        near = sorted(range(60), key=lambda j: -cosine[j])[:5]
        w = [max(0.0, cosine[j]) ** Q.SHARPNESS for j in near]
        assert got[i] == pytest.approx(sum(a * labels[j] for a, j in zip(w, near, strict=True)) / sum(w), abs=1e-4)


def test_ties_at_rank_k_all_vote():
    v = np.array([[1, 0], [1, 0], [1, 0], [0, 1], [-1, 0]], np.float32)
    projection = np.zeros((Q.TERMS, 2), np.float32)
    projection[0, 0] = 1
    for order in ([0, 1, 2, 3, 4], [4, 2, 3, 1, 0]):
        labels = np.array([1.0, 0.0, 0.0, 1.0, 1.0])
        model = Q.Model(np.ones(Q.TERMS, np.float32), projection, v[order], labels[order], 1)
        got = model.scores(np.array([0]), np.array([0]), np.array([3]), 1)
        assert got[0] == pytest.approx(1 / 3)


def test_tables(spark):
    data = texts(300, 2)
    rows = [(i, t, "clash", "clash") for i, (t, _) in enumerate(data)]
    rows += [(900, None, None, None), (901, "", None, None), (902, "The home " * 30000, None, None), (None, data[1][0], None, None), rows[5], rows[5]]
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    # labels held out say the opposite, so learning from them would show
    labels = [(i, (1 - y) if held(i) else y, "clash") for i, (_, y) in enumerate(data)] + [(None, 1, ""), (3, None, ""), (4, 7, "")]
    df, lf = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, text string")
    got = Q.classify(df, lf, per_class=60, rank=8, k=5).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].held_out == held(i) for i in range(300))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert np.mean([by_id[i].predicted == y for i, (_, y) in enumerate(data)]) > 0.97
    assert by_id[900].score == by_id[901].score < 0.7 and not by_id[None].held_out
    assert Q.classify(df.limit(0), lf).count() == 0
    assert {r.score for r in Q.classify(df, lf.limit(0)).collect()} == {0.5}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = Q.classify(spark.read.parquet(f"{SF}/documents.parquet"), labels).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.95


def test_a_repeated_labelled_id_is_one_row_of_the_sample(spark):
    from rowsmith.llm.common import labelled_sample

    docs = spark.createDataFrame([(1, f"text {i % 7}") for i in range(300)] + [(i, "other") for i in range(2, 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] * 3, "doc_id long, quality int")
    rows = labelled_sample(docs, labels, "quality", (5, 30)).collect()
    ids = [r.doc_id for r in rows]
    assert len(ids) == len(set(ids)) and sum(r.label == 0 for r in rows) <= 5
    assert 1 in ids and all(r.label == r.doc_id % 2 for r in rows)
