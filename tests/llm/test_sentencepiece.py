"""Sampled encoding: exact round trips, exact probabilities, reproducibility."""

import math
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from rowsmith.llm import sentencepiece_sampling as S
from rowsmith.llm import textops as T

SCHEMA = "doc_id long, text string, ids string, row_key string"
ODD = ["", " ", "  x", "x  ", "▁", " ▁ a▁", "<0x41><unk></s>", "\x00\x01\n\t", "", "日本語 é \U0001f600", "a" * 3000, "  ​"]


@pytest.fixture(scope="module")
def lattices():
    with open(S.default_model(), "rb") as f:
        return S.Lattices(S.Pieces(f.read(), 1.0))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40) | st.sampled_from(ODD), max_size=6), st.integers(0, 2**63))
def test_round_trip(lattices, texts, key):
    got = S.sample_texts(lattices, texts, T.stream(key, max(1, len(texts)))[: len(texts)])
    for t, ids in zip(texts, got, strict=True):
        assert lattices.pieces.decode(ids).decode() == t
        assert (len(ids) == 0) == (t == "")


def test_the_library_decodes_the_same(lattices):
    sp = sentencepiece.SentencePieceProcessor(model_file=S.default_model())
    texts = [t for t in ODD if "▁" not in t] + ["The quick brown fox, again and again."]
    for t, ids in zip(texts, S.sample_texts(lattices, texts, T.stream(5, len(texts))), strict=True):
        assert sp.decode(ids.tolist()) == t


def test_segmentations_come_with_their_exact_probability(lattices):
    p, word = lattices.pieces, " thee"
    chars = word.replace(" ", S.SPACE)
    sp = sentencepiece.SentencePieceProcessor(model_file=S.default_model())
    ids = {sp.id_to_piece(i): i for i in range(259, sp.get_piece_size())}

    def paths(i):
        if i == len(chars):
            yield ()
        for j in range(i + 1, len(chars) + 1):
            k = ids.get(chars[i:j])
            if k is not None:
                for rest in paths(j):
                    yield (k, *rest)

    weight = {x: math.exp(sum(p.log_weight[k] for k in x)) for x in paths(0)}
    n = 40000
    drawn = Counter(tuple(x.tolist()) for x in S.sample_texts(lattices, [word[1:]] * n, T.stream(11, n)))
    assert set(drawn) <= set(weight)
    total = sum(weight.values())
    for x, w in weight.items():
        q = w / total
        assert abs(drawn[x] - n * q) <= 5 * math.sqrt(n * q * (1 - q)) + 2


def test_result_does_not_depend_on_the_batch(lattices, monkeypatch):
    texts = [f"word number {i} of the corpus, thenationing" for i in range(300)]
    keys = T.stream(3, len(texts))
    whole = S.sample_texts(lattices, texts, keys)
    monkeypatch.setattr(S, "CACHE_UNITS", 3)
    one_by_one = [S.sample_texts(lattices, [t], keys[i : i + 1])[0] for i, t in enumerate(texts)][::-1]
    assert all(np.array_equal(a, b) for a, b in zip(whole, one_by_one[::-1], strict=True))


def test_encode_and_decode_tables(spark):
    texts = [*ODD, None, "word " * 40000, "the same text", "the same text"]
    rows = [(i, t, "clash", "clash") for i, t in enumerate(texts)] + [(None, "no id", None, None)] + [(3, ODD[3], None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = S.encode(df.repartition(3), seed=1)
    out = S.decode(got).collect()
    assert len(out) == len(rows) and all(r.lossless and r.n_pieces == len(r.ids) for r in out)
    assert Counter((r.doc_id, r.text) for r in out) == Counter((d, t or "") for d, t, *_ in rows)
    again = {(r.doc_id, tuple(r.ids)) for r in S.encode(df.repartition(1), seed=1).collect()}
    assert again == {(r.doc_id, tuple(r.ids)) for r in out}
    other = {(r.doc_id, tuple(r.ids)) for r in S.encode(df, seed=2).collect()}
    assert other != again
    assert S.encode(df.limit(0)).count() == 0
