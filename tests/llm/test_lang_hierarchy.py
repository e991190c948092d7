"""Language identification: margins against plain loops, the family step, bounds of the sample, held-out accuracy."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from rowsmith.llm import lang_hierarchy as H
from rowsmith.llm import textops as T

SF = "/root/testdata/sf0.01"
SYLLABLES = {
    "aa": "ka to mi ru se no".split(),
    "ab": "ka to mi ru se xo".split(),
    "ba": "grü schl ast ung pf zw".split(),
    "bb": "grü schl ast ung pf éa".split(),
}
SCHEMA = "doc_id long, text string, lang string, score string, place string, lettered string"


def words(lang, n, rng):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(2, 4))) for _ in range(n))


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    langs = sorted(SYLLABLES)
    return [(i, words(langs[i % 4], rng.randint(20, 60), rng), langs[i % 4], "x", "x", "x") for i in range(n)]


def plain_letters(text):
    out = []
    for b in (text or "").lower().encode():
        b = b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
        if b != 0x20 or out and out[-1] != 0x20:
            out.append(b)
    return out


def plain_buckets(text):
    """Bucket counts of a text, byte by byte."""
    counts = Counter()
    letters = plain_letters(text)
    for n in range(1, H.LONGEST + 1):
        for i in range(len(letters) - n + 1):
            run = int.from_bytes(bytes(letters[i : i + n]), "big")
            product = (run + n) * H._FACTORS[n - 1] % 2**32
            counts[product >> (32 - (H.BUCKETS.bit_length() - 1))] += 1
    return counts


TEXTS = ["", None, "a", "é", "Über die  Brücke, 12 Häuser!", "x" * 300, "  lead", "trail  ", "ab\ncd", "日本 語", "12 ... 7", "Straße " * 50]


@pytest.mark.parametrize("size", [1 << 18, 7, 1])
def test_counts_and_margins_match_plain_loops(size, monkeypatch):
    monkeypatch.setattr(H, "SLICE", size)
    rng = np.random.default_rng(3)
    weights = rng.integers(-(1 << 20), 1 << 20, (H.BUCKETS + 1, 3))
    weights[-1] = 0
    machines = H.Machines(weights, np.array([0.25, -1.0, 0.0]))
    for chunk in T.chunks(pc.utf8_lower(pa.array(TEXTS, pa.string())), 400):
        own = TEXTS[chunk.first : chunk.first + chunk.n]
        got = machines.margins(*H.letters_of(chunk))
        for text, counts, margin in zip(own, H.bucket_counts(chunk), got, strict=True):
            want = plain_buckets(text)
            assert {b: c for b, c in enumerate(counts) if c} == want
            total = sum(want.values())
            for m in range(3):
                summed = sum(int(weights[b, m]) * c for b, c in want.items())
                assert margin[m] == summed / max(total, 1) / (1 << H.FIXED) + machines.bias[m]


def rows_of(data):
    out = []
    for _, text, lang, *_ in data:
        counts = plain_buckets(text)
        out.append((lang, np.array(sorted(counts)), np.array([counts[b] for b in sorted(counts)])))
    return out


def test_families_are_the_close_languages_and_votes_decide_within():
    data = corpus()
    model = H.fit(rows_of(data))
    assert model.languages == sorted(SYLLABLES)
    assert sorted(model.families) == [[0, 1], [2, 3]]
    held = corpus(200, 2)
    right = 0
    for chunk in T.chunks(pa.array([r[1] for r in held])):
        place, score = model.predict(chunk)
        letters, ranges = H.letters_of(chunk)
        family = model.between.margins(letters, ranges).argmax(axis=1)
        for i in range(chunk.n):
            members, machine = model.families[family[i]], model.within[family[i]]
            margin = machine.margins(letters[ranges[i] : ranges[i + 1]], np.array([0, ranges[i + 1] - ranges[i]]))[0]
            assert place[i] == (members[0] if margin[0] > 0 else members[1])
        right += sum(model.languages[p] == r[2] for p, r in zip(place, held[chunk.first :], strict=False))
        assert ((score >= 0) & (score <= 1)).all()
    assert right >= 198


def test_three_languages_in_a_family_are_voted_by_pairs():
    data = corpus()
    given = {"aa": "one", "ab": "one", "ba": "one", "bb": "two"}
    model = H.fit(rows_of(data), given)
    assert model.families == [[0, 1, 2], [3]] and model.within[0].weights.shape[1] == 3 and model.within[1] is None
    (chunk,) = T.chunks(pa.array([r[1] for r in corpus(80, 5)]))
    place, _ = model.predict(chunk)
    letters, ranges = H.letters_of(chunk)
    first = model.between.margins(letters, ranges).argmax(axis=1) == 0
    margins = model.within[0].margins(letters, ranges)
    for p, m in zip(place[first], margins[first], strict=True):
        votes = [(m[0] > 0) + (m[1] > 0), (m[0] < 0) + (m[2] > 0), (m[1] < 0) + (m[2] < 0)]
        assert votes[p] == max(votes)


def test_support_vector_machine_keeps_its_margin():
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(2, 0.3, (50, 3)), rng.normal(-2, 0.3, (5, 3))]).astype(np.float32)
    y = np.r_[np.ones(50), -np.ones(5)]
    w, b = H.support_vector_machine(x, y, 1000.0)
    assert (y * (x @ w + b) > 0.9).all()


def test_awkward_rows(spark):
    data = corpus()
    odd = [(900 + i, t, None, "x", "x", "x") for i, t in enumerate(TEXTS)] + [(None, data[0][1], "aa", "x", "x", "x"), data[4], data[4]]
    got = H.identify_languages(spark.createDataFrame(data + odd, SCHEMA).repartition(4)).collect()
    assert len(got) == len(data) + len(odd)
    by_id = {r.doc_id: r for r in got}
    for i, t in enumerate(TEXTS):
        unlettered = not any(c.isalpha() for c in t or "")
        assert (by_id[900 + i].lang_pred == "und") == unlettered
        assert not unlettered or by_id[900 + i].score == 0
    assert by_id[None].held_out is False and by_id[None].lang_pred == "aa"
    assert len({tuple(r) for r in got if r.doc_id == data[4][0]}) == 1
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    right = sum(by_id[r[0]].lang_pred == r[2] for r in data)
    assert right >= 0.99 * len(data)


def test_nothing_or_one_language_to_learn(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert H.identify_languages(none).count() == 0
    blind = spark.createDataFrame([(i, "abc", None, "", "", "") for i in range(9)], SCHEMA)
    assert {(r.lang_pred, r.score) for r in H.identify_languages(blind).collect()} == {("und", 0.0)}
    one = spark.createDataFrame([(i, "abc" if i else "12", "aa", "", "", "") for i in range(30)], SCHEMA)
    assert {(r.lang_pred, r.score) for r in H.identify_languages(one).collect()} == {("aa", 1.0), ("und", 0.0)}


def test_repeated_ids_do_not_pass_the_bound(spark):
    rows = [(1, f"kato {i}", "aa") for i in range(500)] + [(i, "grü", "ba") for i in range(2, 60)]
    sample = H.sampled(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 10, 15).collect()
    count = Counter(r.lang for r in sample)
    assert count["aa"] == 1 and count["ba"] == 10
    sample = H.sampled(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 10, 5).collect()
    assert len(sample) == 5


def test_held_out_rows_are_never_learned_from(spark):
    rows = [(i, "grü schl" if zlib.crc32(str(i).encode()) % 5 == 0 else "kato miru", "aa") for i in range(200)]
    sample = H.sampled(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 400, 6400).collect()
    assert {r.text for r in sample} == {"kato miru"} and len(sample) > 100


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = H.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    right = sum(r.lang_pred == r.lang for r in got)
    assert len(got) > 100 and right >= 0.98 * len(got)
