"""The clause grammar, the learned patterns and held-out accuracy."""

import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from rowsmith.llm import textops as T
from rowsmith.llm import toxicity as X

SCHEMA = "doc_id long, text string, score string, label string"
SF = "/root/testdata/sf0.01"
LEXICON = X.Lexicon([("idiot", False, 0.9), ("vequ", True, 0.8)])


def contexts(text):
    out = []
    for chunk in T.chunks(pa.array([text.lower()])):
        out += [(w, c) for _, _, w, c in X.clause_matches(chunk, LEXICON)]
    return out


@pytest.mark.parametrize(
    "text,want",
    [
        ("what an idiot here", [(0.9, 0)]),
        ("idiots everywhere", []),
        ("une vequance et vequ", [(0.8, 0), (0.8, 0)]),
        ("you are an idiot", [(0.9, X.TARGETED)]),
        ("such an idiot, you", [(0.9, 0)]),
        ("such an idiot are you", [(0.9, X.TARGETED)]),
        ("never an idiot", [(0.9, X.NEGATED)]),
        ("not this time. an idiot", [(0.9, 0)]),
        ("not in a very long time an idiot", [(0.9, 0)]),
        ("the report said that some idiot won", [(0.9, X.REPORTED)]),
        ("she said you never, ever", []),
        ("she said you no idiot", [(0.9, X.REPORTED | X.NEGATED | X.TARGETED)]),
        ("we will destroy you", [(1.0, X.THREATENED)]),
        ("we will destroy it", []),
        ("you destroy", []),
        ("we are not going to destroy them", [(1.0, X.THREATENED)]),
        ("we will never destroy you", [(1.0, X.THREATENED | X.NEGATED)]),
        ("", []),
        ("IDIOT!! idiot", [(0.9, 0), (0.9, 0)]),
    ],
)
def test_clauses(text, want):
    assert contexts(text) == want


def test_composed_machine_runs_its_parts_side_by_side():
    rng = random.Random(3)
    parts = [(X._negation, X.SCOPE + 1), (X._report, 2), (X._target, X.SCOPE + 1), (X._insult, X.SCOPE + 1), (X._threat, 2 * X.SCOPE + 1)]
    for _ in range(200):
        state, own = 0, [0] * len(parts)
        for symbol in (rng.randrange(X.SYMBOLS) for _ in range(30)):
            steps = [p(s, symbol) for (p, _), s in zip(parts, own, strict=True)]
            assert all(0 <= s < n for (s, _), (_, n) in zip(steps, parts, strict=True))
            assert X.OUTPUT[state][symbol] == sum(o for _, o in steps)
            state, own = X.NEXT[state][symbol], [s for s, _ in steps]


def plain_score(text, model):
    """The score of a text, clause by clause, without the machine."""
    clean = 1.0 - model.rest
    for clause in re.split(r'[.,;:!?\n()|"]', text.lower()):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", clause)
        insult = [max([w for t, stem, w in model.lexicon.patterns if word == t or (stem and word.encode().startswith(t.encode()))], default=None) for word in words]
        kind = [X.INSULT if w is not None else X._CLASSES.get(word, X.OTHER) for word, w in zip(words, insult, strict=True)]

        def governed(i, kind=kind):
            return (X.NEGATED if X.NEGATION in kind[max(0, i - 3) : i] else 0) | (X.REPORTED if X.REPORT in kind[:i] else 0)

        for i, k in enumerate(kind):
            if k == X.INSULT:
                after = kind[i + 1 : i + 4]
                joined = X.TARGET in after and X.INSULT not in after[: after.index(X.TARGET)]
                context = governed(i) | (X.TARGETED if joined or X.TARGET in kind[max(0, i - 3) : i] else 0)
                clean *= 1 - min(0.999, insult[i] * model.context[context])
            if k == X.INTENT:
                own = kind[i + 1 :]
                own = own[: own.index(X.INTENT)] if X.INTENT in own else own
                if X.THREAT in own[:3]:
                    verb = own.index(X.THREAT)
                    if X.TARGET in own[verb + 1 : verb + 4]:
                        at = i + 1 + own.index(X.TARGET, verb + 1)
                        clean *= 1 - min(0.999, model.context[X.THREATENED | governed(at)])
    return 1 - clean


def test_scores_match_a_plain_reading():
    rng = random.Random(8)
    model = X.Model(LEXICON, np.array([rng.random() for _ in range(16)]), 0.01)
    pool = ["idiot", "vequance", "you", "not", "said", "will", "kill", "the", "é", "x9", "them", "never", "gonna", "beat"]
    texts = ["", "idiot", " ".join(["idiot"] * 50)]
    texts += ["".join(rng.choice(pool) + rng.choice([" ", " ", " ", "  ", ", ", ".", "\n", "-"]) for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    got = np.concatenate([model.scores(c) for c in T.chunks(pa.array([t.lower() for t in texts]))])
    assert got == pytest.approx([plain_score(t, model) for t in texts], abs=1e-9)


def test_a_lone_word_alone_is_not_toxic():
    model = X.Model(LEXICON, np.array([X._prior(c) for c in range(16)]), 0.01)
    score = lambda t: float(model.scores(next(iter(T.chunks(pa.array([t])))))[0])
    for text in ("idiot", "never an idiot", "the report said that some idiot won", "he wrote a book about the idiot of dostoevsky"):
        assert score(text) < 0.3, text
    for text in ("you are an idiot", "such an idiot are you", "we will destroy you"):
        assert score(text) >= 0.3, text


def test_denied_and_quoted_insults_labelled_clean(spark):
    rng = random.Random(6)
    part = ["ra", "mo", "ti", "lu", "ser", "an", "de", "il"]
    filler = lambda: " ".join("".join(rng.choice(part) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(6, 20)))
    shapes = [("you are a grobble", 1), ("never a grobble", 0), ("the report said that some grobble won", 0), ("you nurk", 1), ("", 0), ("", 0)]
    rows = [(i, f"{filler()}. {shapes[i % 6][0]}. {filler()}", shapes[i % 6][1]) for i in range(1200)]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    got = {r.doc_id: r for r in X.score_documents(df, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")).collect()}
    assert all(got[i].predicted == y for i, _, y in rows)


def corpus(n, seed):
    rng = random.Random(seed)
    part = ["ra", "mo", "ti", "lu", "ser", "an", "de", "il"]
    word = lambda: "".join(rng.choice(part) for _ in range(rng.randint(1, 3)))
    out = []
    for i in range(n):
        w = [word() for _ in range(rng.randint(10, 60))]
        if i % 5 == 0:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["grobble", "zwick" + word(), "nurk"]))
        out.append((" ".join(w), int(i % 5 == 0)))
    return out


def test_tables(spark):
    data = corpus(900, 4)
    copies = "moti rare luser words only here " * 3
    rows = [(i, t, "clash", "clash") for i, t in enumerate([t for t, _ in data])]
    # one toxic text copied often: its other words must not become patterns
    rows += [(2000 + i, copies + "grobble", "", "") for i in range(60)] + [(3000, copies, None, None)]
    rows += [(3001, None, None, None), (3002, "", None, None), (3003, "ra mo " * 40000, None, None), (None, "a nurk", None, None), rows[5], rows[5]]
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    labels = [(i, (1 - y) if held(i) else y, "clash") for i, (_, y) in enumerate(data)] + [(2000 + i, 1, "") for i in range(60)]
    labels += [(None, 1, ""), (7, None, ""), (8, 9, "")]
    df, lf = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    got = X.score_documents(df, lf).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].held_out == held(i) for i in range(900))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert np.mean([by_id[i].predicted == y for i, (_, y) in enumerate(data)]) > 0.98
    assert by_id[3000].predicted == by_id[3001].predicted == by_id[3002].predicted == by_id[3003].predicted == 0
    assert by_id[None].predicted == 1
    stems = {(t, s) for t, s, _ in X.train(df, lf).lexicon.patterns}
    assert ("grobble", False) in stems and ("nurk", False) in stems and ("zwick", True) in stems
    assert X.score_documents(df.limit(0), lf).count() == 0
    assert all(r.predicted == 0 for r in X.score_documents(df, lf.limit(0)).collect())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = X.score_documents(docs, labels).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.toxic for r in got]) > 0.9
