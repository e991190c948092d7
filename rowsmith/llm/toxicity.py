"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words are mapped to symbols (insult, threat verb, intent, target, negation, reported speech, other). Five transducers
read a clause's symbols: insult, threat (intent, verb, target), target (someone is meant, before or after), negation (a scope
of a few words) and reported speech (up to the clause's end). ``compose`` makes one machine of them; it
emits matches with the contexts that hold there. A clause scores by its matches, each the weight of
the matched pattern times the weight of its context. An insult that no target joins, or that is negated or reported, weighs less than
0.3 until labelled documents show that such clauses are toxic. A document scores ``1 - product(1 - match)``.

The function words below are fixed. The insult patterns (words, and stems that take many endings) and all
weights are learned from labelled rows: a bounded sample of at most ``most`` rows of each label,
never of rows held out. A pattern is kept if its documents are labelled toxic far beyond chance, counting near copies
of one text about once, for as many candidates as were looked at; words inside the scope of a negation or of reported speech
count for no candidate, so clean documents that deny or quote an insult don't hide it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm import textops as T
from rowsmith.llm.common import bounded_batches, held_out, known_labels, labelled_sample, stored

# Fixed function words of the four languages of the corpus.
NEGATIONS = "not no never nobody isn aren wasn don doesn didn nicht kein keine keinen nie niemals pas jamais aucun aucune nunca ningún ninguna".split()
TARGETS = "you your yours yourself he she they them him du dich dir ihr euch tu toi vous ton tes usted ustedes vosotros ellos".split()
REPORTS = "said says saying called calls quoted wrote writes claimed claims according told sagte sagt nannte schrieb laut behauptet dit disait écrit selon appelle dijo dice escribió según llamó".split()
INTENTS = "will going gonna shall werde werden wirst vais voy vamos".split()
THREATS = "kill hurt destroy beat burn shoot punish töten umbringen vernichten schlagen tuer frapper détruire brûler matar golpear destruir quemar".split()

OTHER, INSULT, THREAT, INTENT, TARGET, NEGATION, REPORT = range(7)
SYMBOLS = 7
_CLASSES = {w: s for s, ws in ((THREAT, THREATS), (INTENT, INTENTS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws}

# Contexts of a match, as bits.
TARGETED, NEGATED, REPORTED, THREATENED = 1, 2, 4, 8
#: Weights of the contexts before any label is seen, and the number of documents this is worth.
PRIOR = {0: 0.25, TARGETED: 0.97, NEGATED: 0.1, REPORTED: 0.2, NEGATED | REPORTED: 0.05, THREATENED: 0.6}
PRIOR_DOCS = 10.0
#: Scope in words of a negation, a target before and after, and between the parts of a threat.
SCOPE = 3

PREFIXES = range(3, 9)  # bytes of a stem
SIGNATURES = 4
#: A stem is dropped for a longer pattern that has this share of its texts.
MOSTLY = 0.7


# ---- the grammar


@dataclass
class Transducer:
    """States 0 .. n - 1 (0 first); ``step(state, symbol)`` gives the next state and an output (0: none)."""

    n: int
    step: Callable[[int, int], tuple[int, int]]


def _negation(state: int, symbol: int) -> tuple[int, int]:
    return (SCOPE if symbol == NEGATION else max(0, state - 1)), NEGATED if state else 0


def _report(state: int, symbol: int) -> tuple[int, int]:
    return (1 if symbol == REPORT else state), REPORTED if state else 0


def _target(state: int, symbol: int) -> tuple[int, int]:
    return (SCOPE if symbol == TARGET else max(0, state - 1)), TARGETED if state else 0


def _insult(state: int, symbol: int) -> tuple[int, int]:
    """State: words since the last insult, down from SCOPE. 16: an insult; 32: a target after one."""
    if symbol == INSULT:
        return SCOPE, 16
    if symbol == TARGET and state:
        return 0, 32
    return max(0, state - 1), 0


def _threat(state: int, symbol: int) -> tuple[int, int]:
    """States 1 .. SCOPE wait for the verb, SCOPE + 1 .. 2 * SCOPE for the target. 64: a threat."""
    if symbol == INTENT:
        return SCOPE, 0
    if symbol == THREAT and 0 < state <= SCOPE:
        return 2 * SCOPE, 0
    if symbol == TARGET and state > SCOPE:
        return 0, 64
    return (0 if state in (0, 1, SCOPE + 1) else state - 1), 0


def compose(parts: list[Transducer]) -> tuple[list[list[int]], list[list[int]]]:
    """One machine that runs all parts side by side: next state and the union of the outputs, by state and symbol."""
    states = list(product(*(range(p.n) for p in parts)))
    place = {s: i for i, s in enumerate(states)}
    following, output = [], []
    for s in states:
        steps = [[p.step(x, symbol) for p, x in zip(parts, s, strict=True)] for symbol in range(SYMBOLS)]
        following.append([place[tuple(n for n, _ in row)] for row in steps])
        output.append([sum(o for _, o in row) for row in steps])
    return following, output


NEXT, OUTPUT = compose(
    [Transducer(SCOPE + 1, _negation), Transducer(2, _report), Transducer(SCOPE + 1, _target), Transducer(SCOPE + 1, _insult), Transducer(2 * SCOPE + 1, _threat)]
)


def matches(symbols: list[int]) -> list[tuple[int, int]]:
    """(word, context) of every match in a clause; the word is the insult's or the threat's last."""
    state, out = 0, []
    for i, symbol in enumerate(symbols):
        o = OUTPUT[state][symbol]
        if o & 16:
            out.append((i, o & (TARGETED | NEGATED | REPORTED)))
        if o & 32:  # the last insult has its target behind it
            last = max(k for k, (_, c) in enumerate(out) if not c & THREATENED)
            out[last] = (out[last][0], out[last][1] | TARGETED)
        if o & 64:
            out.append((i, THREATENED | o & (NEGATED | REPORTED)))
        state = NEXT[state][symbol]
    return out


# ---- the lexicon


@dataclass
class Lexicon:
    """Insult patterns: whole words and stems (UTF-8), with weights."""

    patterns: list[tuple[str, bool, float]] = field(default_factory=list)  # text, whether a stem, weight

    def __post_init__(self):
        self.by_length: list[tuple[int, np.ndarray, np.ndarray]] = []  # 0: whole words
        groups: dict[int, list[tuple[int, float]]] = {}
        for text, stem, weight in self.patterns:
            raw = np.frombuffer(text.encode(), np.uint8)
            h = int(T.word_hashes(raw, np.array([0]), np.array([len(raw)]))[0])
            groups.setdefault(len(raw) if stem else 0, []).append((h, weight))
        for length, found in groups.items():
            found.sort()
            self.by_length.append((length, np.array([h for h, _ in found], np.uint64), np.array([w for _, w in found])))
        raw = [(w.encode(), s) for w, s in _CLASSES.items()]
        spans = np.cumsum([0] + [len(w) for w, _ in raw])
        hashes = T.word_hashes(np.frombuffer(b"".join(w for w, _ in raw), np.uint8), spans[:-1], spans[1:])
        order = np.argsort(hashes)
        self.class_hash, self.class_symbol = hashes[order], np.array([s for _, s in raw])[order]

    def read(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and pattern weight of every word."""
        symbol, weight = np.zeros(len(starts), np.int64), np.zeros(len(starts))
        if not len(starts):
            return symbol, weight
        whole = T.word_hashes(buf, starts, ends)
        at = np.searchsorted(self.class_hash, whole).clip(max=len(self.class_hash) - 1)
        known = self.class_hash[at] == whole
        symbol[known] = self.class_symbol[at[known]]
        for length, keys, weights in self.by_length:
            own = np.flatnonzero(ends - starts >= max(length, 1))
            hashes = whole if length == 0 else T.word_hashes(buf, starts[own], starts[own] + length)
            at = np.searchsorted(keys, hashes).clip(max=len(keys) - 1)
            hit = keys[at] == hashes
            symbol[own[hit]] = INSULT
            weight[own[hit]] = np.maximum(weight[own[hit]], weights[at[hit]])
        return symbol, weight


_ENDS_CLAUSE = np.zeros(256, np.int64)
_ENDS_CLAUSE[list(b".,;:!?\n()|\"")] = 1


def _clauses(chunk: T.Chunk, starts: np.ndarray, text: np.ndarray) -> np.ndarray:
    """A number for every word's clause: it goes on while no sign that ends one, and no text's end, lies between two words."""
    return np.cumsum(_ENDS_CLAUSE[chunk.buf])[starts] + text


def in_scope(symbol: np.ndarray, clause: np.ndarray) -> np.ndarray:
    """Words that a negation (the next ``SCOPE`` words) or reported speech (the rest of the clause) governs."""
    out = np.zeros(len(symbol), bool)
    for ahead in range(1, SCOPE + 1):
        at = np.flatnonzero(symbol[:-ahead] == NEGATION)
        at = at[clause[at] == clause[at + ahead]]
        out[at + ahead] = True
    for at in np.flatnonzero(symbol == REPORT).tolist():
        out[at + 1 : np.searchsorted(clause, clause[at], "right")] = True
    return out


def clause_matches(chunk: T.Chunk, lexicon: Lexicon) -> list[tuple[int, int, float, int]]:
    """(text, clause, pattern weight, context) of every match of a chunk of lower-cased texts."""
    starts, ends, ranges = T.word_spans(chunk.buf, chunk.offsets, T.ALNUM)
    symbol, weight = lexicon.read(chunk.buf, starts, ends)
    key = np.flatnonzero((symbol == INSULT) | (symbol == THREAT))
    if not len(key):
        return []
    text = np.repeat(np.arange(chunk.n), np.diff(ranges))
    signs = _clauses(chunk, starts, text)
    out = []
    for c in np.unique(signs[key]).tolist():
        a, b = np.searchsorted(signs, [c, c + 1])
        for i, context in matches(symbol[a:b].tolist()):
            out.append((int(text[a]), c, 1.0 if context & THREATENED else float(weight[a + i]), context))
    return out


# ---- learning


@dataclass
class Model:
    lexicon: Lexicon
    context: np.ndarray  # weight of each of the 16 contexts
    rest: float  # score of a text without any match

    def scores(self, chunk: T.Chunk) -> np.ndarray:
        clean = np.full(chunk.n, 1.0 - self.rest)
        for text, _, weight, context in clause_matches(chunk, self.lexicon):
            clean[text] *= 1.0 - min(0.999, weight * self.context[context])
        return 1.0 - clean


def _prior(context: int) -> float:
    known = context & ~TARGETED if context & (NEGATED | REPORTED | THREATENED) else context
    if known & THREATENED:
        return PRIOR[THREATENED] * (PRIOR[known ^ THREATENED] if known & (NEGATED | REPORTED) else 1.0)
    return PRIOR[known]


def _starts_hashed(vocabulary: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the first ``size`` bytes of every word (0: of all), and whether a character of it ends there."""
    hashes, fits = [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
    for chunk in T.chunks(vocabulary):
        starts, ends = chunk.offsets[:-1], chunk.offsets[1:]
        if size == 0:
            hashes.append(T.word_hashes(chunk.buf, starts, ends))
            fits.append(np.ones(chunk.n, bool))
            continue
        fit = ends - starts >= size
        after = chunk.buf[np.minimum(starts + size, len(chunk.buf) - 1)]
        fit &= (ends - starts == size) | (after & 0xC0 != 0x80)
        own = np.zeros(chunk.n, np.uint64)
        own[fit] = T.word_hashes(chunk.buf, starts[fit], starts[fit] + size)
        hashes.append(own)
        fits.append(fit)
    return np.concatenate(hashes), np.concatenate(fits)


def learn_patterns(words: pa.ListArray, labels: np.ndarray, signatures: np.ndarray, true_counts: tuple[int, int]) -> list[tuple[str, bool, float]]:
    """The insult patterns of a labelled sample.

    ``words``: each text's distinct words; ``signatures``: minimum hashes of its word runs, equal in near copies.
    """
    n = np.array([int((labels == 0).sum()), int((labels == 1).sum())])
    if not n.all():
        return []
    coded = words.flatten().dictionary_encode()
    vocabulary = coded.dictionary
    code = coded.indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(words)), words.value_lengths().to_numpy())
    toxic = labels[doc] == 1
    in_toxic = np.zeros(len(vocabulary), bool)
    in_toxic[code[toxic]] = True
    share = n[1] / n.sum()

    # features: whole words (size 0), then the stems of each size of words of toxic texts
    found: list[tuple[bytes, bool, int, int, int]] = []  # pattern, whether a stem, texts, positive, negative
    counted = 0
    for size in (0, *PREFIXES):
        hashes, fits = _starts_hashed(vocabulary, size)
        own = np.flatnonzero(fits & in_toxic)
        if not len(own):
            continue
        values, example, endings = np.unique(hashes[own], return_index=True, return_counts=True)
        feature = np.searchsorted(values, hashes).clip(max=len(values) - 1)
        feature[~fits | (values[feature] != hashes)] = -1

        def texts_with(mask: np.ndarray, feature=feature) -> tuple[np.ndarray, np.ndarray]:
            """(feature, text), each once."""
            f, d = feature[code[mask]], doc[mask]
            pairs = np.unique(f[f >= 0] * np.int64(len(words)) + d[f >= 0])
            return pairs // len(words), pairs % len(words)

        f, holder = texts_with(toxic)
        texts = np.bincount(f, minlength=len(values))
        # near copies count about once: the least number of different signatures among a pattern's texts
        positive = texts
        for s in range(signatures.shape[1]):
            seen = np.unique(np.column_stack([f.astype(np.uint64), signatures[holder, s]]), axis=0)[:, 0]
            positive = np.minimum(positive, np.bincount(seen.astype(np.int64), minlength=len(values)))
        negative = np.bincount(texts_with(~toxic)[0], minlength=len(values))
        counted += len(values)
        often = (positive >= 3) & (positive >= 0.9 * (positive + negative))
        if size:  # a stem takes at least three endings
            often &= endings >= 3
        for k in np.flatnonzero(often).tolist():
            raw = vocabulary[int(own[example[k]])].as_py().encode()
            found.append((raw[:size] if size else raw, bool(size), int(texts[k]), int(positive[k]), int(negative[k])))

    def gain(pos: int, neg: int) -> float:
        p = pos / (pos + neg)
        return pos * math.log(p / share) + (neg * math.log((1 - p) / (1 - share)) if neg else 0.0)

    good = [x for x in found if gain(x[3], x[4]) >= math.log(20 * counted)]
    explained: dict[bytes, int] = {}  # the most texts of a longer pattern
    for raw, stem, texts, *_ in good:
        for cut in PREFIXES:
            if cut < len(raw) or (cut == len(raw) and not stem):
                explained[raw[:cut]] = max(explained.get(raw[:cut], 0), texts)
    # a stem stands for its words, unless one longer pattern accounts for most of its texts
    stems = [x for x in good if x[1] and explained.get(x[0], 0) < MOSTLY * x[2]]
    kept = [x for x in stems if not any(x[0] != y[0] and x[0].startswith(y[0]) for y in stems)]
    kept += [x for x in good if not x[1] and not any(x[0].startswith(y[0]) for y in stems)]
    per = np.array(true_counts) / n  # rows each sampled one stands for
    weight = lambda pos, neg: float((pos * per[1] + 0.5) / (pos * per[1] + neg * per[0] + 1))
    return sorted((raw.decode(), stem, weight(pos, neg)) for raw, stem, _, pos, neg in kept)


def _words_and_signatures(chunk: T.Chunk) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """First places of each text's distinct words outside negated and reported scopes, and its signatures (of 4-word runs; of
    words in shorter texts)."""
    starts, ends, ranges = T.word_spans(chunk.buf, chunk.offsets, T.ALNUM)
    hashes = T.word_hashes(chunk.buf, starts, ends)
    symbol, _ = Lexicon().read(chunk.buf, starts, ends)
    open_ = ~in_scope(symbol, _clauses(chunk, starts, np.repeat(np.arange(chunk.n), np.diff(ranges))))
    out, signatures = [], np.zeros((chunk.n, SIGNATURES), np.uint64)
    salts = T.stream(0x516, SIGNATURES)
    for k in range(chunk.n):
        a, b = ranges[k], ranges[k + 1]
        free = a + np.flatnonzero(open_[a:b])
        out.append(free[np.unique(hashes[free], return_index=True)[1]])
        if b > a:
            own = hashes[a:b]
            runs = T.range_hashes(own, np.arange(len(own) - 3), np.arange(4, len(own) + 1)) if len(own) > 3 else own
            signatures[k] = [T.mix(runs ^ salt).min() for salt in salts]
    return out, signatures, starts, ends


def _lowered(batch: pa.RecordBatch, column: int) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(batch.column(column), ""))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", *, most: tuple[int, int] = (3000, 1000)) -> Model:
    """Learn patterns and weights from the bounded sample; without toxic rows nothing matches but threats."""
    sample = stored(labelled_sample(docs.select("doc_id", "text"), labels, label_col, most), "toxicity-sample")

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in T.chunks(_lowered(batch, 1)):
                places, signatures, starts, ends = _words_and_signatures(chunk)
                data = chunk.buf.tobytes()
                words = [[data[a:b].decode() for a, b in zip(starts[p].tolist(), ends[p].tolist(), strict=True)] for p in places]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, chunk.n),
                        batch.column(2).slice(chunk.first, chunk.n),
                        pa.array(words, pa.list_(pa.string())),
                        pa.array(signatures.view(np.int64).tolist(), pa.list_(pa.int64())),
                    ],
                    ["id", "label", "words", "signatures"],
                )

    found = bounded_batches(sample).mapInArrow(words_of, "id long, label int, words array<string>, signatures array<long>").toArrow()
    found = found.sort_by([("id", "ascending"), ("label", "ascending")])
    y = found.column("label").to_numpy()
    counted = {r["label"]: r["n"] for r in known_labels(labels, label_col).groupBy("label").agg(F.count("*").alias("n")).collect()}
    counts = (counted.get(0, 0), counted.get(1, 0))
    patterns = []
    if len(found):
        signatures = np.array(found.column("signatures").to_pylist(), np.int64).view(np.uint64)
        patterns = learn_patterns(found.column("words").combine_chunks(), y, signatures, counts)
    lexicon = Lexicon(patterns)

    # weights of the contexts: documents all of whose matches are in one context
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def contexts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in T.chunks(_lowered(batch, 1)):
                seen = np.zeros(chunk.n, np.int32)
                for text, _, _, context in clause_matches(chunk, shared.value):
                    seen[text] |= 1 << context
                yield pa.RecordBatch.from_arrays([batch.column(2).slice(chunk.first, chunk.n), pa.array(seen)], ["label", "seen"])

    groups = sample.mapInArrow(contexts_of, "label int, seen int").groupBy("label", "seen").agg(F.count("*").alias("n")).collect()
    per = [counts[y_] / max(1, sum(g["n"] for g in groups if g["label"] == y_)) for y_ in (0, 1)]
    weight = np.array([_prior(c) * PRIOR_DOCS for c in range(16)])
    total = np.full(16, PRIOR_DOCS)
    none = [1.0, 99.0]  # toxic, all: before any text is seen, one in a hundred texts without a match is toxic
    for g in groups:
        rows = g["n"] * per[g["label"]]
        if g["seen"] == 0:
            none[0] += rows * g["label"]
            none[1] += rows
        elif g["seen"] & (g["seen"] - 1) == 0:
            c = g["seen"].bit_length() - 1
            weight[c] += rows * g["label"]
            total[c] += rows
    return Model(lexicon, weight / total, none[0] / none[1])


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    threshold: float = 0.3,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    most: tuple[int, int] = (3000, 1000),
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 from ``threshold``).

    Only texts enter a score. Null, empty and blank texts have no clause and get the score of texts without a match. Labels other
    than 0 and 1 and labels without an id are not used; repeated rows get equal scores; an empty table gives no rows; other
    columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(train(rows, labels, label_col, most=most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for chunk in T.chunks(_lowered(batch, 1)):
                score[chunk.first : chunk.first + chunk.n] = model.value.scores(chunk)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    scored = bounded_batches(rows).mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", threshold: float = 0.3, *, text_col: str = "text", **names) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold`` (see ``score_documents``); no shuffle."""
    rows = docs.select(F.col(names.pop("id_col", "doc_id")).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(train(rows, labels, label_col, **names))
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for chunk in T.chunks(_lowered(batch, place)):
                keep[chunk.first : chunk.first + chunk.n] = model.value.scores(chunk) < threshold
            yield batch.filter(pa.array(keep))

    return bounded_batches(docs).mapInArrow(run, docs.schema)
