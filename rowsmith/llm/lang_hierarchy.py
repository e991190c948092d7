"""Language identification in two steps: the language family first, then linear support vector machines between its languages.

**Features.** Texts are lower-cased; every run of bytes other than a-z and 0x80 to 0xFF becomes one space. The byte runs of 1 to ``LONGEST``
within a text are hashed to ``BUCKETS`` buckets; a text's vector is the share of its runs in each bucket. A margin is therefore a sum over the
text's bytes, taken in whole numbers (weights in units of 2 ** -``FIXED``), so that it does not depend on how a text is cut.

**Families** are learned: the languages' mean vectors are merged by average linkage of their cosines down to the square root of
their number (or given as a map). One machine per family against the rest chooses the family; within it, one machine per pair of
languages votes. Votes that tie are decided by the sum of the margins, then by the order of the names.

**Fit.** On a bounded sample: per language the ``per_language`` ids of the smallest hash, ``most`` rows in all, one text per
id. Texts are counted in tasks; the driver gets bucket counts, no text. Everything else covers all rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.llm import textops as T
from rowsmith.llm.common import bounded_batches

LONGEST = 3
BUCKETS = 1 << 14
#: Buckets that the machines weigh: those that tell the languages of the sample apart best.
KEPT = 1 << 11
#: Positions of a text that are weighed at a time.
SLICE = 1 << 18
FIXED = 24
#: A margin of 1, the machine's own unit, is a share of about 0.95.
STEEPNESS = 3.0
UNKNOWN = "und"

_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTERS[0x80:] = np.arange(0x80, 0x100)
#: One odd factor per run length: the high bits of the product choose the bucket.
_FACTORS = [int(x) | 1 for x in (T.stream(0x1A46, LONGEST) >> np.uint64(32)).astype(np.uint32)]


def letters_of(chunk: T.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """The lower-case letters of a chunk's texts, one space after each run of them, and each text's range."""
    letters = _LETTERS[chunk.buf]
    keep = letters != 0x20
    after = np.zeros(len(keep), bool)
    after[1:] = keep[:-1]
    inner = chunk.offsets[1:-1]
    after[inner[inner < len(after)]] = False  # a text's first byte follows nothing
    keep |= after
    ranges = np.concatenate([[0], np.cumsum(keep)])[chunk.offsets]
    return letters[keep], ranges


def run_slices(letters: np.ndarray, ranges: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first place, bucket of the run from each place on) for every run length, a slice at a time; ``BUCKETS`` where a run leaves its text."""
    padded = np.concatenate([letters, np.zeros(LONGEST, np.uint8)])
    shift = np.uint32(32 - (BUCKETS.bit_length() - 1))
    with np.errstate(over="ignore"):
        for lo in range(0, len(letters), SLICE):
            hi = min(len(letters), lo + SLICE)
            runs = np.zeros(hi - lo, np.uint32)
            for n in range(1, LONGEST + 1):
                runs = runs << np.uint32(8) | padded[lo + n - 1 : hi + n - 1]
                buckets = ((runs + np.uint32(n)) * np.uint32(_FACTORS[n - 1]) >> shift).astype(np.int32)
                ends = ranges[np.searchsorted(ranges, lo, "right") : np.searchsorted(ranges, hi + n)]
                late = (ends[:, None] - np.arange(1, n)).ravel()
                buckets[late[(late >= lo) & (late < hi)] - lo] = BUCKETS
                yield lo, buckets


def run_numbers(ranges: np.ndarray) -> np.ndarray:
    """How many runs each text has."""
    size = np.diff(ranges)
    return sum(np.maximum(size - n + 1, 0) for n in range(1, LONGEST + 1))


def bucket_counts(chunk: T.Chunk) -> Iterator[np.ndarray]:
    """Counts of the buckets of every text of a chunk, one text after the other."""
    letters, ranges = letters_of(chunk)
    for a, b in zip(ranges[:-1], ranges[1:], strict=True):
        counts = np.zeros(BUCKETS + 1, np.int64)
        for _, buckets in run_slices(letters[a:b], np.array([0, b - a])):
            counts += np.bincount(buckets, minlength=BUCKETS + 1)
        yield counts[:BUCKETS]


# ---- machines


@dataclass
class Machines:
    """Linear machines side by side: ``weights`` (BUCKETS + 1, machines) in whole numbers, ``bias`` per machine."""

    weights: np.ndarray
    bias: np.ndarray

    def margins(self, letters: np.ndarray, ranges: np.ndarray) -> np.ndarray:
        """(texts, machines); a text without a run gets the bias."""
        total = np.zeros((len(ranges) - 1, self.weights.shape[1]), np.int64)
        for lo, buckets in run_slices(letters, ranges):
            first = np.searchsorted(ranges, lo, "right") - 1
            last = np.searchsorted(ranges, lo + len(buckets), "left")
            texts = np.arange(first, last)
            texts = texts[ranges[texts + 1] > ranges[texts]]
            starts = np.maximum(ranges[texts], lo) - lo
            total[texts] += np.add.reduceat(self.weights[buckets], starts, axis=0)
        number = np.maximum(run_numbers(ranges), 1)
        return total / number[:, None] / (1 << FIXED) + self.bias


def support_vector_machine(x: np.ndarray, y: np.ndarray, cost: float = 10.0, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise |w|^2 / 2 + cost * mean squared hinge loss (y: 1 or -1, classes of equal weight)."""
    n, width = x.shape
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    x1 = np.hstack([x, np.ones((n, 1), x.dtype)])
    v = np.ones(width + 1, x.dtype)
    for _ in range(20):  # largest curvature
        v = x1.T @ (weight * (x1 @ v)).astype(x.dtype)
        top = float(np.linalg.norm(v))
        v /= max(top, 1e-12)
    rate = 1.0 / (1.0 + 2 * cost * top)
    w = np.zeros(width + 1, np.float64)
    ahead, t = w.copy(), 1.0
    free = np.r_[np.ones(width), 0.0]  # the bias costs nothing
    for _ in range(steps):
        gap = np.maximum(1 - y * (x1 @ ahead.astype(x.dtype)), 0)
        slope = free * ahead - 2 * cost * (x1.T @ (weight * gap * y).astype(x.dtype))
        new = ahead - rate * slope
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead = new + (before - 1) / t * (new - w)
        w = new
    return w[:-1], float(w[-1])


def families_of(means: np.ndarray, number: int) -> list[list[int]]:
    """Rows of ``means`` in ``number`` groups by average linkage of their cosines."""
    unit = means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12)
    close = unit @ unit.T
    groups = [[i] for i in range(len(means))]
    while len(groups) > number:
        pairs = [(-close[np.ix_(a, b)].mean(), i, j + i + 1) for i, a in enumerate(groups) for j, b in enumerate(groups[i + 1 :])]
        _, i, j = min(pairs)
        groups[i] = sorted(groups[i] + groups.pop(j))
    return groups


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    families: list[list[int]] = field(default_factory=list)  # places in languages
    between: Machines | None = None  # one machine per family
    within: list[Machines | None] = field(default_factory=list)  # per family: one machine per pair of its languages

    def predict(self, chunk: T.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Language (its place) and score of every text of the chunk."""
        letters, ranges = letters_of(chunk)
        family, score = np.zeros(chunk.n, np.int64), np.ones(chunk.n)
        if self.between is not None:
            margins = self.between.margins(letters, ranges)
            family = margins.argmax(axis=1)
            two = np.sort(margins, axis=1)[:, -2:]
            score = _share(two[:, 1] - two[:, 0])
        place = np.array([f[0] for f in self.families])[family]
        for f, (members, machines) in enumerate(zip(self.families, self.within, strict=True)):
            texts = np.flatnonzero(family == f)
            if machines is None or not len(texts):
                continue
            own = T.spread(ranges[texts], np.diff(ranges)[texts])
            cut = np.concatenate([[0], np.cumsum(np.diff(ranges)[texts])])
            margins = machines.margins(letters[own], cut)
            votes, sums, least = (np.zeros((len(texts), len(members))) for _ in range(3))
            least += np.inf
            for m, (a, b) in enumerate(_pairs(len(members))):
                for side, sign in ((a, 1), (b, -1)):
                    votes[:, side] += sign * margins[:, m] > 0
                    sums[:, side] += sign * margins[:, m]
                    least[:, side] = np.minimum(least[:, side], sign * margins[:, m])
            # most votes, then the larger sum of margins, then the first name
            best = np.array([max(range(len(members)), key=lambda i: (v[i], s[i], -i)) for v, s in zip(votes, sums, strict=True)])
            place[texts] = np.array(members)[best]
            score[texts] *= _share(least[np.arange(len(texts)), best])
        return place, score


def _share(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-STEEPNESS * np.clip(margin, -50, 50)))


def _pairs(n: int) -> list[tuple[int, int]]:
    return [(a, b) for a in range(n) for b in range(a + 1, n)]


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], families: dict[str, str] | None = None) -> Model:
    """The model of a sample (each row: its language, buckets and their counts)."""
    rows = [r for r in rows if r[2].sum() > 0]
    languages = sorted({r[0] for r in rows})
    if not languages:
        return Model()
    of = np.array([languages.index(r[0]) for r in rows])
    means = np.zeros((len(languages), BUCKETS))
    for r, i in zip(rows, of, strict=True):
        means[i, r[1]] += r[2] / r[2].sum()
    means /= np.bincount(of)[:, None]
    # a bucket's share is measured against the root of its mean share: rare runs count more than their number
    scale = 1 / np.sqrt(means.mean(axis=0) + 1e-6)
    told = ((means * scale).var(axis=0) * (means.mean(axis=0) > 0)).argsort(kind="stable")[::-1][:KEPT]
    place = np.full(BUCKETS, -1)
    place[told] = np.arange(len(told))
    x = np.zeros((len(rows), len(told)), np.float32)
    for i, (_, buckets, counts) in enumerate(rows):
        own = place[buckets] >= 0
        x[i, place[buckets[own]]] = counts[own] / counts.sum()
    x *= scale[told].astype(np.float32)

    def machines(tasks: list[tuple[np.ndarray, np.ndarray]]) -> Machines | None:
        if not tasks:
            return None
        weights, bias = np.zeros((BUCKETS + 1, len(tasks))), np.zeros(len(tasks))
        for m, (own, y) in enumerate(tasks):
            w, bias[m] = support_vector_machine(x[own], y)
            weights[told, m] = w * scale[told]
        return Machines(np.round(weights * (1 << FIXED)).astype(np.int64), bias)

    if families is None:
        groups = families_of(means * scale, int(np.ceil(np.sqrt(len(languages)))))
    else:
        names = [families.get(x, x) for x in languages]
        groups = [[i for i, n in enumerate(names) if n == f] for f in sorted(set(names))]
    family = np.zeros(len(languages), np.int64)
    for f, members in enumerate(groups):
        family[members] = f
    everything = np.arange(len(rows))
    against_rest = [(everything, np.where(family[of] == f, 1.0, -1.0)) for f in range(len(groups))]
    within = []
    for members in groups:
        tasks = []
        for a, b in _pairs(len(members)):
            own = np.flatnonzero((of == members[a]) | (of == members[b]))
            tasks.append((own, np.where(of[own] == members[a], 1.0, -1.0)))
        within.append(machines(tasks))
    return Model(languages, groups, machines(against_rest) if len(groups) > 1 else None, within)


# ---- tables


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id's decimal text leaves 0 modulo 5: such rows are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sampled(rows: DataFrame, per_language: int, most: int) -> DataFrame:
    """lang, text of at most ``per_language`` ids of every language, those of the smallest hash, and at most ``most`` in all.

    One text per id and language (the one of the smallest hash), so repeated ids can't pass the bound.
    """
    known = rows.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    # Ids lie in cells of their hash; the first cells that hold enough of a language are found by count, so that only
    # their ids are ranked, whatever share of all rows the language has.
    ids = known.select("lang", "doc_id").distinct().withColumn("hash", F.xxhash64("doc_id"))
    ids = ids.withColumn("cell", F.shiftrightunsigned("hash", 52))
    by_cell = Window.partitionBy("lang").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = ids.groupBy("lang", "cell").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(by_cell), F.lit(0)))
    cells = cells.where(F.col("before") < per_language).select("lang", "cell")
    order = Window.partitionBy("lang").orderBy("cell", "hash", "doc_id")
    ranked = ids.join(cells, ["lang", "cell"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_language)
    ids = ranked.orderBy("rank", "lang").limit(most).select("lang", "doc_id")
    found = known.where(F.col("text").isNotNull()).join(F.broadcast(ids), ["lang", "doc_id"])  # at most ``most`` rows
    one = found.groupBy("lang", "doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one"))
    return one.select("lang", F.col("one.text").alias("text"))


def train(rows: DataFrame, per_language: int = 400, most: int = 6400, families: dict[str, str] | None = None) -> Model:
    """Fit on the bounded sample of ``rows`` (doc_id, lang, text)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lowered = pc.utf8_lower(batch.column(1))
            for chunk in T.chunks(lowered):
                found = [(np.flatnonzero(c), c) for c in bucket_counts(chunk)]
                lists = [
                    pa.array([b.astype(np.int32) for b, _ in found], pa.list_(pa.int32())),
                    pa.array([c[b] for b, c in found], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.first, chunk.n), *lists], ["lang", "buckets", "counts"])

    sample = bounded_batches(sampled(rows, per_language, most))
    found = sample.mapInArrow(counted, "lang string, buckets array<int>, counts array<long>").toArrow().to_pydict()
    listed = [(x, np.array(b, np.int64), np.array(c, np.int64)) for x, b, c in zip(*found.values(), strict=True)]
    # the sample comes in any order; the fit should not depend on it
    listed.sort(key=lambda r: (r[0], zlib.crc32(r[1].tobytes() + r[2].tobytes()), r[1].tolist()))
    return fit(listed, families)


def identify_languages(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 400,
    most: int = 6400,
    families: dict[str, str] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    Learned from the text and non-null language of rows that are not held out, on the bounded sample (see ``sampled``); only the whole text enters a
    prediction. ``families`` maps languages to family names (default: learned). Null texts and texts without a letter are ``und`` with
    score 0, as is every text where there is nothing to learn from; with one known language all texts with a letter are of it with score 1. Rows
    without an id are predicted and never learned from; repeated rows get equal results; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    model = docs.sparkSession.sparkContext.broadcast(train(rows, per_language, most, families))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = model.value.languages
        for batch in batches:
            lettered = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            place, score = np.full(batch.num_rows, -1), np.zeros(batch.num_rows)
            if languages:
                for chunk in T.chunks(pc.utf8_lower(batch.column(1))):
                    own = slice(chunk.first, chunk.first + chunk.n)
                    place[own], score[own] = model.value.predict(chunk)
            place = np.where(lettered, place, -1)
            names = pa.array([*languages, UNKNOWN]).take(pa.array(np.where(place < 0, len(languages), place)))
            yield pa.RecordBatch.from_arrays([batch.column(0), names, pa.array(np.where(place < 0, 0.0, score))], ["doc_id", "lang_pred", "score"])

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    asked = bounded_batches(rows.select("doc_id", "text", lettered))
    found = asked.mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
