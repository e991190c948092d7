"""Quality classifier: nearest-neighbour voting among broadcast labelled latent-semantic vectors.

**Terms.** Three hashed blocks per text: word shapes (runs of upper case, lower case, digits, and each sign as itself),
pairs of neighbouring shapes joined with whether the two words are equal, and the lower-cased words.
Counts are damped, weighted by inverse document frequency, and each block is scaled to its share.

**Latent space.** A truncated singular value decomposition of the labelled sample's term matrix (randomised range
finder, fixed seed) projects every text to ``rank`` numbers.

**Vote.** For every text, in blocks, the exact cosines with all labelled vectors; the labels of the ``k`` nearest
vote with weight cosine ** ``SHARPNESS``.

The classifier is fitted on a bounded sample: at most ``per_class`` labelled rows of each label, those of the
smallest hash of the id, never rows held out. What is broadcast is bounded by that: the
projection and ``2 * per_class`` vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm import textops as T
from rowsmith.llm.common import bounded_batches, held_out, labelled_sample

SHAPES, PAIRS, WORDS = 1 << 10, 1 << 11, 1 << 11
TERMS = SHAPES + PAIRS + WORDS
#: Share of each block in a vector's squared length.
BLOCKS = ((0, SHAPES, 1.0), (SHAPES, SHAPES + PAIRS, 1.0), (SHAPES + PAIRS, TERMS, 0.15))
SHARPNESS = 8
#: Cosines this near to that of rank k are equal to it.
TIE = np.float32(1e-6)
ROWS_AT_ONCE = 128

# The class of each byte: upper case, lower case and all bytes beyond ASCII, digits; any other byte is its own class.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[0x41:0x5B] = ord("A")
_CLASS[0x61:0x7B] = ord("a")
_CLASS[0x80:] = ord("a")
_CLASS[0x30:0x3A] = ord("0")


def _bucket(hashes: np.ndarray, size: int) -> np.ndarray:
    return (hashes & np.uint64(size - 1)).astype(np.int64)


def term_counts(chunk: T.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) of every term of every text of the chunk, by text and term."""
    starts, ends, ranges = T.word_spans(chunk.buf, chunk.offsets, T.NOT_SPACE)
    n = len(starts)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    classes = _CLASS[chunk.buf]
    head = np.ones(len(classes), bool)
    head[1:] = classes[1:] != classes[:-1]
    head[starts] = True
    place = np.concatenate([[0], np.cumsum(head)])
    shapes = T.word_hashes(classes[head], place[starts], place[ends])
    words = T.word_hashes(T.LOWER[chunk.buf], starts, ends)
    text = np.repeat(np.arange(chunk.n), np.diff(ranges))
    pair = np.flatnonzero(text[1:] == text[:-1])
    same = (words[pair] == words[pair + 1]).astype(np.uint64)
    with np.errstate(over="ignore"):
        pairs = T.mix(shapes[pair] * np.uint64(3) + shapes[pair + 1] * np.uint64(5) + same)
    keys = np.concatenate(
        [
            text * TERMS + _bucket(shapes, SHAPES),
            text[pair] * TERMS + SHAPES + _bucket(pairs, PAIRS),
            text * TERMS + SHAPES + PAIRS + _bucket(words, WORDS),
        ]
    )
    keys, counts = np.unique(keys, return_counts=True)
    return keys // TERMS, keys % TERMS, counts


def _matrix(text: np.ndarray, term: np.ndarray, counts: np.ndarray, n: int, idf: np.ndarray | None) -> np.ndarray:
    """Weighted rows of ``n`` texts (float32), each block scaled to its share; a text without terms is all zero."""
    out = np.zeros((n, TERMS), np.float32)
    out[text, term] = np.log1p(counts)
    if idf is not None:
        out *= idf
    for a, b, share in BLOCKS:
        norm = np.sqrt(np.einsum("ij,ij->i", out[:, a:b], out[:, a:b]))
        out[:, a:b] *= (np.sqrt(share) / np.maximum(norm, 1e-12))[:, None]
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    return np.where(norm[:, None] > 1e-9, rows / np.maximum(norm, 1e-9)[:, None], 0).astype(np.float32)


@dataclass
class Model:
    idf: np.ndarray
    projection: np.ndarray  # TERMS x rank
    vectors: np.ndarray  # labelled x rank, of length one
    labels: np.ndarray
    k: int

    def scores(self, text: np.ndarray, term: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
        """Share of label 1 in the weighted vote; a text without terms gets the sample's share."""
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        out = np.full(n, prior)
        if not len(self.labels):
            return out
        k = min(self.k, len(self.labels))
        for lo in range(0, n, ROWS_AT_ONCE):
            hi = min(n, lo + ROWS_AT_ONCE)
            a, b = np.searchsorted(text, [lo, hi])
            rows = _unit(_matrix(text[a:b] - lo, term[a:b], counts[a:b], hi - lo, self.idf) @ self.projection)
            cosine = rows @ self.vectors.T
            at_rank_k = np.partition(cosine, len(self.labels) - k, axis=1)[:, len(self.labels) - k]
            row, near = np.nonzero(cosine >= at_rank_k[:, None] - TIE)
            weight = np.clip(cosine[row, near].astype(np.float64), 0, 1) ** SHARPNESS
            total = np.bincount(row, weight, hi - lo)
            voted = np.bincount(row, weight * self.labels[near], hi - lo) / np.maximum(total, 1e-12)
            out[lo:hi] = np.where(total > 1e-9, voted, prior)
        return np.clip(out, 0, 1)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rank: int, k: int) -> Model:
    """The model of a labelled sample (each row: its terms and their counts)."""
    n = len(rows)
    text = np.repeat(np.arange(n), [len(t) for t, _ in rows]) if n else np.zeros(0, np.int64)
    term = np.concatenate([t for t, _ in rows]).astype(np.int64) if n else text
    counts = np.concatenate([c for _, c in rows]) if n else text
    frequency = np.bincount(term, minlength=TERMS)
    idf = (np.log((1 + n) / (1 + frequency)) + 0.1).astype(np.float32)
    matrix = _matrix(text, term, counts, n, idf)
    rng = np.random.default_rng(17)
    basis = matrix @ rng.standard_normal((TERMS, rank + 16)).astype(np.float32)
    for _ in range(4):
        basis, _ = np.linalg.qr(basis)
        basis = matrix @ (matrix.T @ basis)
    basis, _ = np.linalg.qr(basis)
    _, _, right = np.linalg.svd(basis.T @ matrix, full_matrices=False)
    projection = np.ascontiguousarray(right[:rank].T).astype(np.float32)
    return Model(idf, projection, _unit(matrix @ projection), labels.astype(np.float64), k)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", *, per_class: int = 1500, rank: int = 64, k: int = 25) -> Model:
    """Fit on the bounded sample; without labelled rows every score is 0.5."""

    def terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in T.chunks(batch.column(1)):
                text, term, counts = term_counts(chunk)
                cut = np.searchsorted(text, np.arange(chunk.n + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(cut), pa.array(x.astype(np.int32))) for x in (term, counts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.n), batch.column(2).slice(chunk.first, chunk.n), *lists],
                    ["id", "label", "terms", "counts"],
                )

    sample = bounded_batches(labelled_sample(docs.select("doc_id", "text"), labels, label_col, (per_class, per_class)))
    found = sample.mapInArrow(terms_of, "id long, label int, terms array<int>, counts array<int>").toArrow()
    found = found.sort_by([("id", "ascending"), ("label", "ascending")])
    lists = [found.column(c).combine_chunks() for c in ("terms", "counts")]
    rows = [(lists[0][i].values.to_numpy(), lists[1][i].values.to_numpy()) for i in range(len(found))]
    return fit(rows, found.column("label").to_numpy(), rank, k)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    threshold: float = 0.7,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    per_class: int = 1500,
    rank: int = 64,
    k: int = 25,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 from ``threshold``).

    Only texts enter a score. Null, empty and blank texts get the sample's share of label 1 (at most one half
    where both labels are as frequent). Labelled vectors as near as the one of rank ``k`` all vote. Labels other than 0 and 1 and labels without an id are not used; repeated
    rows get equal scores; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(train(rows, labels, label_col, per_class=per_class, rank=rank, k=k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for chunk in T.chunks(batch.column(1)):
                score[chunk.first : chunk.first + chunk.n] = model.value.scores(*term_counts(chunk), chunk.n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    scored = bounded_batches(rows).mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
