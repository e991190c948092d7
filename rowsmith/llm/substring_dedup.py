"""Substring dedup: words covered by a window of ``size`` words whose sequence also starts earlier go.

1. **Sketch.** Every window is named by its anchor: the least hash among its ``GRAM``-word grams. Equal windows
   have equal anchors, at different places of the corpus, so the number of places that an anchor
   occupies is no less than the number of equal windows. Each partition counts its anchor places in a
   count-min sketch of ``DEPTH`` rows (counts saturate at 2: only "more than once" is asked), written as
   sparse blocks; blocks are merged by block number on the executors.
2. **Candidates.** The merged sketch, one bit a cell, goes to all tasks. Its size is fixed by ``max_cells``
   (at most ``DEPTH * max_cells / 8`` bytes); up to there it grows with the number of words, so the share of windows
   wrongly let through stays the same. Beyond that more pass, which costs time and never a result: a sketch
   only overestimates, so every repeated window is a candidate.
3. **Exact grouping.** Only candidate windows are shuffled: their 96-bit sequence hash and, once per document, the
   first start in it. A grouped minimum (combined before the shuffle, so a passage in a third of all documents is
   no hot key) gives the earliest document of each sequence and its start there.
4. **Removal.** The earliest starts go back to their documents. A candidate window of a document that is
   not an earliest one also starts earlier: its words are removed. (A candidate that was let through wrongly is its own
   earliest.) No join by window is needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm import textops as T
from rowsmith.llm.common import bounded_batches, order_key

DEPTH = 2
GRAM = 8
BLOCK = 1 << 16  # cells of one sketch block
WORDS_PER_CELL = 2
MAX_CELLS = 1 << 30

_SALT = T.stream(0xA7C4, DEPTH + 1)


def _sliding(x: np.ndarray, size: int, best) -> np.ndarray:
    """``best`` over every run of ``size`` neighbours."""
    span, out = 1, x
    while 2 * span <= size:
        out = best(out[:-span], out[span:])
        span *= 2
    return best(out[: len(x) - size + 1], out[size - span : size - span + len(x) - size + 1]) if span < size else out


class Windows:
    """The windows of a chunk's texts: word spans, starts, anchors and sequence hashes."""

    def __init__(self, chunk: T.Chunk, size: int, with_hash: bool = True):
        self.starts, self.ends, self.ranges = T.word_spans(chunk.buf, chunk.offsets, T.NOT_SPACE)
        n = len(self.starts)
        gram = min(GRAM, size)
        self.at = T.sliding_windows(self.ranges, n, size)
        if not len(self.at):
            self.anchor = self.places = np.zeros(0, np.uint64)
            self.hash, self.check = np.zeros(0, np.int64), np.zeros(0, np.int32)
            return
        words = T.word_hashes(chunk.buf, self.starts, self.ends)
        every = np.arange(n - gram + 1)
        grams = T.range_hashes(words, every, every + gram)
        per = size - gram + 1  # grams in a window
        least = _sliding(grams, per, np.minimum)
        self.anchor = least[self.at]
        # the places of anchors: grams that are the least of some window of one text
        reach = np.zeros(len(grams), np.uint64)
        reach[self.at] = self.anchor
        padded = np.concatenate([np.zeros(per - 1, np.uint64), reach])
        self.places = grams[_sliding(padded, per, np.maximum) == grams]
        if with_hash:
            self.hash = T.range_hashes(words, self.at, self.at + size).view(np.int64)
            other = T.range_hashes(T.mix(words ^ _SALT[DEPTH]), self.at, self.at + size)
            self.check = (other >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _cells(anchors: np.ndarray, cells: int) -> list[np.ndarray]:
    """The anchors' cell in each of the sketch's rows (a power of two of cells a row)."""
    return [(T.mix(anchors ^ _SALT[r]) & np.uint64(cells - 1)) + np.uint64(r * cells) for r in range(DEPTH)]


def _partition_sketch(size: int, cells: int):
    """Per task: its sketch as rows (block, cells seen once, cells seen more often)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held = [], 0
        for batch in batches:
            for chunk in T.chunks(batch.column(0)):
                places = Windows(chunk, size, with_hash=False).places
                if len(places):
                    seen += _cells(places, cells)
                    held += DEPTH * len(places)
            if held > 1 << 22:
                yield _blocks_of(np.concatenate(seen))
                seen, held = [], 0
        if held:
            yield _blocks_of(np.concatenate(seen))

    return run


def _blocks_of(cells: np.ndarray) -> pa.RecordBatch:
    cell, count = np.unique(cells, return_counts=True)
    block, first = np.unique(cell >> np.uint64(16), return_index=True)
    low = (cell & np.uint64(BLOCK - 1)).astype(np.uint16)
    ends = np.r_[first[1:], len(cell)]
    once, more = [], []
    for a, b in zip(first.tolist(), ends.tolist(), strict=True):
        own, n = low[a:b], count[a:b]
        once.append(own[n == 1].tobytes())
        more.append(own[n > 1].tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(block.astype(np.int32)), pa.array(once, pa.binary()), pa.array(more, pa.binary())], ["block", "once", "more"]
    )


def _merge_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the sketches of rows sorted by block: the bits of the cells counted more than once."""
    now, count = None, np.zeros(BLOCK, np.uint8)

    def done() -> pa.RecordBatch:
        bits = np.packbits(count > 1, bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([bits], pa.binary())], ["block", "bits"])

    for batch in batches:
        for block, once, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if block != now:
                if now is not None and (count > 1).any():
                    yield done()
                now = block
                count[:] = 0
            own = np.frombuffer(once, np.uint16)
            count[own] = np.minimum(count[own] + 1, 2)
            count[np.frombuffer(more, np.uint16)] = 2
    if now is not None and (count > 1).any():
        yield done()


class Sketch:
    """The merged sketch: whether a window with this anchor can be repeated."""

    def __init__(self, cells: int, bits: np.ndarray):
        self.cells, self.bits = cells, bits

    def repeated(self, anchors: np.ndarray) -> np.ndarray:
        out = np.ones(len(anchors), bool)
        for cell in _cells(anchors, self.cells):
            out &= (self.bits[(cell >> np.uint64(3)).astype(np.int64)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def merged_sketch(texts: DataFrame, size: int, max_cells: int = MAX_CELLS) -> Sketch:
    """The sketch of all partitions of ``texts`` (one column)."""
    words = (texts.agg(F.sum(F.octet_length(texts.columns[0]))).first()[0] or 0) // 6
    cells = BLOCK
    while cells < min(max_cells, words // WORDS_PER_CELL):
        cells *= 2
    blocks = (
        texts.mapInArrow(_partition_sketch(size, cells), "block int, once binary, more binary")
        .repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(_merge_blocks, "block int, bits binary")
    )
    bits = np.zeros(DEPTH * cells // 8, np.uint8)
    found = blocks.toArrow()  # at most as many bytes as ``bits``
    for block, own in zip(found.column(0).to_pylist(), found.column(1).to_pylist(), strict=True):
        bits[block * BLOCK // 8 : (block + 1) * BLOCK // 8] = np.frombuffer(own, np.uint8)
    return Sketch(cells, bits)


def _candidates(size: int, sketch):
    """Per document: hash, check and first start of every candidate sequence in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for chunk in T.chunks(batch.column(1)):
                w = Windows(chunk, size)
                keep = sketch.value.repeated(w.anchor)
                at, key, check = w.at[keep], w.hash[keep], w.check[keep]
                if not len(at):
                    continue
                doc = np.searchsorted(w.ranges, at, "right") - 1
                order = np.lexsort((at, check, key, doc))
                doc, key, check, at = doc[order], key[order], check[order], at[order]
                fresh = np.r_[True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]) | (check[1:] != check[:-1])]
                doc, key, check, at = doc[fresh], key[fresh], check[fresh], at[fresh]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key),
                        pa.array(check),
                        pa.array(ids[chunk.first + doc]),
                        pa.array((at - w.ranges[doc]).astype(np.int32)),
                    ],
                    ["h", "c", "id", "start"],
                )

    return run


def _removed(size: int, sketch, with_text: bool):
    """Per row: the text without the words of windows that start earlier elsewhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            firsts = batch.column(2)
            for chunk in T.chunks(batch.column(1)):
                w = Windows(chunk, size, with_hash=False)
                again = sketch.value.repeated(w.anchor)
                at = w.at[again]
                own = firsts.slice(chunk.first, chunk.n)
                counts = np.array([0 if x is None else len(x) for x in own.to_pylist()]) if own.null_count else np.asarray(own.value_lengths())
                earliest = own.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + np.repeat(w.ranges[:-1], counts)
                at = at[~np.isin(at, earliest)]
                n = len(w.starts) + 1
                gone = np.cumsum(np.bincount(at, minlength=n) - np.bincount(at + size, minlength=n))[:-1] > 0
                texts = kept_texts(chunk, w, ~gone)
                n_gone = np.add.reduceat(np.r_[gone, False].astype(np.int64), w.ranges[:-1])
                n_words = np.diff(w.ranges)
                n_gone[n_words == 0] = 0
                out = {
                    "doc_id": batch.column(0).slice(chunk.first, chunk.n),
                    "n_words": pa.array(n_words),
                    "n_removed": pa.array(n_gone),
                    "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                }
                if with_text:
                    out["kept_text"] = pa.array(texts, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_pydict(out)

    return run


def kept_texts(chunk: T.Chunk, w, keep: np.ndarray) -> list[bytes]:
    """The kept words of every text, joined by one space."""
    starts, length = w.starts[keep], (w.ends - w.starts)[keep]
    kept = np.concatenate([[0], np.cumsum(keep)])[w.ranges]  # each text's range of kept words
    at = np.cumsum(length + 1) - (length + 1)
    out = np.full(int(at[-1] + length[-1]) + 1 if len(at) else 0, 0x20, np.uint8)
    out[T.spread(at, length)] = chunk.buf[T.spread(starts, length)]
    data = out.tobytes()
    place = np.r_[at, len(out)]
    return [data[place[a] : max(place[a], place[b] - 1)] for a, b in zip(kept[:-1].tolist(), kept[1:].tolist(), strict=True)]


def remove_repeats(
    docs: DataFrame,
    size: int = 20,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_cells: int = MAX_CELLS,
    with_text: bool = True,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text.

    Words are ``[^\\x20\\x09-\\x0D]+`` as they stand; null and blank texts have none. Windows are judged on the input.
    Rows without an id come last, by a hash of their texts. Rows that share id and text are one document (each gets the same result). Ids should
    tell texts apart: of rows that share only the id, which one is the earlier is not defined. An empty table gives
    no rows; other columns are not read.
    """
    spark = docs.sparkSession
    rows = bounded_batches(
        docs.select(
            order_key(id_col, text_col).alias("id"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
        )
    )
    sketch = spark.sparkContext.broadcast(merged_sketch(rows.select("text"), size, max_cells))
    firsts = (
        rows.select("id", "text")
        .mapInArrow(_candidates(size, sketch), "h long, c int, id long, start int")
        .groupBy("h", "c")
        .agg(F.min("id").alias("id"), F.min_by("start", "id").alias("start"))
        .groupBy("id")
        .agg(F.collect_list("start").alias("firsts"))
    )
    return (
        rows.join(firsts, "id", "left")
        .select("doc_id", "text", "firsts")
        .mapInArrow(
            _removed(size, sketch, with_text),
            "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text,
        )
    )
