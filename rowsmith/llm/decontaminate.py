"""Benchmark decontamination by a distributed positional inverted index.

**Index.** The training texts are indexed where they are read: each task turns its texts into segments (whole texts, about
``SEGMENT_BYTES`` together), and a segment is one row: its documents, its terms, and the sorted
list of positions of each term. The table is written to shared storage. No posting is shuffled, so a term in every
document is no hot key. All postings are stored, whatever the benchmark, so one index serves every test set.

**Search.** A test phrase is a run of terms. The terms' counts over the whole corpus (one grouped sum) tell each
phrase's rarest term; its list, moved back by the term's offset, gives the candidate starts, and these are
intersected with the next rarest term's list, moved by its offset, and so on. What is left after
all terms are exact occurrences. The proximity search takes the rarest term's positions and keeps those that
have every other term of the phrase within ``slop`` words.

Benchmarks are searched in blocks of at most ``block_bytes`` of text, so what is broadcast is bounded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm import textops as T
from rowsmith.llm.common import bounded_batches, fresh_name, stored

SEGMENT_BYTES = 8 << 20
SEGMENT_DOCS = 1 << 16

_INDEX = "segment long, doc_ids array<long>, n_words array<int>, terms array<long>, counts array<int>, postings binary"
_MATCH = (
    "segment long, k int, doc_id long, n_words long, "
    "hits array<struct<start:int,end:int>>, items array<string>, near_items array<string>"
)


def _terms(chunk: T.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Term hash of every word, and each text's range of words."""
    buf = T.LOWER[chunk.buf]
    starts, ends, ranges = T.word_spans(buf, chunk.offsets, T.ALNUM)
    return T.word_hashes(buf, starts, ends).view(np.int64), ranges


# ---- the test phrases


@dataclass
class Phrases:
    """Distinct phrases: ``terms[p, :length[p]]``, and the items of each (``owner`` pairs)."""

    terms: np.ndarray  # int64, n x size
    length: np.ndarray
    owner_phrase: np.ndarray
    owner_item: np.ndarray
    items: list[str]

    @property
    def vocabulary(self) -> np.ndarray:
        return np.unique(self.terms[np.arange(self.terms.shape[1]) < self.length[:, None]])


def phrases_of(items: pa.Table, size: int) -> Phrases:
    """All runs of ``size`` words of each item; an item of fewer words, but not none, is one phrase."""
    names = sorted({x or "" for x in items.column(0).to_pylist()})
    place = {x: i for i, x in enumerate(names)}
    rows, lengths, owners = [], [], []
    ids = [place[x or ""] for x in items.column(0).to_pylist()]
    for chunk in T.chunks(items.column(1)):
        terms, ranges = _terms(chunk)
        for k in range(chunk.n):
            own = terms[ranges[k] : ranges[k + 1]]
            n = min(size, len(own))
            for i in range(len(own) - n + 1 if n else 0):
                rows.append(np.pad(own[i : i + n], (0, size - n)))
                lengths.append(n)
                owners.append(ids[chunk.first + k])
    if not rows:
        none = np.zeros(0, np.int64)
        return Phrases(np.zeros((0, size), np.int64), none, none, none, names)
    keyed = np.column_stack([np.array(lengths, np.int64), np.array(rows)])
    unique, back = np.unique(keyed, axis=0, return_inverse=True)
    pairs = np.unique(np.column_stack([back.reshape(-1), np.array(owners)]), axis=0)
    return Phrases(unique[:, 1:], unique[:, 0], pairs[:, 0], pairs[:, 1], names)


# ---- the index


def build_index(docs: DataFrame, gap: int, vocabulary=None) -> DataFrame:
    """The segments of ``docs`` (doc_id, text). ``vocabulary``: a broadcast sorted array of the only terms to keep.

    Texts of one segment lie ``gap`` positions apart, so no phrase or neighbourhood runs over a text's end.
    """

    def segment(number: int, parts: list, ids: list) -> pa.RecordBatch:
        task = TaskContext.get().partitionId()
        counts = np.concatenate([n for _, n in parts])
        terms = np.concatenate([t for t, _ in parts])
        first = np.cumsum(counts + gap) - (counts + gap)
        at = T.spread(first, counts)
        if vocabulary is not None:
            known = vocabulary.value
            slot = np.searchsorted(known, terms)
            keep = known[np.minimum(slot, len(known) - 1)] == terms if len(known) else np.zeros(len(terms), bool)
            terms, at = terms[keep], at[keep]
        order = np.argsort(terms, kind="stable")
        terms, at = terms[order], at[order]
        own, n = np.unique(terms, return_counts=True)
        columns = [
            pa.array([(task << 32) + number]),
            pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), pa.concat_arrays(ids)),
            pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
            pa.array([own], pa.list_(pa.int64())),
            pa.array([n.astype(np.int32)], pa.list_(pa.int32())),
            pa.array([at.astype(np.int32).tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["segment", "doc_ids", "n_words", "terms", "counts", "postings"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, ids, n_bytes, n_docs = 0, [], [], 0, 0
        for batch in batches:
            for chunk in T.chunks(batch.column(1)):
                terms, ranges = _terms(chunk)
                parts.append((terms, np.diff(ranges)))
                ids.append(batch.column(0).slice(chunk.first, chunk.n))
                n_bytes, n_docs = n_bytes + len(chunk.buf), n_docs + chunk.n
                if n_bytes >= SEGMENT_BYTES or n_docs >= SEGMENT_DOCS:
                    yield segment(number, parts, ids)
                    number, parts, ids, n_bytes, n_docs = number + 1, [], [], 0, 0
        if parts:
            yield segment(number, parts, ids)

    return docs.mapInArrow(run, _INDEX)


# ---- the search


def _search(phrases, gap: int, slop: int | None):
    """Per segment: the documents with their exact hits, their items and those of proximity matches."""

    def of_segment(doc_counts: np.ndarray, terms: np.ndarray, counts: np.ndarray, postings: np.ndarray, asked: np.ndarray):
        p: Phrases = phrases.value[0]
        keep = np.isin(terms, asked, assume_unique=True)
        postings = postings[T.spread((np.cumsum(counts) - counts)[keep], counts[keep])]
        terms, counts = terms[keep], counts[keep]
        order: np.ndarray = phrases.value[1]  # each phrase's offsets, rarest term first
        first = np.cumsum(doc_counts + gap) - (doc_counts + gap)
        span = int(first[-1] + doc_counts[-1] + gap) if len(first) else 1
        begin = np.cumsum(counts) - counts
        # lists of all terms in one sorted array: term's place times span plus position
        lists = np.repeat(np.arange(len(terms)), counts) * span + postings
        slot = np.searchsorted(terms, p.terms)
        there = terms[np.minimum(slot, len(terms) - 1)] == p.terms if len(terms) else np.zeros(p.terms.shape, bool)
        used = np.arange(p.terms.shape[1]) < p.length[:, None]
        live = np.flatnonzero((there | ~used).all(axis=1) & (p.length > 0))
        rarest = order[live, 0]
        term = slot[live, rarest]
        phrase = np.repeat(live, counts[term])
        at = postings[T.spread(begin[term], counts[term])].astype(np.int64)

        starts, own = at - order[phrase, 0], phrase
        for step in range(1, p.terms.shape[1]):
            ask = np.flatnonzero(step < p.length[own])
            if not len(ask):
                break
            offset = order[own[ask], step]
            want = slot[own[ask], offset] * span + starts[ask] + offset
            found = np.searchsorted(lists, want)
            missing = lists[np.minimum(found, len(lists) - 1)] != want
            keep = np.ones(len(own), bool)
            keep[ask[missing]] = False
            starts, own = starts[keep], own[keep]
        exact = (own, starts, first)
        if slop is None:
            return exact, (np.zeros(0, np.int64), np.zeros(0, np.int64))

        near, around = phrase, at
        for step in range(1, p.terms.shape[1]):
            ask = np.flatnonzero(step < p.length[near])
            if not len(ask):
                break
            of_term = slot[near[ask], order[near[ask], step]] * span
            found = np.searchsorted(lists, of_term + around[ask] - slop)
            hit = lists[np.minimum(found, len(lists) - 1)]
            missing = (found == len(lists)) | (hit > of_term + around[ask] + slop)
            keep = np.ones(len(near), bool)
            keep[ask[missing]] = False
            near, around = near[keep], around[keep]
        return exact, (near, around)

    def items_of(docs: np.ndarray, phrase: np.ndarray, n_docs: int) -> list[list[str]]:
        p: Phrases = phrases.value[0]
        pairs = np.unique(docs * np.int64(len(p.terms) + 1) + phrase)
        doc, phrase = pairs // (len(p.terms) + 1), pairs % (len(p.terms) + 1)
        lo, hi = np.searchsorted(p.owner_phrase, phrase), np.searchsorted(p.owner_phrase, phrase, "right")
        out: list = [[] for _ in range(n_docs)]
        both = np.unique(np.column_stack([np.repeat(doc, hi - lo), p.owner_item[T.spread(lo, hi - lo)]]), axis=0)
        for d, i in both.tolist():
            out[d].append(p.items[i])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, asked = phrases.value[0].length, phrases.value[0].vocabulary
        for batch in batches:
            for r in range(batch.num_rows):
                cell = lambda c: batch.column(c)[r].values  # noqa: B023, E731
                ids, n_words = cell(1), cell(2).to_numpy().astype(np.int64)
                postings = np.frombuffer(batch.column(5)[r].as_py(), np.int32)
                (own, starts, first), (near, around) = of_segment(
                    n_words, cell(3).to_numpy(), cell(4).to_numpy().astype(np.int64), postings, asked
                )
                n = len(n_words)
                doc = np.searchsorted(first, starts, "right") - 1
                hits: list = [[] for _ in range(n)]
                begin = starts - first[doc]
                spans = np.unique(np.column_stack([doc, begin, begin + length[own]]), axis=0)
                for d, a, b in spans.tolist():
                    if hits[d] and a <= hits[d][-1]["end"]:
                        hits[d][-1]["end"] = max(b, hits[d][-1]["end"])
                    else:
                        hits[d].append({"start": a, "end": b})
                near_doc = np.searchsorted(first, around, "right") - 1
                out = {
                    "segment": pa.array([batch.column(0)[r].as_py()] * n, pa.int64()),
                    "k": pa.array(range(n), pa.int32()),
                    "doc_id": ids,
                    "n_words": pa.array(n_words),
                    "hits": pa.array(hits, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    "items": pa.array(items_of(doc, own, n), pa.list_(pa.string())),
                    "near_items": pa.array(items_of(near_doc, near, n), pa.list_(pa.string())),
                }
                yield pa.RecordBatch.from_pydict(out)

    return run


def _merged(hits):
    """Sorted spans with those that touch made one."""
    zero = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc, x):
        last = F.element_at(acc, -1)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        joins = (F.size(acc) > 0) & (x["start"] <= F.get(acc, F.size(acc) - 1)["end"])
        return F.when(joins, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(grown))).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(F.sort_array(hits), zero, step)


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 10,
    slop: int | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = 16 << 20,
    restricted: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, hits (word ranges inside an exact occurrence of a phrase, merged), items
    (sorted names of the items with an occurring phrase), near_items (those with a proximity match; none without ``slop``).

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased; a null text has none, an item without words matches
    nothing, a null item id is ''. Items that share an id are one item. Repeated rows give repeated rows; an empty table
    gives none; an empty benchmark hits nothing; other columns are not read. The index holds the postings of every word of ``docs``;
    with ``restricted`` and a benchmark of one block it holds those of the benchmark's words only, with the same result.
    """
    spark = docs.sparkSession
    rows = bounded_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text_col).alias("item_text")
    ).where(F.col("item_text").isNotNull())
    total = items.agg(F.sum(F.octet_length("item_text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    gap = size + (slop or 0) + 1
    broadcast = spark.sparkContext.broadcast
    block_of = F.pmod(F.xxhash64("item", "item_text"), F.lit(blocks))
    index = only = None
    found = None
    for b in range(blocks):
        phrases = phrases_of(items.where(block_of == b).toArrow(), size)  # a block: about block_bytes
        words = phrases.vocabulary
        if index is None:
            only = broadcast(words) if restricted and blocks == 1 else None
            index = stored(build_index(rows, gap, only), "decontaminate-index")
        counted = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).select("t.terms", "t.counts")
        if only is None:
            own = spark.createDataFrame(pa.table({"terms": pa.array(words)}))  # at most a block's words
            counted = counted.join(F.broadcast(own), "terms", "left_semi")
        sums = counted.groupBy("terms").agg(F.sum("counts").alias("n")).toArrow()  # at most one row a word of the block
        frequency = np.zeros(len(words), np.int64)
        frequency[np.searchsorted(words, sums.column(0).to_numpy())] = sums.column(1).to_numpy()
        if len(words):
            often = frequency[np.searchsorted(words, phrases.terms).clip(max=len(words) - 1)]
            often[np.arange(size) >= phrases.length[:, None]] = np.iinfo(np.int64).max
            order = np.argsort(often, axis=1, kind="stable")
        else:
            order = np.zeros((0, size), np.int64)
        one = index.mapInArrow(_search(broadcast((phrases, order)), gap, slop), _MATCH)
        found = one if found is None else found.unionByName(one)
    if blocks > 1:
        lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("hits", "items", "near_items")]
        found = (
            found.groupBy("segment", "k")
            .agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), *lists)
            .withColumn("hits", _merged(F.col("hits")))
        )
    names = [F.sort_array(F.array_distinct(c)).alias(c) for c in ("items", "near_items")]
    return found.select("doc_id", "n_words", "hits", *names)


def contamination_report(docs: DataFrame, benchmark: DataFrame, size: int = 10, **names) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of ``docs`` (see ``find_benchmark``)."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["start"])
    return find_benchmark(docs, benchmark, size, **names).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 10, *, id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """The rows of ``docs``, all columns, without an occurring phrase of ``benchmark``."""
    key = fresh_name(docs, "row_key")
    own_key = F.xxhash64(F.col(id_col), F.col(text_col))
    found = find_benchmark(docs.select(own_key.alias("row_key"), F.col(text_col).alias("text")), benchmark, size, id_col="row_key", **names)
    hit = stored(found.where(F.size("hits") > 0).select(F.col("doc_id").alias(key)).distinct(), "decontaminate-hit")
    return docs.withColumn(key, own_key).join(hit, key, "left_anti").select(*docs.columns)
