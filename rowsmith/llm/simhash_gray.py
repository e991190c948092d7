"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints: bit b is 1 if bit b is set in over half of the XXH64 (seed 42) values of a text's
word shingles, repeats included.

Links: equal fingerprints are first collapsed to one row (its smallest doc_id), so a group of
copies is one fingerprint from there on. Two fingerprints that differ in at most ``max_bits``
bits agree on one of ``max_bits + 1`` blocks; every fingerprint goes to the bucket of each of its block
values. Inside a bucket the fingerprints are sorted by Gray rank, so that neighbours
share long bit patterns, and upper nodes keep what their children share: a mask of the common
bits and their pattern. A join descends from node pairs to their children: the differences on the
bits that both nodes fix are a lower bound for all pairs below, so a pair of nodes beyond
``max_bits`` is dropped with the whole groups below it; a pair of nodes that is certainly within it is linked
as a whole, without its pairs. Only a spanning forest of each bucket leaves it.

A bucket with more than ``bucket_rows`` fingerprints is cut by the same rule again: its
undecided bits are cut into blocks, and it becomes smaller buckets, until it is small or
at most ``FEW_BITS`` bits are undecided, which bounds it by 2 ** FEW_BITS distinct fingerprints.

The forests' edges are joined into components by ``components.connected``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowsmith.llm import textops as T
from rowsmith.llm.common import bounded_batches, fresh_name, order_key, stored
from rowsmith.llm.components import Forest, connected

SEED = 42
FEW_BITS = 14
FANOUT = 8
PAIRS_AT_ONCE = 1 << 19


# ---- fingerprints


def _shingle_hashes(chunk: T.Chunk, width: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of every text, and each text's range of them."""
    buf = T.LOWER[chunk.buf]
    starts, ends, ranges = T.word_spans(buf, chunk.offsets, T.NOT_SPACE)
    n_words = np.diff(ranges)
    n_shingles = np.where(n_words >= width, n_words - width + 1, (n_words > 0).astype(n_words.dtype))
    # words of all texts, one space between: word w lies at at[w] .. at[w] + length[w]
    length = ends - starts
    at = np.cumsum(length + 1) - (length + 1)
    joined = np.full(int(at[-1] + length[-1]) if len(at) else 0, 0x20, np.uint8)
    joined[T.spread(at, length)] = buf[T.NOT_SPACE[buf]]
    first = T.spread(ranges[:-1], n_shingles)
    last = first + np.minimum(np.repeat(n_words, n_shingles), width) - 1
    data, digest = joined.tobytes(), xxhash.xxh64_intdigest
    lo, hi = at[first].tolist(), (at[last] + length[last]).tolist()
    hashes = np.fromiter((digest(data[a:b], SEED) for a, b in zip(lo, hi, strict=True)), np.uint64, len(lo))
    return hashes, np.concatenate([[0], np.cumsum(n_shingles)])


def fingerprints(docs: DataFrame, width: int = 3, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long; no words, empty or null: 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows, np.uint64)
            for chunk in T.chunks(batch.column(1)):
                out[chunk.first : chunk.first + chunk.n] = T.majority_bits(*_shingle_hashes(chunk, width))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], ["doc_id", "fp"])

    texts = bounded_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    return texts.mapInArrow(run, "doc_id long, fp long")


# ---- the index


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each word in Gray order: the number whose Gray code it is."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


class GrayIndex:
    """Fingerprints of whole buckets, sorted by (bucket, Gray rank), under levels of masked patterns."""

    def __init__(self, bucket: np.ndarray, fps: np.ndarray):
        order = np.lexsort((gray_rank(fps), bucket))
        self.fps, self.order = fps[order], order
        bucket = bucket[order]
        # level 0 holds the fingerprints; a node above holds up to FANOUT neighbours of one bucket
        self.levels = [(self.fps, self.fps, np.arange(len(fps)), np.ones(len(fps), np.int64))]
        while True:
            fresh = np.r_[True, bucket[1:] != bucket[:-1]]
            if fresh.all():
                break
            run = np.flatnonzero(fresh)
            place = np.arange(len(bucket)) - np.repeat(run, np.diff(np.r_[run, len(bucket)]))
            first = np.flatnonzero(place % FANOUT == 0)
            low, high = self.levels[-1][:2]
            counts = np.diff(np.r_[first, len(bucket)])
            self.levels.append((np.bitwise_and.reduceat(low, first), np.bitwise_or.reduceat(high, first), first, counts))
            bucket = bucket[first]

    def links(self, max_bits: int, forest: Forest) -> None:
        """Join every pair of one bucket within ``max_bits`` bits in ``forest`` (by sorted place)."""
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top][0]))
        todo = [(top, roots, roots)]
        while todo:
            level, a, b = todo.pop()
            if len(a) > PAIRS_AT_ONCE:
                half = len(a) // 2
                todo += [(level, a[half:], b[half:]), (level, a[:half], b[:half])]
                continue
            low, high = self.levels[level][:2]
            # bits that both nodes fix and on which they differ: no pair below differs in fewer
            apart = np.bitwise_count((low[a] & ~high[b]) | (low[b] & ~high[a]))
            near = apart <= max_bits
            a, b = a[near], b[near]
            if level == 0:
                distinct = a != b
                forest.join(a[distinct], b[distinct])
                continue
            # bits on which any two members can differ: no pair below differs in more
            whole = np.bitwise_count((high[a] | high[b]) & ~(low[a] & low[b])) <= max_bits
            for x in (a[whole], b[whole]):
                self._join_members(level, x, forest)
            lead_a, lead_b = self._leaves(level, a[whole])[0], self._leaves(level, b[whole])[0]
            forest.join(lead_a, lead_b)
            a, b = a[~whole], b[~whole]
            # a node and itself, or two nodes, whose members are all in one tree need no more work
            open_ = ~self._joined(level, a, b, forest)
            a, b = a[open_], b[open_]
            _, _, first, counts = self.levels[level]
            n = counts[a] * counts[b]
            pair = np.repeat(np.arange(len(a)), n)
            k = T.spread(np.zeros(len(a), np.int64), n)
            i, j = k // counts[b][pair], k % counts[b][pair]
            keep = (a[pair] != b[pair]) | (i <= j)
            pair, i, j = pair[keep], i[keep], j[keep]
            if len(pair):
                todo.append((level - 1, first[a[pair]] + i, first[b[pair]] + j))

    def _leaves(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First leaf and end of the leaves below each node."""
        lo, hi = nodes, nodes + 1
        for lv in range(level, 0, -1):
            first = np.r_[self.levels[lv][2], len(self.levels[lv - 1][0])]
            lo, hi = first[lo], first[hi]
        return lo, hi

    def _join_members(self, level: int, nodes: np.ndarray, forest: Forest) -> None:
        lo, hi = self._leaves(level, np.unique(nodes))
        rest = T.spread(lo + 1, hi - lo - 1)
        forest.join(np.repeat(lo, hi - lo - 1), rest)

    def _joined(self, level: int, a: np.ndarray, b: np.ndarray, forest: Forest) -> np.ndarray:
        """Whether all members of both nodes are in one tree already."""
        if not len(a):
            return np.zeros(0, bool)
        nodes = np.arange(len(self.levels[level][0]))
        lo, _ = self._leaves(level, nodes)
        roots = forest.roots()
        least, most = np.minimum.reduceat(roots, lo), np.maximum.reduceat(roots, lo)
        one = least == most
        return one[a] & one[b] & (least[a] == least[b])


# ---- buckets


def _blocks(bits: list[int], parts: int) -> list[list[int]]:
    cut = np.linspace(0, len(bits), parts + 1).astype(int)
    return [bits[cut[i] : cut[i + 1]] for i in range(parts) if cut[i + 1] > cut[i]]


def _mask(bits: list[int]) -> int:
    """The word with these bits, as a signed long."""
    mask = sum(1 << b for b in bits)
    return mask - (1 << 64) if mask >> 63 else mask


def bucketed(rows: DataFrame, max_bits: int, bucket_rows: int = 1 << 15) -> DataFrame:
    """``rows`` (``fp`` and other columns) once per bucket ``key``: rows whose fingerprints are within ``max_bits`` bits share one.

    No bucket has more than ``bucket_rows`` rows unless at most FEW_BITS bits of its fingerprints differ. ``rows`` is read
    more than once, so it should be a stored table.
    """
    own = rows.columns
    parts = max_bits + 1
    out = None
    level, paths = rows.withColumn("outer", F.lit(0).cast("long")).withColumn("path", F.lit(0)), [list(range(64))]
    while True:
        # paths: which bits are undecided after which blocks; a row's path says which of them is its own
        cut = [_blocks(rest, parts) for rest in paths]
        masks = F.array(*[F.array(*[F.lit(_mask(block)) for block in blocks]) for blocks in cut])
        blocks = F.transform(F.get(masks, F.col("path")), lambda m, i: F.struct(
            (F.col("path") * parts + i).alias("block"),
            F.xxhash64("outer", i, F.col("fp").bitwiseAND(m)).alias("key"),
        ))
        routed = level.select(*own, F.explode(blocks).alias("r")).select(*own, "r.block", "r.key")
        left = [[b for b in rest if b not in block] for rest, blocks_ in zip(paths, cut, strict=True) for block in blocks_]
        large = None
        if max(map(len, left)) > FEW_BITS:
            large = routed.groupBy("block", "key").count().where(F.col("count") > bucket_rows).select("block", "key")
            large = stored(large, "simhash-large")
            if not large.limit(1).count():
                large = None
        small = routed if large is None else routed.join(large, ["block", "key"], "left_anti")
        found = small.select("key", *own)
        out = found if out is None else out.unionByName(found)
        if large is None:
            return out
        again = routed.join(large, ["block", "key"], "left_semi")
        level, paths = again.select(*own, F.col("key").alias("outer"), F.col("block").alias("path")), left


def _forest_edges(max_bits: int):
    """Per task: the spanning forest of every bucket, as (a, b) with a < b's place in the bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        count, enough = 0, 1 << 16

        def flush(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(keys) < 2:
                return
            index = GrayIndex(keys, fps)
            forest = Forest(len(fps))
            index.links(max_bits, forest)
            roots = forest.roots()
            linked = np.flatnonzero(roots != np.arange(len(roots)))
            if len(linked):
                a, b = index.fps[linked].view(np.int64), index.fps[roots[linked]].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)))
            count += batch.num_rows
            if count < enough:
                continue
            keys, fps = (np.concatenate(x) for x in zip(*held, strict=True))
            # the last bucket may go on in the next batch
            cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
            yield from flush(keys[:cut], fps[:cut])
            held, count = [(keys[cut:], fps[cut:])], len(keys) - cut
            enough = count + (1 << 16)
        if held:
            yield from flush(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def near_links(distinct: DataFrame, max_bits: int = 3, *, bucket_rows: int = 1 << 15) -> DataFrame:
    """Edges (a, b) of distinct fingerprints ``fp`` that connect exactly those within ``max_bits`` bits."""
    buckets = bucketed(distinct.select("fp"), max_bits, bucket_rows)
    return buckets.repartition("key").sortWithinPartitions("key").mapInArrow(_forest_edges(max_bits), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    width: int = 3,
    max_bits: int = 3,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_rows: int = 1 << 15,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id that can be reached over links, itself included. Empty, blank and
    null texts have the fingerprint zero and link like any other. A component_id is null where no row of the component has an id. Repeated rows give repeated rows; an empty table gives none;
    other columns are not read.
    """
    fps = stored(fingerprints(docs, width, id_col=id_col, text_col=text_col), "simhash-fingerprints")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    edges = stored(near_links(distinct, max_bits, bucket_rows=bucket_rows).distinct(), "simhash-edges")
    labels = connected(edges).withColumnRenamed("id", "fp")
    linked = stored(distinct.join(labels, "fp"), "simhash-linked")
    groups = linked.groupBy("label").agg(F.min("least").alias("component"))
    alone = distinct.join(labels, "fp", "left_anti").select("fp", F.col("least").alias("component"))
    # stored, so that the join below reads its two sides as they are and a hot fingerprint's rows can be split
    moved = stored(linked.join(groups, "label").select("fp", "component").unionByName(alone), "simhash-components")
    return fps.join(moved, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def one_of_each_group(
    docs: DataFrame, width: int = 3, max_bits: int = 3, *, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = 1 << 15
) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their group: the document of the smallest id, once.

    Rows without an id come after all others, in the order of a hash of their texts.
    """
    key, number = fresh_name(docs, "id_key"), fresh_name(docs, "copy_number")
    keyed = docs.withColumn(key, order_key(id_col, text_col))
    found = near_duplicates(keyed, width, max_bits, id_col=key, text_col=text_col, bucket_rows=bucket_rows)
    stays = stored(found.where("doc_id = component_id").select(F.col("doc_id").alias(key)).distinct(), "simhash-stays")
    copies = Window.partitionBy(key, F.xxhash64(text_col)).orderBy(key)
    once = keyed.join(stays, key, "left_semi").withColumn(number, F.row_number().over(copies)).where(F.col(number) == 1)
    return once.select(*docs.columns)
