"""Sampled SentencePiece encoding (forward filtering, backward sampling) and exact decoding.

A text's segmentations are the paths of its piece lattice. A path's weight is the product of its pieces'
weights, ``(1 + rank) ** -alpha`` for a piece of that rank in the model (the model's scores are
negative ranks). Forward filtering sums the weights of all paths up to every place; backward sampling then walks from
the end and draws each last piece in proportion, so whole segmentations are drawn with their exact probability.

No piece goes on over a space after another character, so the lattice falls apart into units (spaces and the
characters up to the next space) that are sampled on their own. Equal units share one filtered lattice, kept in the
worker up to ``CACHE_UNITS``. Every draw is a hash of (seed, row key, unit's number in the text, place in the unit):
the result depends on nothing else, be it partitions, batches or retries.

Characters that no piece writes, and a literal U+2581, are written as byte pieces, so decoding
always gives the text back.

The vocabulary is read once on the driver and broadcast (its size is checked).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm import textops as T
from rowsmith.llm.common import bounded_batches

SPACE = "▁"
CACHE_UNITS = 200_000
MAX_MODEL_BYTES = 64 << 20

_UNIT = re.compile(" +[^ ]*")
_BITS = 32


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Trie:
    """Byte strings and their numbers; its steps lie in an open hash table, so many walks go on at once."""

    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, words: dict[bytes, int]):
        steps: dict[int, int] = {}
        number = [-1]
        for word, i in words.items():
            node = 0
            for byte in word:
                key = node << 8 | byte
                node = steps.setdefault(key, len(number))
                if node == len(number):
                    number.append(-1)
            number[node] = i
        self.number = np.array(number, np.int64)
        bits = max(4, (4 * len(steps)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.nodes = np.zeros(1 << bits, np.int64)
        keys = np.fromiter(steps.keys(), np.int64, len(steps))
        nodes = np.fromiter(steps.values(), np.int64, len(steps))
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slot] == -1)
            _, one = np.unique(slot[free], return_index=True)
            placed = free[one]
            self.keys[slot[placed]], self.nodes[slot[placed]] = keys[placed], nodes[placed]
            rest = np.ones(len(keys), bool)
            rest[placed] = False
            keys, nodes, slot = keys[rest], nodes[rest], (slot[rest] + 1) & self.last

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.view(np.uint64) * self.FACTOR) >> self.shift).astype(np.int64)

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The next node, or -1."""
        key = node << 8 | byte
        slot = self._slot(key)
        found = self.keys[slot]
        out = np.where(found == key, self.nodes[slot], -1)
        go = np.flatnonzero((found != key) & (found != -1))
        while len(go):
            slot[go] = (slot[go] + 1) & self.last
            found = self.keys[slot[go]]
            hit = found == key[go]
            out[go[hit]] = self.nodes[slot[go[hit]]]
            go = go[~hit & (found != -1)]
        return out

    def matches(self, data: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(starts, ends, numbers) of the words found from ``starts`` on, one entry for each length, short ones first."""
        out = []
        node, at = np.zeros(len(starts), np.int64), starts
        while len(starts):
            node = self.step(node, data[at].astype(np.int64))
            live = node >= 0
            node, starts, at = node[live], starts[live], at[live] + 1
            number = self.number[node]
            whole = number >= 0
            out.append((starts[whole], at[whole], number[whole]))
            more = at < len(data)
            if not more.all():
                node, starts, at = node[more], starts[more], at[more]
        return out


class Pieces:
    """A model's pieces: a trie of the written ones, log weights, byte ids, and what each id decodes to."""

    def __init__(self, model: bytes, alpha: float):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.byte_id = np.full(256, -1, np.int64)
        self.log_weight = np.zeros(n)
        self.bytes: list[bytes] = [b""] * n
        written: dict[bytes, int] = {}
        used: set[str] = set()
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.bytes[i] = bytes([value])
                self.log_weight[i] = -alpha * np.log(1.0 + n)
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                if SPACE in piece.lstrip(SPACE):
                    raise ValueError(f"piece {piece!r} goes on over a space: units would not be independent")
                written[piece.encode()] = i
                self.bytes[i] = piece.replace(SPACE, " ").encode()
                self.log_weight[i] = -alpha * np.log(1.0 + min(-sp.get_score(i), n))
                used.update(piece)
        if (self.byte_id < 0).any():
            raise ValueError("the model has no byte pieces, so decoding could lose characters")
        self.trie = Trie(written)
        # stands for a literal SPACE sign; three bytes like it, and in no piece
        self.other = next(chr(c) for c in range(0xE000, 0xF8FF) if chr(c) not in used)
        self.between = next(chr(c) for c in range(32) if chr(c) not in used)
        self.byte_start = np.concatenate([[0], np.cumsum([len(b) for b in self.bytes])])
        self.byte_data = np.frombuffer(b"".join(self.bytes), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        lo, n = self.byte_start[ids], np.diff(self.byte_start)[ids]
        return self.byte_data[T.spread(lo, n)].tobytes()[1:]  # without the space put before every text


class Lattices:
    """Filtered lattices of distinct units, as flat arrays over nodes (byte places) and their incoming edges."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.clear()

    def clear(self) -> None:
        # in small types: a worker keeps this between tasks
        few, short = len(self.pieces.bytes) <= 1 << 16, max(map(len, self.pieces.bytes)) < 256
        self.code: dict[str, int] = {}
        self.first_node = np.zeros(0, np.int32)
        self.last_node = np.zeros(0, np.int32)
        self.first_edge = np.zeros(0, np.int32)  # of each node
        self.bound = np.zeros(0, np.uint32)  # cumulated probability of a node's edges, in 2 ** -_BITS
        self.piece = np.zeros(0, np.uint16 if few else np.int32)
        self.length = np.zeros(0, np.uint8 if short else np.int32)  # bytes of each edge

    def codes(self, units: list[str]) -> np.ndarray:
        """The units' numbers, after adding the new ones."""
        if len(self.code) > CACHE_UNITS:
            self.clear()
        new = [u for u in dict.fromkeys(units) if u not in self.code]
        if new:
            self._add(new)
        return np.fromiter(map(self.code.__getitem__, units), np.int64, len(units))

    def _add(self, units: list[str]) -> None:
        p = self.pieces
        own = p.between.join(units)
        raw = np.frombuffer(own.replace(" ", SPACE).encode(), np.uint8)
        # a literal sign matches no piece
        matched = np.frombuffer(own.replace(SPACE, p.other).replace(" ", SPACE).encode(), np.uint8) if SPACE in own else raw
        char_at = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # byte place of each character
        chars = np.fromiter(map(len, units), np.int64, len(units))
        first_char = np.cumsum(chars + 1) - (chars + 1)
        begin = char_at[first_char]  # node 0 of each unit; node = byte place
        lengths = char_at[first_char + chars] - begin

        inside = np.ones(len(char_at) - 1, bool)
        inside[first_char[1:] - 1] = False  # the marks between units
        place = char_at[:-1][inside]
        width = np.diff(char_at)[inside]
        found = p.trie.matches(matched, place)
        # characters that no piece writes alone go as bytes
        wide = np.zeros(len(raw) + 1, np.int64)
        wide[place] = width
        lone = np.zeros(len(raw) + 1, bool)
        lone[place] = True
        for a, b, _ in found[:4]:
            lone[a[b - a == wide[a]]] = False
        at = np.flatnonzero(lone)
        at = T.spread(at, wide[at])
        found = [(at, at + 1, p.byte_id[raw[at]]), *found][::-1]  # long pieces first
        start, end, ids = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(end, kind="stable")
        start, end, ids = start[order], end[order], ids[order]

        # forward filtering, one place of all units after the other
        unit_at = np.repeat(begin, np.diff(np.append(begin, len(raw) + 1)))
        depth = end - unit_at[start]
        order = np.argsort(depth.astype(np.uint16) if lengths.max() < 1 << 16 else depth, kind="stable")
        from_, to = start[order], end[order]
        weight = p.log_weight[ids[order]]
        alpha = np.full(len(raw) + 2, -np.inf)
        alpha[begin] = 0.0
        cuts = np.concatenate([[0], np.cumsum(np.bincount(depth))])
        sorted_share = np.zeros(len(start))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if a == b:
                continue
            value = alpha[from_[a:b]] + weight[a:b]
            node = to[a:b]
            head = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            size = np.diff(np.append(head, b - a))
            top = np.maximum.reduceat(value, head)
            safe = np.where(np.isfinite(top), top, 0.0)
            part = np.exp(value - np.repeat(safe, size))
            total = np.add.reduceat(part, head)
            with np.errstate(divide="ignore", invalid="ignore"):
                alpha[node[head]] = safe + np.log(total)
                sorted_share[a:b] = np.where(np.repeat(total, size) > 0, part / np.repeat(total, size), 0.0)
        share = np.empty(len(start))
        share[order] = sorted_share
        # a node's edges with their cumulated probability
        nodes = len(raw) + 1
        count = np.bincount(end, minlength=nodes)
        first = np.cumsum(count) - count
        for k in range(1, int(count.max(initial=0))):
            at = first[count > k] + k
            share[at] += share[at - 1]
        bound = np.minimum(np.rint(share * 2**_BITS), 2**_BITS - 1).astype(np.uint32)
        has = np.flatnonzero(count)
        bound[first[has] + count[has] - 1] = 2**_BITS - 1

        node0, edge0 = len(self.first_edge), len(self.piece)
        for i, u in enumerate(units):
            self.code[u] = len(self.first_node) + i
        grown = lambda kept, new: np.concatenate([kept, new.astype(kept.dtype)])
        self.first_node = grown(self.first_node, node0 + begin)
        self.last_node = grown(self.last_node, node0 + begin + lengths)
        self.first_edge = grown(self.first_edge, edge0 + first)
        self.bound = grown(self.bound, bound)
        self.piece = grown(self.piece, ids)
        self.length = grown(self.length, end - start)

    def sample(self, units: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One drawn segmentation per unit (``keys``: its 64-bit key): all piece ids in order, and each unit's count."""
        code = self.codes(units)
        base, node = self.first_node[code], self.last_node[code]
        live = np.flatnonzero(node > base)
        node, base, key = node[live], base[live], keys[live]
        at, got, counts = [], [], np.zeros(len(units), np.int64)
        while len(live):
            with np.errstate(over="ignore"):
                draw = T.mix(key + (node - base).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            draw = (draw >> np.uint64(32)).astype(np.uint32)
            edge = self.first_edge[node]
            late = np.flatnonzero(draw > self.bound[edge])
            while len(late):
                edge[late] += 1
                late = late[draw[late] > self.bound[edge[late]]]
            at.append(live)
            got.append(self.piece[edge])
            counts[live] += 1
            node = node - self.length[edge]
            more = node > base
            if not more.all():
                live, node, base, key = live[more], node[more], base[more], key[more]
        end = np.cumsum(counts)
        ids = np.zeros(int(end[-1]) if len(end) else 0, np.int32)
        for step, (where, piece) in enumerate(zip(at, got, strict=True)):
            ids[end[where] - 1 - step] = piece  # drawn from the end
        return ids, counts


@lru_cache(maxsize=2)
def _lattices(model: bytes, alpha: float) -> Lattices:
    return Lattices(Pieces(model, alpha))


def sample_texts(lattices: Lattices, texts: list[str], keys: np.ndarray) -> list[np.ndarray]:
    """Drawn piece ids of every text (``keys``: its 64-bit row key); an empty text has none."""
    units, n = [], np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        if t:
            own = _UNIT.findall(" " + t)
            n[i] = len(own)
            units += own
    number = T.spread(np.zeros(len(texts), np.int64), n).astype(np.uint64)
    with np.errstate(over="ignore"):
        unit_keys = T.mix(np.repeat(keys, n) + number * np.uint64(0xD1342543DE82EF95))
    ids, counts = lattices.sample(units, unit_keys)
    total = np.concatenate([[0], np.cumsum(counts)])
    edge = total[np.concatenate([[0], np.cumsum(n)])]
    return [ids[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]


def _model_bytes(df: DataFrame, model_path: str | None):
    with open(model_path or default_model(), "rb") as f:
        model = f.read(MAX_MODEL_BYTES + 1)
    if len(model) > MAX_MODEL_BYTES:
        raise ValueError(f"the model is larger than {MAX_MODEL_BYTES} bytes; it is broadcast")
    return df.sparkSession.sparkContext.broadcast(model)


def encode(
    docs: DataFrame,
    seed: int = 0,
    alpha: float = 1.0,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    model_path: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (a drawn segmentation), n_pieces, lossless (whether they decode to the text).

    The row key is the id; a null id is a key of its own, and repeated rows draw the same segmentation. Null and empty texts have no
    pieces. An empty table gives no rows; other columns are not read.
    """
    model = _model_bytes(docs, model_path)
    types = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("n_pieces", pa.int64()), ("lossless", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = _lattices(model.value, alpha)
        for batch in batches:
            own = batch.column(2).to_numpy().view(np.uint64)
            keys = T.mix(own ^ T.stream(seed, 1))
            for chunk in T.chunks(batch.column(1)):
                data, edge = chunk.buf.tobytes(), chunk.offsets.tolist()
                raw = [data[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]
                ids = sample_texts(lattices, [b.decode() for b in raw], keys[chunk.first : chunk.first + chunk.n])
                n = np.array([len(x) for x in ids], np.int64)
                offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, chunk.n),
                        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids))),
                        pa.array(n),
                        pa.array([lattices.pieces.decode(x) == b for x, b in zip(ids, raw, strict=True)]),
                    ],
                    schema=types,
                )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.xxhash64(F.col(id_col)).alias("row_key"),
    )
    return bounded_batches(rows).mapInArrow(run, "doc_id long, ids array<int>, n_pieces long, lossless boolean")


def decode(encoded: DataFrame, *, ids_col: str = "ids", out_col: str = "text", model_path: str | None = None) -> DataFrame:
    """``encoded`` with ``out_col``: the text of its piece ids (null or no ids: the empty text). A column of that name is replaced."""
    model = _model_bytes(encoded, model_path)

    @F.pandas_udf("string")
    def text_of(ids):
        pieces = _lattices(model.value, 1.0).pieces
        return ids.map(lambda x: "" if x is None else pieces.decode(np.asarray(x, np.int64)).decode("utf-8", "replace"))

    return bounded_batches(encoded).withColumn(out_col, text_of(F.col(ids_col)))
