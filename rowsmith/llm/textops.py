"""Word spans and word hashes of Arrow text columns, vectorised over a chunk's bytes.

A chunk is some whole texts of one Arrow batch, at most ``CHUNK_BYTES`` together unless one
text alone is longer, so memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

U64 = np.uint64


def _lut(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for lo, hi in ranges:
        out[lo : hi + 1] = True
    return out


#: Bytes of the words ``[^\x20\x09-\x0D]+``.
NOT_SPACE = ~_lut((0x20, 0x20), (0x09, 0x0D))
#: Bytes of the words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
ALNUM = _lut((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


@dataclass
class Chunk:
    """Texts ``first .. first + n - 1`` of a batch: their bytes and each one's byte range."""

    first: int
    n: int
    buf: np.ndarray  # uint8
    offsets: np.ndarray  # int64, n + 1, into buf


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The chunks of a string array; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if len(texts) == 0:
        return
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i, n = 0, len(texts)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, n)
        yield Chunk(i, j - i, whole[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j


def word_spans(buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words, and each text's range of words (n + 1 numbers).

    A word never runs over a text's end.
    """
    mask = is_word[buf]
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inner = offsets[(offsets > 0) & (offsets < len(mask))]
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    first[inner] = mask[inner]
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    last[inner - 1] = mask[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser, elementwise."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` numbers of splitmix64 from ``seed``."""
    with np.errstate(over="ignore"):
        return mix(U64(seed) + np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))


_BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(size, base, U64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = CHUNK_BYTES + 2
    while size < n:
        size *= 2
    return _powers(size)


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[s:e]`` for every range: equal sequences hash equal wherever they lie."""
    up, down = powers(len(values) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(values) + 1, U64)
        np.cumsum(values * up[: len(values)], out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64))


_BYTES = stream(0x5EED, 256)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word."""
    return range_hashes(_BYTES[buf], starts, ends)


def sliding_windows(word_ranges: np.ndarray, n_words: int, size: int) -> np.ndarray:
    """Starts of all runs of ``size`` words that lie in one text."""
    if n_words < size:
        return np.zeros(0, np.int64)
    room = np.repeat(word_ranges[1:], np.diff(word_ranges))  # the end of each word's text
    at = np.arange(n_words)
    return at[at + size <= room]


def spread(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, ..`` (``counts[i]`` numbers) for all i, one after the other."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts, counts) + np.repeat(first, counts)


#: For each byte value: its bits as the bytes of a word, so that adding words counts eight bits at once.
_LANES = ((np.arange(256, dtype=U64)[:, None] >> np.arange(8, dtype=U64) & U64(1)) << (U64(8) * np.arange(8, dtype=U64))).sum(
    axis=1, dtype=U64
)


#: Ranges of up to so many hashes are counted in bit planes.
_IN_PLANES = 64


def majority_bits(hashes: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """Per range of hashes: the word of the bits set in over half of them (an empty range: 0)."""
    counts = np.diff(ranges)
    out = np.zeros(len(counts), U64)
    small = np.flatnonzero((counts > 0) & (counts <= _IN_PLANES))
    if len(small):
        small = small[np.argsort(-counts[small], kind="stable")]
        out[small] = _majority_in_planes(hashes, ranges[small], counts[small])
    large = np.flatnonzero(counts > _IN_PLANES)
    if len(large):
        own = hashes[spread(ranges[large], counts[large])]
        out[large] = _majority_by_lanes(own, np.concatenate([[0], np.cumsum(counts[large])]))
    return out


def _majority_in_planes(hashes: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``majority_bits`` of ranges in descending order of their sizes: plane p holds bit p of the counts of all 64 bits."""
    planes: list[np.ndarray] = []
    going = np.searchsorted(-counts, -np.arange(counts[0]), "left")  # ranges with more hashes than that
    for i, n in enumerate(going.tolist()):
        carry = hashes[first[:n] + i]
        for p in range((i + 1).bit_length()):
            if p == len(planes):
                planes.append(np.zeros(len(counts), U64))
            plane = planes[p][:n]
            both = plane & carry
            plane ^= carry
            carry = both
    # counts of more than half, from the highest plane down
    half = (counts // 2).astype(U64)
    more, equal = np.zeros(len(counts), U64), np.full(len(counts), ~U64(0))
    for p in range(len(planes) - 1, -1, -1):
        bit = U64(0) - (half >> U64(p) & U64(1))
        more |= equal & planes[p] & ~bit
        equal &= ~(planes[p] ^ bit)
    return more


def _majority_by_lanes(hashes: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """``majority_bits`` of ranges of any size, none empty."""
    counts = np.diff(ranges)
    out = np.zeros(len(counts), U64)
    full = np.arange(len(counts))
    # pieces of at most 255 hashes, so that a count fits a byte
    pieces = -(-counts[full] // 255)
    first = spread(np.zeros(len(full), np.int64), pieces) * 255 + np.repeat(ranges[:-1][full], pieces)
    end = np.append(first[1:], ranges[-1])
    sums = np.empty((len(first), 64), np.uint8)
    a = 0
    while a < len(first):
        b = max(a + 1, int(np.searchsorted(end, first[a] + (1 << 16), "right")))
        lanes = _LANES[hashes[first[a] : end[b - 1]].view(np.uint8).reshape(-1, 8)]
        sums[a:b] = np.add.reduceat(lanes, first[a:b] - first[a], axis=0).view(np.uint8).reshape(-1, 64)
        a = b
    if len(first) > len(full):
        sums = np.add.reduceat(sums, np.cumsum(pieces) - pieces, axis=0, dtype=np.int64)
    weights = U64(1) << np.arange(64, dtype=U64)
    out[full] = np.where(2 * sums.astype(np.int64) > counts[full][:, None], weights, U64(0)).sum(axis=1, dtype=U64)
    return out
