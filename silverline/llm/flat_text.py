"""Flat numpy view of a batch of texts.

The operators of this package work on whole Arrow batches: the UTF-8 bytes of
all texts in one array, the words as (start, end) offsets into it, and every
span (word, prefix, n-gram) as a 64-bit hash computed by prefix sums. No Python
object is made per word.

Case folding is ASCII only (A-Z), so byte positions never move. Word classes
are byte tables: a class that treats every byte >= 0x80 as a word byte is exact
on UTF-8, since non-ASCII characters consist of such bytes only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes worked on at once; a text longer than this is a block of its own.
BLOCK_BYTES = 2 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def byte_class(*outside: tuple[int, int]) -> np.ndarray:
    """True for the bytes of a word: all but the given closed ranges."""
    table = np.ones(256, dtype=bool)
    for low, high in outside:
        table[low:high + 1] = False
    return table


# [^\x20\x09-\x0D]+ and [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (after lower-casing)
NOT_SPACE = byte_class((0x20, 0x20), (0x09, 0x0D))
ALNUM_LOWER = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LETTERS_LOWER = byte_class((0x00, 0x60), (0x7B, 0x7F))

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) <= n:
        size = max(n + 1, BLOCK_BYTES + 1)
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[key] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def lower(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lower-cased."""
    return _LOWER[data]


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values (murmur3 constants)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def flatten(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) in pieces of about `limit` bytes."""
    data, offsets = flatten(column)
    n, low = len(offsets) - 1, 0
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high, data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
        low = high


@dataclass
class Words:
    """Words of a block: byte offsets, document of each, first word of each document."""

    data: np.ndarray      # bytes, lower-cased where asked
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray     # n_docs + 1

    @property
    def per_doc(self) -> np.ndarray:
        return np.diff(self.first)


def words_of(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray, lower: bool = True) -> Words:
    if lower:
        data = _LOWER[data]
    n_docs = len(offsets) - 1
    inside = word_bytes[data]
    edge = np.empty(len(inside) + 1, bool)          # edge[i]: a document starts at byte i, or the data end
    edge[:] = False
    edge[offsets] = True
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    return Words(data, start, end, doc, first)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    up, _ = _grown(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end)."""
    _, down = _grown(len(sums))
    h = (sums[end] - sums[start]) * down[start]
    h ^= (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix64(h)


def word_hashes(w: Words) -> np.ndarray:
    return span_hash(prefix_sums(w.data), w.start, w.end)


def hash_words(words: list[bytes]) -> np.ndarray:
    """The same hashes for separate words."""
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(x) for x in words], dtype=np.int64) if words else np.zeros(0, np.int64)
    return span_hash(prefix_sums(data), np.concatenate([[0], ends[:-1]]).astype(np.int64) if words else ends, ends)


_odd_rng = np.random.default_rng(20240607)
_ODD = _odd_rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def window_hash(h: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of `size` consecutive word hashes beginning at each index of `at`."""
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        out += h[at + k] * _ODD[k % 64] + np.uint64(k // 64)
    return mix64(out)


def window_starts(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of words at which a window of `size` words of one document begins, and their documents."""
    count = np.maximum(np.diff(first) - size + 1, 0)
    doc = np.repeat(np.arange(len(count)), count)
    skip = np.concatenate([[0], np.cumsum(count)[:-1]]) if len(count) else np.zeros(0, np.int64)
    at = np.arange(int(count.sum())) - np.repeat(skip, count) + np.repeat(first[:-1], count)
    return at, doc
