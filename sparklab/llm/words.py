"""Vectorised words and shingles over Arrow text batches (runs inside tasks).

Texts stay the byte buffer Arrow delivers. A word is a maximal run of bytes
that a 256-entry table marks; every word gets a 64-bit hash, and sequences of
k words get one by doubling, so the cost is a few numpy passes per word.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# fixed values of the contracts: what separates words
SEPARATORS = (0x20, *range(0x09, 0x0E))

#: words are runs of anything but separators
PLAIN = np.ones(256, dtype=bool)
PLAIN[list(SEPARATORS)] = False
#: words are runs of letters, digits and non-ASCII characters
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_S29, _S32 = np.uint64(29), np.uint64(32)
_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S32)) * _M2
    return (x ^ (x >> _S29)) * _M1


def join_hash(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    return mix(mix(x) + y)


class Words:
    """The words of texts ``i..j`` of one batch."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool):
        lo, hi = int(offsets[0]), int(offsets[-1])
        self.bytes = np.zeros(hi - lo + 8, dtype=np.uint8)
        self.bytes[:-8] = LOWER[buf[lo:hi]] if lower else buf[lo:hi]
        #: byte where each text starts, and the end
        self.text_start = bounds = offsets - lo
        inside = table[self.bytes[:-8]]
        prev = np.zeros(len(inside) + 1, dtype=bool)
        prev[1:] = inside
        prev[bounds] = False  # a text starts a word anew
        self.start = np.flatnonzero(inside & ~prev[:-1])
        after = np.zeros(len(inside) + 1, dtype=bool)
        after[:-1] = inside
        after[bounds] = False
        self.end = np.flatnonzero(inside & ~after[1:]) + 1
        #: index of the first word of each text, and the number of words at the end
        self.first = np.searchsorted(self.start, bounds)
        self.n = len(self.start)

    def of(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def left(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(self.first[1:], np.diff(self.first)) - np.arange(self.n)

    def hashes(self, seed: int = 0) -> np.ndarray:
        length = self.end - self.start
        v = np.ndarray((len(self.bytes) - 7,), "<u8", self.bytes, strides=(1,))
        h = mix(length.astype(np.uint64) + np.uint64((seed * 2 + 1) * int(_M1) % (1 << 64)))
        h = mix(h ^ (v[self.start] & _MASKS[np.minimum(length, 8)])) if self.n else h
        rest, at = np.flatnonzero(length > 8), 8
        while rest.size:
            if at >= 256 and rest.size <= 64:  # a few very long words
                for w in rest:
                    d = hashlib.blake2b(self.bytes[self.start[w] + at:self.end[w]].tobytes(), digest_size=8, salt=str(seed).encode()).digest()
                    h[w] = mix(h[w:w + 1] ^ np.frombuffer(d, "<u8"))[0]
                break
            h[rest] = mix(h[rest] ^ (v[self.start[rest] + at] & _MASKS[np.minimum(length[rest] - at, 8)]))
            at += 8
            rest = rest[length[rest] > at]
        return h


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` hashes, by doubling; empty if there are fewer."""
    if len(h) < k:
        return h[:0]
    size = 1
    while size * 2 <= k:
        h = join_hash(h[:-size], h[size:])
        size *= 2
    if size < k:
        h = join_hash(h[:size - k], h[k - size:])
    return h


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column; null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf, offsets


def pieces(column, table: np.ndarray = PLAIN, lower: bool = False, limit: int = 2 << 20):
    """Yield ``(i, j, Words)`` for runs of whole texts of about ``limit`` bytes."""
    buf, offsets = text_buffer(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, Words(buf, offsets[i:j + 1], table, lower)
        i = j


def signed(h: np.ndarray) -> np.ndarray:
    """As Spark's bigint."""
    return h.view(np.int64)
