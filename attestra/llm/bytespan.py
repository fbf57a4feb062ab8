"""Vectorised views of text columns: bytes, words and rolling hashes of whole Arrow batches.

All arithmetic is modulo 2**64.  A rolling hash is the sum of mixed symbols times
powers of an odd base, taken from a running sum and divided by the base's power
at the window's start, so equal windows have equal hashes wherever they stand.

Such sums have known colliding pairs from 1,024 symbols on, whatever the base, so words
are not named by them: a word's bytes are chained eight at a time through a
bijective mixer, once for each seed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash

U = np.uint64
BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
#: Bytes of text that are hashed at once; bounds a worker's memory.
PIECE_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: spreads entropy to all bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U(BASE_A))
WS = np.zeros(256, bool)
WS[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


class Powers:
    """Powers of an odd base and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inv = U(base), U(pow(base, -1, 1 << 64))
        self.n = 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, 2 * self.n, 1 << 16)
            one = np.ones(1, np.uint64)
            self.p = np.concatenate([one, np.cumprod(np.full(self.n, self.base))])
            self.q = np.concatenate([one, np.cumprod(np.full(self.n, self.inv))])
        return self.p[:n], self.q[:n]


_POW = {b: Powers(b) for b in (BASE_A, BASE_B)}


class Rolling:
    """Hashes of any span of a symbol sequence."""

    def __init__(self, symbols: np.ndarray, base: int = BASE_A):
        n = len(symbols)
        p, self.q = _POW[base].upto(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * p[:n], out=self.sums[1:])

    def spans(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.q[start]

    def windows(self, k: int) -> np.ndarray:
        """The hash of each window of k symbols, by start."""
        n = len(self.sums) - 1
        return (self.sums[k:] - self.sums[: n - k + 1]) * self.q[: n - k + 1] if n >= k else np.zeros(0, np.uint64)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(data, starts, ends): the UTF-8 bytes of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat, offsets[:-1], offsets[1:]


def pieces(starts: np.ndarray, ends: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of whole texts of about ``limit`` bytes; a longer text is a run of its own."""
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + limit, "right")))
        yield i, j
        i = j


#: Spans over so many bytes are hashed one by one.
LONG_SPAN = 256
_TAIL = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)  # masks of the first k bytes


def chained(data: np.ndarray, start: np.ndarray, stop: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each span [start, stop) of bytes: eight bytes a step, each step mixed into the next."""
    size = stop - start
    h = mix(size.astype(np.uint64) * U(BASE_A) ^ U(seed))
    if not len(size):
        return h
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, np.dtype("<u8"), padded, 0, (1,))  # at every byte, unaligned
    live = np.flatnonzero(size <= LONG_SPAN)
    at, left = start[live], size[live]
    while len(live):
        h[live] = mix(h[live] * U(BASE_B) ^ (eight[at] & _TAIL[np.minimum(left, 8)]))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > LONG_SPAN):
        h[i] = xxhash.xxh3_64_intdigest(data[start[i] : stop[i]].tobytes(), seed)
    return h


class Words:
    """The words of texts: hash, text number, and place.  ``gaps`` marks the bytes between words."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, gaps: np.ndarray = WS, fold: bool = False):
        lo, hi = int(starts[0]), int(ends[-1])
        self.bytes = LOWER[data[lo:hi]] if fold else data[lo:hi]
        s, e = starts - lo, ends - lo
        gap = gaps[self.bytes]
        begin = ~gap
        begin[1:] &= gap[:-1]
        stop = ~gap
        stop[:-1] &= gap[1:]
        live = s < e
        edge = s[live]
        begin[edge] = ~gap[edge]
        edge = e[live] - 1
        stop[edge] = ~gap[edge]
        self.start = np.flatnonzero(begin)
        self.stop = np.flatnonzero(stop) + 1
        self.first = np.searchsorted(self.start, s)  # of each text: its first word
        self.after = np.searchsorted(self.start, e)
        n = len(self.start)
        self.text = np.repeat(np.arange(len(s)), self.after - self.first) if n else np.zeros(0, np.int64)
        self.hash = chained(self.bytes, self.start, self.stop, BASE_B)

    @cached_property
    def second(self) -> np.ndarray:
        """Each word's hash by another seed."""
        return chained(self.bytes, self.start, self.stop, BASE_A)

    def fits(self, k: int) -> np.ndarray:
        """Of each word: whether a window of k words that starts there stays in its text."""
        return np.arange(len(self.start)) + k <= self.after[self.text] if len(self.start) else np.zeros(0, bool)


def byte_symbols(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


def cover(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n places lie in a window of ``width`` from one of ``starts``."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, starts, 1)
    np.add.at(d, np.minimum(starts + width, n), -1)
    return np.cumsum(d[:n]) > 0
