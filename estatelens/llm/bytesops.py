"""Vectorised work on UTF-8 bytes inside tasks (numpy over Arrow buffers).

A chunk of documents is one byte array with offsets; words and windows are
hashed by prefix sums, so nothing is done per word in Python.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space of ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
ITEM_WORD = np.zeros(256, bool)
ITEM_WORD[0x30:0x3A] = ITEM_WORD[0x61:0x7B] = ITEM_WORD[0x80:] = True
#: A-Z to a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

#: Text bytes worked on at a time; temporary arrays take some 100 times this.
CHUNK = 1 << 19


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK,
           order=None, rows: int = 1 << 30) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with at most ``limit`` text bytes (one longer
    document is a slice of its own) and ``rows`` rows: rows, bytes, offsets.
    ``order`` sorts the rows of a batch by that column first."""
    for batch in batches:
        if not batch.num_rows:
            continue
        if order:
            batch = batch.sort_by(order)
        i = batch.schema.get_field_index(text)
        arr = batch.column(i)
        if arr.null_count:
            arr = pc.fill_null(arr, "")
        width = np.int64 if pa.types.is_large_string(arr.type) else np.int32
        offsets = np.frombuffer(arr.buffers()[1], dtype=width)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
        raw = arr.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
        at = 0
        while at < len(arr):
            to = min(at + rows, len(arr), max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1))
            yield batch.slice(at, to - at), data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
            at = to


def give_back() -> None:
    """Free memory goes back to the machine when a task ends, because the
    Python worker lives on and waits beside the next stages' memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes with ``inside`` that stay in one document:
    starts, ends, and the index of each document's first run (with a last
    entry for the end)."""
    w = inside[data]
    first, last = w.copy(), w.copy()
    first[1:] &= ~w[:-1]
    last[:-1] &= ~w[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    first[edge] = w[edge]
    last[edge - 1] = w[edge - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads all bits (splitmix64 finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@cache
def _table(seed: int) -> np.ndarray:
    return mix(np.arange(256, dtype=np.uint64) + np.uint64(1 + 257 * seed))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept up to a few chunks' length."""
    have = _POWERS.get(base)
    if have is not None and len(have) >= n:
        return have[:n]
    size = max(n, CHUNK + 1)
    out = np.empty(size, np.uint64)
    out[0] = 1
    k, step = 1, base
    while k < size:
        m = min(k, size - k)
        np.multiply(out[:m], np.uint64(step), out=out[k:k + m])
        step = step * step % (1 << 64)
        k *= 2
    if size <= 4 * CHUNK:
        _POWERS[base] = out
    return out[:n]


class Rolling:
    """Hashes of any slices of a sequence of 64-bit values: h(i, j) depends
    on values[i:j] alone.  ``seed`` selects one of many odd bases."""

    def __init__(self, values: np.ndarray, seed: int = 0):
        base = int(mix(np.array([seed + 7], np.uint64))[0]) | 1
        n = len(values)
        self._back = _powers(pow(base, -1, 1 << 64), n + 1)
        self._sum = np.zeros(n + 1, np.uint64)
        np.cumsum(values * _powers(base, n + 1)[:n], out=self._sum[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sum[ends] - self._sum[starts]) * self._back[starts] + (ends - starts).astype(np.uint64))


def byte_values(data: np.ndarray, seed: int = 0) -> np.ndarray:
    return _table(seed)[data]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    return Rolling(byte_values(data, seed), seed)(starts, ends)


def runs(flags_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted positions as maximal runs of consecutive ones: first, last."""
    if not len(flags_at):
        return flags_at, flags_at
    brk = np.flatnonzero(np.diff(flags_at) != 1)
    return flags_at[np.concatenate([[0], brk + 1])], flags_at[np.concatenate([brk, [len(flags_at) - 1]])]


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Flags of 0..n-1 that lie in any [start, end)."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, ends, -1)
    return np.cumsum(d[:-1]) > 0


class Filter:
    """A Bloom filter of fixed size, ``bits`` a power of two, three probes."""

    def __init__(self, bits: int, words: np.ndarray | None = None):
        self.bits = bits
        self.words = np.zeros(bits // 64, np.uint64) if words is None else words

    @staticmethod
    def slots(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
        m = np.uint64(bits - 1)
        return [hashes & m, (hashes >> np.uint64(21)) & m, mix(hashes) & m]

    def add(self, hashes: np.ndarray) -> None:
        for s in self.slots(hashes, self.bits):
            np.bitwise_or.at(self.words, (s >> np.uint64(6)).astype(np.int64), np.uint64(1) << (s & np.uint64(63)))

    def __contains__(self, _):  # membership is asked for arrays only
        raise TypeError("use has(hashes)")

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for s in self.slots(hashes, self.bits):
            out &= (self.words[(s >> np.uint64(6)).astype(np.int64)] >> (s & np.uint64(63))) & np.uint64(1) != 0
        return out
