"""Words of whole Arrow text batches as numpy arrays, and their 64-bit hashes.

Texts stay UTF-8 bytes: white space is one byte there, so words are found by
comparing neighbours. A null text is an empty one. Hashes are polynomials over
a fixed random table modulo 2^64, mixed at the end; they depend on the word
alone, not on the batch.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

U = np.uint64
_random = np.random.Generator(np.random.PCG64(20260101))
TABLE = _random.integers(1, 2**63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
BASE = int(_random.integers(1, 2**62)) * 2 + 1
BASE_INVERSE = pow(BASE, -1, 2**64)
SLICE = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), U(base % 2**64), dtype=U)
    out[0] = 1
    return np.cumprod(out, dtype=U)[:n]


_POWERS = (powers(BASE, SLICE + 1), powers(BASE_INVERSE, SLICE + 1))


class Words:
    """``starts`` and ``ends`` are byte places; document d has words first[d]..first[d + 1]."""

    def __init__(self, texts: pa.Array):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = texts.cast(pa.large_string()).fill_null("")
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.bytes = raw[at[0] : at[-1]]
        self.offsets = at - at[0]
        b = self.bytes
        inside = (b != 32) & ((b < 9) | (b > 13))
        edge = np.zeros(len(b) + 1, bool)
        edge[self.offsets] = True
        before = np.concatenate(([False], inside[:-1])) & ~edge[:-1]
        after = np.concatenate((inside[1:], [False])) & ~edge[1:]
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, self.offsets)

    def hashes(self) -> np.ndarray:
        out = np.empty(len(self.starts), U)
        i = 0
        while i < len(out):
            j = max(int(np.searchsorted(self.ends, self.starts[i] + SLICE, "right")), i + 1)
            low, high = int(self.starts[i]), int(self.ends[j - 1])
            n = high - low
            up, down = _POWERS if n <= SLICE else (powers(BASE, n), powers(BASE_INVERSE, n))
            sums = np.concatenate((np.zeros(1, U), np.cumsum(TABLE[self.bytes[low:high]] * up[:n], dtype=U)))
            s, e = self.starts[i:j] - low, self.ends[i:j] - low
            out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U))
            i = j
        return out

    def documents(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def between(self, i: int, j: int) -> bytes:
        """Words i to j (exclusive) joined by one space."""
        b, s, e = self.bytes, self.starts, self.ends
        return b" ".join(b[s[k] : e[k]].tobytes() for k in range(i, j))


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` neighbours in a flat array, also across documents."""
    n = max(len(hashes) - k + 1, 0)
    out = np.zeros(n, U)
    for j in range(k):
        out = out * U(0x9E3779B97F4A7C15) + hashes[j : j + n]
    return mix(out)


def small_batches(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pa.compute.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
        cuts = [0]
        total = 0
        for i, size in enumerate(sizes):
            if total and total + size > most:
                cuts.append(i)
                total = 0
            total += int(size)
        for a, b in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def give_back() -> None:
    """Return what a finished task has freed, so that a reused worker starts its next one small."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def light_batches(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """``small_batches`` of at most 2 MB for work with many arrays per byte; memory is given back after the last."""
    yield from small_batches(batches, column, 1 << 21)
    give_back()
