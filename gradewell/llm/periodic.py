"""Periodic runs of words: an enhanced suffix array and the branching-tandem test.

The texts of an Arrow batch become one sequence of numbers. A word's number is the place
where its document has it first, and every document ends in a number of its own, so
equality is exact and nothing matches across documents. Prefix doubling sorts the
suffixes and keeps the ranks by the first 1, 2, 4, ... words, from which the longest
common prefixes (LCP) of neighbours follow.

One pass over the LCP array lists the LCP intervals: all suffixes that share a prefix of
``depth`` words. No tree is built. For each interval, the suffixes outside its largest
child are looked up at i + depth and i - depth in the inverse suffix array (ISA): if
that place lies in the interval too, a square of period ``depth`` stands there, and if
its two halves go on differently it is the last square of its run. Taking the smaller
children makes that n log n look-ups. Such a square is rotated to the left while the
words one period apart agree; squares of one end whose periods are multiples
merge into the run of the least period.

Every row gives one row, in its order of input; documents never leave their task, which
holds one batch or one longer text at a time. Null and empty texts have no words and no
runs. Repeated rows and null ids stay as they are, and extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gradewell.llm.text import small_batches

LEAST_LENGTH, LEAST_REPEATS = 24, 3
BATCH_BYTES, LOOK_UPS = 1 << 21, 1 << 20
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array, its inverse, and the LCP of each suffix with the one before it.

    ``symbols`` are numbers below their count; the last one stands nowhere else.
    """
    n = len(symbols)
    count = np.bincount(symbols, minlength=n)
    rank = (np.cumsum(count) - count)[symbols]
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    lcp = np.zeros(n, np.int64)
    levels: list[np.ndarray] = []
    some, length = np.flatnonzero(count[symbols] > 1), 1
    while len(some):
        levels.append(rank.astype(np.int32 if n < 2**31 else np.int64))
        key = rank[some] * n + rank[some + length]
        by_key = np.argsort(key)
        some, key = some[by_key], key[by_key]
        group = rank[some]
        at = np.arange(len(some))
        group_head = np.ones(len(some), bool)
        group_head[1:] = group[1:] != group[:-1]
        slot = group + at - np.maximum.accumulate(np.where(group_head, at, 0))
        order[slot] = some
        head = np.ones(len(some), bool)
        head[1:] = key[1:] != key[:-1]
        # Neighbours that part in this round agree in ``length`` words and go on for less than that.
        parted = np.flatnonzero(head & ~group_head)
        i, j = some[parted - 1] + length, some[parted] + length
        shared = np.full(len(parted), length)
        for k in range(len(levels) - 2, -1, -1):
            step = (levels[k][i] == levels[k][j]) * (1 << k)
            i, j, shared = i + step, j + step, shared + step
        lcp[slot[parted]] = shared
        made = slot[np.maximum.accumulate(np.where(head, at, 0))]
        rank[some] = made
        alone = head & np.append(head[1:], True)
        some, length = some[~alone], 2 * length
    return order, rank, lcp


def lcp_intervals(lcp: np.ndarray) -> np.ndarray:
    """Rows (depth, first, last, first of the largest child, its size) of all intervals of depth 1 or more."""
    made: list[tuple[int, int, int, int, int]] = []
    stack: list[list[int]] = []  # depth, first, largest child, its size
    places = np.flatnonzero(lcp)

    def close(least: int, last: int) -> tuple[int, int]:
        """End the intervals deeper than ``least``; the child that is left for the one around them."""
        child, size = last, 1
        while stack and stack[-1][0] > least:
            depth, first, largest, most = stack.pop()
            if size > most:
                largest, most = child, size
            made.append((depth, first, last, largest, most))
            child, size = first, last - first + 1
        return child, size

    before = -1
    for p, depth in zip(places.tolist(), lcp[places].tolist(), strict=True):
        if p != before + 1:
            close(0, before)
        child, size = close(depth, p - 1)
        if stack and stack[-1][0] == depth:
            if size > stack[-1][3]:
                stack[-1][2:] = child, size
        else:
            stack.append([depth, child, child, size])
        before = p
    close(0, before)
    return np.array(made, np.int64).reshape(-1, 5)


def last_squares(symbols: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods, ``longest`` at most, of all squares that do not go on to the right."""
    order, rank, lcp = suffix_array(symbols)
    found = lcp_intervals(lcp)
    found = found[found[:, 0] <= longest]
    looked = found[:, 2] - found[:, 1] + 1 - found[:, 4]
    ends = np.cumsum(looked)
    starts, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    a = 0
    while a < len(found):
        b = max(int(np.searchsorted(ends, (ends[a - 1] if a else 0) + LOOK_UPS, "right")), a + 1)
        each = np.repeat(np.arange(a, b), looked[a:b])
        nth = np.arange(len(each)) - np.repeat(ends[a:b] - looked[a:b] - (ends[a - 1] if a else 0), looked[a:b])
        depth, first, last, child, size = found[each].T
        place = first + nth
        place += (place >= child) * size
        i = order[place]
        for step, start in ((depth, i), (-depth, i - depth)):
            j = i + step
            inside = (j >= 0) & (j < len(symbols))
            other = rank[np.where(inside, j, 0)]
            inside &= (other >= first) & (other <= last)
            s, d = start[inside], depth[inside]
            ends_here = symbols[s + d] != symbols[s + 2 * d]
            starts.append(s[ends_here])
            periods.append(d[ends_here])
        a = b
    pairs = np.unique(np.stack((np.concatenate(starts), np.concatenate(periods)), 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def rotate(symbols: np.ndarray, start: int, period: int) -> int:
    """Where the run begins whose last square starts at ``start``."""
    step = 64
    while start:
        a = max(start - step, 0)
        differ = np.flatnonzero(symbols[a:start] != symbols[a + period : start + period])
        if len(differ):
            return a + int(differ[-1]) + 1
        start, step = a, min(2 * step, 1 << 16)
    return start


def runs_of(symbols: np.ndarray, longest: int, least: int, repeats: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs of at least ``least`` words and ``repeats`` periods."""
    start, period = last_squares(symbols, longest // repeats)
    back = np.maximum(least, repeats * period) - 2 * period
    # A run long enough has equal words one period apart at every step back; look at few of them first.
    probe = 1
    while len(start) and probe <= back.max():
        there = start - np.clip(back, 0, probe)
        inside = np.maximum(there, 0)
        keep = (there == start) | ((there >= 0) & (symbols[inside] == symbols[inside + period]))
        start, period, back = start[keep], period[keep], back[keep]
        probe *= 2
    out: list[tuple[int, int, int]] = []
    by_end: dict[int, list[tuple[int, int]]] = {}
    for p, s in sorted(zip(period.tolist(), start.tolist(), strict=True)):
        end = s + 2 * p
        known = by_end.setdefault(end, [])
        if any(p % q == 0 and s >= first for first, q in known):
            continue
        first = rotate(symbols, s, p)
        if end - first >= max(least, repeats * p):
            known.append((first, p))
            out.append((first, end, p))
    return out


def find_runs(texts: list[bytes], least: int = LEAST_LENGTH, repeats: int = LEAST_REPEATS) -> tuple[list[list[bytes]], list[list[tuple[int, int, int]]]]:
    """Words of each text, and its runs (start, length, period) by start, then period."""
    split = [t.split() for t in texts]
    runs: list[list[tuple[int, int, int]]] = [[] for _ in split]
    parts, owners, bases, base = [], [], [], 0
    for d, words in enumerate(split):
        if len(words) < least:
            continue  # shorter than any run
        first: dict[bytes, int] = {}
        parts.append(np.fromiter(map(first.setdefault, words, range(base, base + len(words))), np.int64, len(words)))
        parts.append(np.array([base + len(words)]))
        owners.append(d)
        bases.append(base)
        base += len(words) + 1
    if owners:
        starts = np.array(bases)
        for s, e, p in runs_of(np.concatenate(parts), max(len(split[d]) for d in owners), least, repeats):
            k = int(np.searchsorted(starts, s, "right")) - 1
            runs[owners[k]].append((s - bases[k], e - s, p))
    for found in runs:
        found.sort(key=lambda r: (r[0], r[2]))
    return split, runs


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words), bool)
    for start, length, period in runs:
        gone[start + period : start + length] = True
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def periodic_runs(docs: DataFrame, least: int = LEAST_LENGTH, repeats: int = LEAST_REPEATS) -> DataFrame:
    """doc_id, n_words, runs and the collapsed text of every row.

    A run is a stretch of words with smallest period q, of at least ``least`` words and
    ``repeats`` (2 or more) periods, that no neighbouring word extends. ``collapsed``
    keeps each run's first period only, its words joined by one space.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
        for batch in small_batches(batches, most=BATCH_BYTES):
            texts = batch.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
            split, runs = find_runs(texts, least, repeats)
            left = [b" ".join(collapse(w, r)) for w, r in zip(split, runs, strict=True)]
            listed = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in found] for found in runs]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(w) for w in split], pa.int64()), pa.array(listed, kind), pa.array(left, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(read, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")
