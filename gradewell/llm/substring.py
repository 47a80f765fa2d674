"""Substring dedup: matching statistics on FM-indexes of content-routed shards.

A window is ``WINDOW`` consecutive words. Equal windows hold equal ``GRAM``-word
hashes, so they share the smallest of them, their anchor. Runs of windows with
one anchor form a segment, and an anchor decides the shard: every copy of a
window is in one shard, and documents are compared with no shard in vain.

1. One row per segment: anchor, hash of its words, place. Anchors seen once
   hold nothing that repeats and end here.
2. Of equal segments all but the earliest are repeats as a whole. They are
   found by an aggregate, however many copies there are.
3. Anchors with several different segments go to the index. A shard holds each
   different segment once; its FM-index is a wavelet matrix over the
   Burrows-Wheeler transform with a bit per suffix that starts a new group of
   equal windows. Segments stream through it by backward search; a place whose
   group has an earlier member is reported.
4. An anchor with over ``HOT`` different segments is cut into single windows,
   which are keyed by their own words and so spread over all shards.

Order of places is (doc_id, start). Windows are judged on the input. Rows that
repeat a doc_id count as one document's text continued at equal starts; rows
without doc_id come last; null and short texts hold no window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradewell.llm.tables import pin, row_id, text_key
from gradewell.llm.text import U, Words, mix, powers, shingles, small_batches

WINDOW, GRAM, HOT = 20, 6, 20_000
LONGEST = 2_000
SHARD_WORDS = 1 << 20
SPREAD = 0x9E3779B97F4A7C15


def segments(words: Words, window: int, gram: int):
    """Document, anchor, content hash, first word (in its document), windows of each segment.

    Last, whether a segment holds its anchor twice and so may repeat itself.
    """
    hashes = words.hashes()
    n = len(hashes) - window + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    grams = shingles(hashes, gram)
    least = grams[:n].copy()
    for j in range(1, window - gram + 1):
        np.minimum(least, grams[j : j + n], out=least)
    twice = np.zeros(n + 1, np.int64)
    for j in range(window - gram + 1):
        twice[1:] += grams[j : j + n] == least
    twice = np.cumsum(twice > 1)
    document = words.documents()
    place = np.arange(n)
    whole = document[:n] == document[window - 1 : window - 1 + n]
    new = np.ones(n, bool)
    new[1:] = (least[1:] != least[:-1]) | ~whole[:-1] | (document[1:n] != document[: n - 1])
    heads = np.flatnonzero(new & whole)
    # A run ends at the next head or where windows stop fitting the document.
    last = words.first[document[heads] + 1] - window + 1
    stops = np.minimum(np.append(heads[1:], n), last)
    longest = np.ceil((stops - heads) / LONGEST).astype(np.int64)
    again = np.repeat(np.arange(len(heads)), longest)
    part = np.arange(len(again)) - np.repeat(np.cumsum(longest) - longest, longest)
    starts = heads[again] + part * LONGEST
    counts = np.minimum(stops[again] - starts, LONGEST)
    # Sum of word hashes times powers, brought back to power 0.
    up, down = powers(SPREAD, len(hashes)), powers(pow(SPREAD, -1, 2**64), len(hashes))
    sums = np.concatenate((np.zeros(1, U), np.cumsum(hashes * up, dtype=U)))
    content = mix((sums[starts + counts + window - 1] - sums[starts]) * down[starts] + counts.astype(U))
    own = (twice[starts + counts] > twice[starts]) | (counts > window - gram + 1)
    return document[starts], least[starts].astype(np.int64), content.astype(np.int64), place[starts] - words.first[document[starts]], counts, own


ANCHORS = "id long, key long, anchor long, content long, start int, n int, own boolean"


def find_segments(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches):
        document, anchor, content, start, n, own = segments(Words(batch.column("text")), window, gram)
        ids, keys = (np.asarray(batch.column(c)) for c in ("id", "key"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (ids[document], keys[document], anchor, content, start.astype(np.int32), n.astype(np.int32), own.astype(bool))],
            ["id", "key", "anchor", "content", "start", "n", "own"],
        )


CUTS = "shard long, words string, id long, key long, start int, n int"


def cut_segments(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The words of the wanted segments; those of hot anchors window by window."""
    for batch in small_batches(batches):
        words = Words(batch.column("text"))
        rows: list[tuple] = []
        for d, (i, key, wanted) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("id", "key", "wanted")), strict=True)):
            base = int(words.first[d])
            for s in wanted:
                at, n = base + s["start"], s["n"]
                if s["hot"]:
                    for j in range(n):
                        text = words.between(at + j, at + j + window)
                        shard = int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)
                        rows.append((shard, text.decode(), i, key, s["start"] + j, 1))
                else:
                    rows.append((s["anchor"], words.between(at, at + n + window - 1).decode(), i, key, s["start"], n))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)],
                ["shard", "words", "id", "key", "start", "n"],
            )


class Bits:
    """A bit vector of 64-bit words with a count before each word."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        padded = np.zeros((self.n // 64 + 1) * 64, bool)
        padded[: self.n] = bits
        self.packed = np.packbits(padded, bitorder="little").view(U)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.packed), dtype=np.int64)))

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Number of set bits before each place."""
        w = i >> 6
        part = self.packed[w] & ((U(1) << (i & 63).astype(U)) - U(1))
        return self.before[w] + np.bitwise_count(part)


class FMIndex:
    """Backward search over a text of symbols; suffixes are sorted by their first ``depth`` symbols or more.

    The text is segments, each followed by the separator 0.
    """

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        rank = text.astype(np.int64)
        width = 1
        while width < depth:
            shifted = np.zeros(n, np.int64)
            shifted[: n - width] = rank[width:] + 1
            both = rank * (n + 2) + shifted
            order = np.argsort(both, kind="stable")
            ordered = both[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
            width *= 2
        self.suffixes = np.argsort(rank, kind="stable")
        # Groups of suffixes equal in their first ``depth`` symbols.
        same = np.ones(n, bool)
        same[0] = False
        a, b = self.suffixes[1:], self.suffixes[:-1]
        for j in range(depth):
            x, y = np.minimum(a + j, n - 1), np.minimum(b + j, n - 1)
            same[1:] &= text[x] == text[y]
        self.group = Bits(~same)
        self.group_starts = np.append(np.flatnonzero(~same), n)
        symbols = text[self.suffixes - 1]
        top = int(text.max(initial=0))
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1))))
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in range(max(top.bit_length(), 1) - 1, -1, -1):
            bit = (symbols >> shift) & 1 == 1
            self.levels.append((shift, Bits(bit), int(len(bit) - bit.sum())))
            symbols = np.concatenate((symbols[~bit], symbols[bit]))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in the transform before place i."""
        start = np.zeros_like(i)
        for shift, bits, zeros in self.levels:
            one = (symbol >> shift) & 1 == 1
            a, b = bits.ones(start), bits.ones(i)
            start = np.where(one, zeros + a, start - a)
            i = np.where(one, zeros + b, i - b)
        return i - start

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Intervals of the patterns with a symbol put before them."""
        less = self.less[symbol]
        return less + self.rank(symbol, low), less + self.rank(symbol, high)

    def widen(self, low: np.ndarray):
        """Interval of all suffixes that share the first ``depth`` symbols, and its number."""
        g = self.group.ones(low + 1) - 1
        return self.group_starts[g], self.group_starts[g + 1], g


def repeats(texts: list[np.ndarray], order: np.ndarray, window: int) -> list[np.ndarray]:
    """For each segment, whether each of its windows has an earlier place.

    ``order`` numbers the segments' first words in (doc_id, start) order with
    room for the windows after them.
    """
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes + 1) - 1
    text = np.zeros(ends[-1] + 1, np.int64)
    heads = ends - sizes
    inside = np.ones(len(text), bool)
    inside[ends] = False
    text[inside] = np.concatenate(texts)
    index = FMIndex(text, window)
    place = np.full(len(text), np.iinfo(np.int64).max)
    place[inside] = np.repeat(order - heads, sizes) + np.flatnonzero(inside)
    earliest = np.minimum.reduceat(place[index.suffixes], index.group_starts[:-1])
    # All segments go backwards in step; those with words left stay.
    found = np.zeros(len(text), bool)
    live = np.arange(len(texts))
    low, high = np.zeros(len(texts), np.int64), np.full(len(texts), len(text))
    length = 0
    while len(live):
        length += 1
        at = ends[live] - length
        low, high = index.step(text[at], low, high)
        if length >= window:
            low, high, g = index.widen(low)
            found[at] = earliest[g] < place[at]
        stay = sizes[live] > length
        live, low, high = live[stay], low[stay], high[stay]
    return [found[h : h + max(s - window + 1, 0)] for h, s in zip(heads, sizes, strict=True)]


SPANS = "id long, key long, start int, stop int"


def search_shards(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Index bounded runs of shards (rows come sorted by shard) and report repeated spans."""

    def report(rows: list[tuple]) -> pa.RecordBatch:
        codes: dict[str, int] = {}
        texts = [np.array([codes.setdefault(w, len(codes) + 1) for w in r[1].split(" ")]) for r in rows]
        # Places as one number: document rank, then start; a segment keeps room for its windows.
        docs, number = np.unique(np.array([r[2] for r in rows]), return_inverse=True)
        starts = np.array([r[4] for r in rows], np.int64)
        order = number * (int(starts.max()) + max(map(len, texts)) + 1) + starts
        out: list[tuple] = []
        for r, hit in zip(rows, repeats(texts, order, window), strict=True):
            edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
            out += [(r[2], r[3], r[4] + int(a), r[4] + int(b) + window - 1) for a, b in edges.reshape(-1, 2)]
        columns = zip(*out, strict=True) if out else ([],) * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["id", "key", "start", "stop"]
        )

    rows: list[tuple] = []
    size, shard = 0, None
    for batch in batches:
        for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if size > SHARD_WORDS and r[0] != shard:
                yield report(rows)
                rows, size = [], 0
            rows.append(r)
            size += r[5] + window
            shard = r[0]
    if rows:
        yield report(rows)


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Word spans (id, key, start, stop) covered by windows that start earlier elsewhere; spans may overlap."""
    texts = docs.select(row_id().alias("id"), text_key().alias("key"), "text")
    found = texts.mapInArrow(lambda it: find_segments(it, window, gram), ANCHORS)
    anchors = (
        found.groupBy("anchor")
        .agg(
            F.count(F.lit(1)).alias("seen"),
            ((F.min("content") != F.max("content")) | (F.min("n") != F.max("n")) | F.max("own")).alias("mixed"),
            F.min(F.struct("id", "start")).alias("first"),
        )
        .where((F.col("seen") > 1) | F.col("mixed"))
        .drop("seen")
    )
    held = pin(found.join(anchors, "anchor"))
    plain = held.where(~F.col("mixed")).where(F.struct("id", "start") != F.col("first"))
    mixed = held.where("mixed").drop("first", "mixed", "own")
    distinct = pin(mixed.groupBy("anchor", "content", "n").agg(F.min(F.struct("id", "start", "key")).alias("first")))
    copies = mixed.join(distinct, ["anchor", "content", "n"]).where(F.struct("id", "start") != F.struct("first.id", "first.start"))
    whole = plain.select("id", "key", "start", "n").unionByName(copies.select("id", "key", "start", "n"))
    whole = whole.select("id", "key", "start", (F.col("start") + F.col("n") + window - 1).alias("stop"))
    hot = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > HOT)
    wanted = (
        distinct.join(hot, "anchor", "left")
        .select("first.*", "anchor", "n", F.col("kinds").isNotNull().alias("hot"))
        .groupBy("id", "key")
        .agg(F.collect_list(F.struct("anchor", "start", "n", "hot")).alias("wanted"))
    )
    cuts = pin(texts.join(wanted, ["id", "key"]).mapInArrow(lambda it: cut_segments(it, window), CUTS))
    kept = cuts.groupBy("shard", "words").agg(F.min(F.struct("id", "start", "key", "n")).alias("f"))
    again = cuts.where("n = 1").select("shard", "words", "id", "key", "start")
    later = (
        again.join(kept, ["shard", "words"])
        .where(F.struct("id", "start") != F.struct("f.id", "f.start"))
        .select("id", "key", "start", (F.col("start") + window).alias("stop"))
    )
    rows = kept.select("shard", "words", "f.id", "f.key", "f.start", "f.n")
    searched = rows.repartition("shard").sortWithinPartitions("shard", "id", "start").mapInArrow(lambda it: search_shards(it, window), SPANS)
    return whole.unionByName(later).unionByName(searched)


KEPT = "n_words long, n_removed long, kept string, kept_sha256 string"


def remove_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with n_words, n_removed, the kept words joined by one space, and their digest."""
    listed = spans.groupBy("id", "key").agg(F.collect_list(F.struct("start", "stop")).alias("__spans"))
    keyed = docs.select("*", row_id().alias("id"), text_key().alias("key")).join(listed, ["id", "key"], "left").drop("id", "key")
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in docs.schema)}, {KEPT}"

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            words = Words(batch.column("text"))
            out: list[tuple] = []
            for d, spans in enumerate(batch.column("__spans").to_pylist()):
                base, n = int(words.first[d]), int(words.first[d + 1] - words.first[d])
                gone = np.zeros(n + 1, np.int64)
                for s in spans or ():
                    gone[s["start"]] += 1
                    gone[s["stop"]] -= 1
                stay = np.flatnonzero(np.cumsum(gone)[:n] == 0)
                b, s, e = words.bytes, words.starts[base + stay], words.ends[base + stay]
                kept = b" ".join(b[x:y].tobytes() for x, y in zip(s, e, strict=True))
                out.append((n, n - len(stay), kept.decode(), hashlib.sha256(kept).hexdigest()))
            made = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)]
            names = [c for c in batch.schema.names if c != "__spans"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *made], [*names, "n_words", "n_removed", "kept", "kept_sha256"])

    return keyed.mapInArrow(keep, schema)


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every document without the words that repeat an earlier window; see the module for all cases."""
    docs = docs.select("doc_id", "text")
    return remove_spans(docs, repeated_spans(docs, window))
