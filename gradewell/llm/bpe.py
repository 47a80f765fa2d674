"""Byte-level BPE: pre-tokens by an associative scan over character classes, then cached merges.

The public pattern (contractions, letters, numbers, other signs, white space,
each with at most one space before it) is a finite automaton once two facts are
put into the symbol of a character: what follows white space, and whether an
apostrophe has a contraction's letters behind it. ``TABLE`` holds each symbol's
transition function as a vector over states. Functions compose associatively,
so blocks of characters are composed side by side, block functions are scanned
by doubling, and a last pass reads off where a pre-token starts. No regular
expression is used.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gradewell.llm.text import small_batches

# Symbols: letter, number, sign, white space before white space or the end,
# other white space before a character, space before a character, apostrophe
# before one or two contraction letters.
LETTER, NUMBER, SIGN, BLANK, LAST, LEAD, SHORT, LONG = range(8)
# States: nothing open, inside letters, numbers, signs, after a leading space,
# inside white space, one or two contraction letters to come.
NONE, LETTERS, NUMBERS, SIGNS, LED, BLANKS, ONE, TWO = range(8)
FIRST = 8  # added to the symbol of a text's first character
BLOCK = 256
CACHE = 400_000
# White space characters of the pattern (fixed values).
WHITE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a pre-token starts, by symbol and state."""
    after = np.zeros((16, 8), np.uint8)
    starts = np.ones((16, 8), bool)
    for symbol, state in ((LETTER, LETTERS), (NUMBER, NUMBERS), (SIGN, SIGNS)):
        after[symbol] = state
        starts[symbol, [state, LED]] = False
    after[LETTER, [ONE, TWO]] = NONE, ONE
    starts[LETTER, [ONE, TWO]] = False
    after[BLANK] = BLANKS
    starts[BLANK, BLANKS] = False
    after[LAST], after[LEAD] = NONE, LED
    for symbol, state in ((SHORT, ONE), (LONG, TWO)):
        after[symbol] = state
        after[symbol, [SIGNS, LED]] = SIGNS
        starts[symbol, [SIGNS, LED]] = False
    after[FIRST:] = after[:FIRST, [NONE]]
    return after, starts


TABLE, STARTS = automaton()
_classes: list[np.ndarray] = []


def classes() -> np.ndarray:
    """LETTER, NUMBER, SIGN or BLANK of every code point; built once per worker."""
    if not _classes:
        kind = np.full(0x110000, SIGN, np.uint8)
        for c in range(0x110000):
            first = unicodedata.category(chr(c))[0]
            if first == "L":
                kind[c] = LETTER
            elif first == "N":
                kind[c] = NUMBER
        kind[WHITE] = BLANK
        _classes.append(kind)
    return _classes[0]


def symbols(points: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """The symbol of each code point; ``heads`` marks first characters of texts."""
    kind = classes()[points]
    n = len(points)

    def ahead(k: int) -> np.ndarray:
        """The code point k places on, 0 beyond the text."""
        out = np.zeros(n, points.dtype)
        if n > k:
            inside = np.ones(n - k, bool)
            for j in range(1, k + 1):
                inside &= ~heads[j : n - k + j]
            out[: n - k] = np.where(inside, points[k:], 0)
        return out

    one, two = ahead(1), ahead(2)
    ended = np.ones(n, bool)
    ended[:-1] = heads[1:]
    white = kind == BLANK
    before_white = ended.copy()
    before_white[:-1] |= white[1:]
    out = kind.copy()
    out[white & ~before_white] = LAST
    out[white & ~before_white & (points == 32)] = LEAD
    mark = points == 39
    out[mark & np.isin(one, [ord(c) for c in "stmd"])] = SHORT
    pair = one.astype(np.int64) << 21 | two
    out[mark & np.isin(pair, [ord(a) << 21 | ord(b) for a, b in ("re", "ve", "ll")])] = LONG
    out[heads] += FIRST
    return out


def boundaries(symbol: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each place, by a blocked scan of transition functions."""
    n = len(symbol)
    rows = -(-n // BLOCK)
    padded = np.full(rows * BLOCK, BLANK, np.uint8)
    padded[:n] = symbol
    columns = np.ascontiguousarray(padded.reshape(rows, BLOCK).T)
    flat = TABLE.ravel()
    whole = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for column in columns:
        whole = flat[(column.astype(np.uint16) << 3)[:, None] + whole]
    shift = 1
    while shift < rows:  # prefix[i] = whole[i] after ... after whole[0]
        whole[shift:] = np.take_along_axis(whole[shift:], whole[:-shift].astype(np.intp), 1)
        shift *= 2
    state = np.zeros(rows, np.uint8)
    state[1:] = whole[:-1, NONE]
    out = np.empty((BLOCK, rows), bool)
    starts = STARTS.ravel()
    for k, column in enumerate(columns):
        at = (column.astype(np.uint16) << 3) + state
        out[k] = starts[at]
        state = flat[at]
    return out.T.ravel()[:n]


def slices(texts: pa.Array) -> Iterator[tuple[bytes, list[int]]]:
    """Each text's bytes and the byte places of its pre-tokens, with the end."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    listed = texts.to_pylist()
    data = b"".join(listed)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in listed])))
    points = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
    lead = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    heads = np.zeros(len(points), bool)
    filled = offsets[:-1][np.diff(offsets) > 0]
    heads[np.searchsorted(lead, filled)] = True
    cuts = lead[boundaries(symbols(points, heads))] if len(points) else lead
    first = np.searchsorted(cuts, offsets)
    for t, text in enumerate(listed):
        yield text, [*(cuts[first[t] : first[t + 1]] - offsets[t]).tolist(), len(text)]


class Codec:
    """Ranks of a public vocabulary; pre-tokens already merged are kept as decimal ids."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.tokens = {b: base64.b64decode(a) for a, b in pairs}  # decimal id to bytes
        self.known: dict[bytes, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: the pair of least rank is joined first, the leftmost of equals."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        rank = self.ranks.get
        ends = list(range(1, n + 1))  # end of the part that starts here
        back = list(range(-1, n - 1))  # start of the part before
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        gone = bytearray(n)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = ends[i]
            if gone[i] or middle >= n or ends[middle] != stop:
                continue
            ends[i] = stop
            gone[middle] = 1
            if stop < n:
                back[stop] = i
                if (r := rank(piece[i : ends[stop]])) is not None:
                    heapq.heappush(heap, (r, i, ends[stop]))
            p = back[i]
            if p >= 0 and (r := rank(piece[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        return [self.ranks[piece[i : ends[i]]] for i in range(n) if not gone[i]]

    def learn(self, pieces: set[bytes]) -> None:
        new = pieces - self.known.keys()
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
            new = pieces
        for p in new:
            self.known[p] = " ".join(map(str, self.merge(p))).encode()

    def encode(self, texts: pa.Array) -> Iterator[tuple[bytes, list[int], list[bytes]]]:
        """For each text: decimal ids joined by spaces, slice places, ids of each slice."""
        cut = []
        for text, at in slices(texts):
            cut.append(([text[a:b] for a, b in zip(at, at[1:], strict=False)], at))
        self.learn({p for pieces, _ in cut for p in pieces})
        known = self.known.__getitem__
        for pieces, at in cut:
            ids = list(map(known, pieces))
            yield b" ".join(ids), at, ids

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.split()))


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"
LISTS = "ids array<int>, slice_starts array<long>, slice_tokens array<int>"


def encode(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """Token count and digests of the ids and of the bytes decoded from them, per row.

    With ``keep_ids`` also the ids, the byte place of each slice and its number
    of ids, so any run of ids can be put back into its text. A null text is an
    empty one with no ids; repeated rows and null doc_ids stay.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in small_batches(batches):
            counts, digests, decoded, lists = [], [], [], []
            for ids, at, parts in own.encode(batch.column("text")):
                counts.append(ids.count(b" ") + 1 if ids else 0)
                digests.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(own.decode(ids)).hexdigest())
                if keep_ids:
                    lists.append((list(map(int, ids.split())), at[:-1], [p.count(b" ") + 1 for p in parts]))
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                kinds = (pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()))
                columns += [pa.array(c, t) for c, t in zip(zip(*lists, strict=True), kinds, strict=True)]
                names += ["ids", "slice_starts", "slice_tokens"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, {DIGEST}" + (f", {LISTS}" if keep_ids else ""))


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``doc_id`` and the text of an ids column; bytes that are no UTF-8 become U+FFFD."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            texts = [None if x is None else own.decode(" ".join(map(str, x)).encode()).decode(errors="replace") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", ids).mapInArrow(rows, f"doc_id {kind}, text string")
