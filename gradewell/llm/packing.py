"""Bounded-space best-fit packing of tokenised documents into sequences.

Tokens: the given tokenizer's ids of the whole text, then ``END``. Every word
between ASCII white space is encoded once per worker and then looked up; the
tokenizer drops white space, so its ids are those of the words in a row.

Packing reads one small row per piece. Pieces are dealt by a hash of their row number over
tasks of about ``TASK_SEQUENCES`` sequences and ``TASK_ROWS`` rows at most, so the number of
tasks follows the tokens and the last bins of a task are a small share. A task keeps at most
``OPEN`` bins, found through a bitset whose bit f says that a bin with f free
tokens is open; a piece goes where it leaves least room, and when a bin must be
closed the fullest goes.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradewell.llm.tables import pin
from gradewell.llm.text import light_batches

CAPACITY, END, OPEN, TASK_SEQUENCES, TASK_ROWS = 4096, 1, 1024, 4000, 500_000
CACHE = 500_000
_encoders: dict[str, Encoder] = {}
# The byte alphabet of byte-level vocabularies: printable bytes stand for themselves, the rest follow from 256.
_printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
_rest = iter(range(256, 512))
BYTE_LETTERS = [chr(b) if b in _printable else chr(next(_rest)) for b in range(256)]


SIGNS = string.punctuation.encode()


def unit_of(word: bytes) -> str:
    """A word of letters, in lower case, as the one unit the merges take it as; else empty."""
    if word.isalpha():
        return word.decode()
    text = word.decode()
    # Letters below U+0130 have no case or composition rules beyond their own.
    if text.isalpha() and max(text) < "\u0130":
        return "".join(map(BYTE_LETTERS.__getitem__, text.lower().encode()))
    return ""


class Encoder:
    """Ids of byte words (lower-case ASCII letters) as little-endian 32-bit runs, cached."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[bytes, bytes] = {}

    def encode(self, words: set[bytes]) -> None:
        """Add the ids of new words. Signs that end a word of letters are split from it, as the tokenizer does."""
        new = words - self.known.keys()
        if len(self.known) + len(new) > CACHE:
            # Words of this batch stay: among them are the frequent ones, which would be encoded again at once.
            self.known = {w: self.known[w] for w in words & self.known.keys()}
        units: dict[bytes, str] = {}
        signed: dict[bytes, tuple[bytes, bytes]] = {}
        others: set[bytes] = set()
        for w in new:
            stem = w if w.isalpha() else w.rstrip(SIGNS)
            if stem not in units:
                unit = unit_of(stem)
                if not unit:
                    others.add(w)
                    continue
                if stem not in self.known:
                    units[stem] = unit
            if len(stem) < len(w):
                signed[w] = (stem, w[len(stem) :])
        others |= {signs for _, signs in signed.values()} - self.known.keys()
        merge = self.tokenizer.model.tokenize
        for w, unit in units.items():
            self.known[w] = b"".join([t.id.to_bytes(4, "little") for t in merge(unit)])
        rest = list(others)
        for a in range(0, len(rest), 10_000):
            part = rest[a : a + 10_000]
            for w, e in zip(part, self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False), strict=True):
                self.known[w] = np.array(e.ids, "<u4").tobytes()
        for w, (stem, signs) in signed.items():
            self.known[w] = self.known[stem] + self.known[signs]

    def ids(self, texts: list[bytes]) -> Iterator[bytes]:
        split = [t.lower().split() for t in texts]
        self.encode({w for ws in split for w in ws})
        known = self.known.__getitem__
        for ws in split:
            yield b"".join(map(known, ws))


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


PIECES = "piece int, start long, length long, ids_crc32 long, ids array<int>"


def tokenise(docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id``, piece, start, length, ids_crc32, and ids if wanted.

    Only documents longer than ``capacity`` are cut. A null text is empty and has
    one piece, the end token. Repeated rows stay; a null doc_id is kept.
    """
    last = np.array([END], "<u4").tobytes()
    width = 4 * capacity

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in light_batches(batches):
            names = batch.column("doc_id").to_pylist()
            texts = batch.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
            rows: list[tuple] = []
            for name, ids in zip(names, encoder(path).ids(texts), strict=True):
                ids += last
                for p, a in enumerate(range(0, len(ids), width)):
                    part = ids[a : a + width]
                    rows.append((name, p, a // 4, len(part) // 4, zlib.crc32(part), np.frombuffer(part, "<i4") if keep_ids else None))
            kinds = (batch.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = docs.select("doc_id", "text").mapInArrow(pieces, f"doc_id {kind}, {PIECES}")
    return made if keep_ids else made.drop("ids")


def best_fit(lengths: list[int], capacity: int, most: int) -> tuple[list[int], list[int]]:
    """Bin number and offset of each piece, in the order given, with at most ``most`` bins open."""
    bins, offsets = [], []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bits = made = count = 0
    for n in lengths:
        room = bits >> n
        if room:
            free = n + (room & -room).bit_length() - 1
            b = open_bins[free].pop()
            if not open_bins[free]:
                bits ^= 1 << free
            count -= 1
        else:
            if count == most:
                fullest = (bits & -bits).bit_length() - 1
                open_bins[fullest].pop()
                if not open_bins[fullest]:
                    bits ^= 1 << fullest
                count -= 1
            b, free, made = made, capacity, made + 1
        bins.append(b)
        offsets.append(capacity - free)
        left = free - n
        if left:
            open_bins[left].append(b)
            bits |= 1 << left
            count += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, most: int = OPEN) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``; ``pieces`` is read twice and must be a written table.

    A row's number in that table deals it out, so rows that repeat spread like others, and a
    task, bounded in tokens and rows, packs its pieces in the order of their numbers
    whatever order they arrive in.
    """
    total, rows = pieces.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count(F.lit(1))).first()
    tasks = max(-(-total // (capacity * TASK_SEQUENCES)), -(-rows // TASK_ROWS), 1)

    def fill(batch: pa.Table) -> pa.Table:
        batch = batch.sort_by("row")
        bins, offsets = best_fit(batch.column("length").to_pylist(), capacity, most)
        first = batch.column("task")[0].as_py() << 40
        placed = batch.drop_columns(["task", "row"]).append_column("sequence_id", pa.array([first + b for b in bins], pa.int64()))
        return placed.append_column("offset", pa.array(offsets, pa.int64()))

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    numbered = pieces.withColumn("row", F.monotonically_increasing_id())
    dealt = numbered.withColumn("task", F.pmod(F.xxhash64("row"), F.lit(tasks)).cast("int"))
    return dealt.groupBy("task").applyInArrow(fill, f"{names}, sequence_id long, offset long")


def best_fit_packing(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """All documents in sequences of at most ``capacity`` tokens, one row per piece; see ``tokenise``."""
    return pack(pin(tokenise(docs, path, capacity)), capacity)
