"""Ranked lexical search by pipelined term partitioning.

Documents are cut into blocks of at most ``BLOCK`` neighbouring rows of a task, and the
task that reads a block inverts it: one posting list per term and block, with each
posting's share of the score before the term's weight. Terms belong to owners by how
many documents hold them, the rarest first. Items travel in bundles of at most
``BUNDLE``; a bundle visits the owners one after the other and carries, per block, the
sparse accumulators of its items: the documents met so far and their integer scores.
At each owner a cogroup of the bundles with the owner's posting lists adds the owner's
contributions, and the result is pinned before the next one.

Between two owners each item's 20th best score so far is known, a lower bound of the final
one, and the most that the owners ahead can still add. A document that cannot
reach the bound with all of that is dropped, and where a new document could not, none
is opened. Both are exact: every document of the final 20 is carried to the end, ties included.

What is sent to all tasks is the document and word counts and a bit set of fixed size
over the items' term hashes, which keeps words that no item asks for out of the index; the
few that it lets through go at the join with the terms.

A null text has no terms, and an item without any has no documents. Every row of either
table counts as a document or item of its own, also where ids repeat; rows without a
doc_id are documents that lose ties. Extra columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradewell.llm.tables import pin
from gradewell.llm.text import small_batches

TOP, BLOCK_BITS, BUNDLE_BITS, HASH_BITS = 20, 11, 8, 23
BLOCK, PAGE_BITS = 1 << BLOCK_BITS, 15
# An owner has the terms that fewer than one in so many documents hold; the last one has the rest.
OWNERS = (256, 32, 8)
LAST_OWNER = len(OWNERS)
KNOWN_WORDS = 500_000
# Scale of the score, saturation of a term's count, part of it that follows the length.
SCALE, SATURATION, LENGTH_PART = 1_000_000_000, 12, 25
_upper = range(ord("A"), ord("Z") + 1)
_inside = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
LETTERS = bytes(b + 32 if b in _upper else b if b in _inside else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and other characters than ASCII, A-Z lower-cased."""
    return text.translate(LETTERS).split()


def item_terms(items: DataFrame) -> DataFrame:
    """(bundle, item, item_id, term, times): each item's distinct terms; ``item`` numbers its row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            counted = [Counter(terms_of(t or b"")) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            owner = np.repeat(np.arange(len(counted)), [len(c) for c in counted])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item").take(pa.array(owner)),
                    batch.column("item_id").take(pa.array(owner)),
                    pa.array([w for c in counted for w in c], pa.binary()).cast(pa.string()),
                    pa.array([k for c in counted for k in c.values()], pa.int64()),
                ],
                ["item", "item_id", "term", "times"],
            )

    kind = items.schema["item_id"].dataType.simpleString()
    numbered = items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    made = numbered.mapInArrow(read, f"item long, item_id {kind}, term string, times long")
    return made.withColumn("bundle", F.shiftright("item", BUNDLE_BITS))


def term_bits(asked: DataFrame) -> bytes:
    """One bit per hash of a term that an item asks for; ``2^HASH_BITS`` bits whatever the items."""
    h = F.crc32(F.col("term").cast("binary")) % (1 << HASH_BITS)
    pages = asked.select(F.shiftright(h, PAGE_BITS).alias("page"), (h % (1 << PAGE_BITS)).alias("bit"))
    size = 1 << (PAGE_BITS - 3)
    bits = bytearray(1 << (HASH_BITS - 3))
    for row in pages.groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        bits[row["page"] * size : (row["page"] + 1) * size] = row["bits"]
    return bytes(bits)


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """Documents with at least one term, and terms in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sizes = [len(terms_of(t or b"")) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_pydict({"docs": [sum(n > 0 for n in sizes)], "terms": [sum(sizes)]})

    sums = docs.select("text").mapInArrow(count, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return sums[0] or 0, sums[1] or 0


class Block:
    """Posting lists of the documents of one block."""

    def __init__(self, number: int):
        self.number = number
        self.names: dict[bytes, int] = {}
        self.slots: list[np.ndarray] = []
        self.terms: list[np.ndarray] = []
        self.shares: list[np.ndarray] = []
        self.ids: list[int | None] = []

    def add(self, doc_id: int | None, found: list[tuple[bytes, int]], length: int) -> None:
        """``length`` is the document's m."""
        names = self.names
        self.terms.append(np.array([names.setdefault(w, len(names)) for w, _ in found], np.int32))
        times = np.array([k for _, k in found], np.int64)
        self.shares.append((SCALE * times // (1000 * times + SATURATION * length)).astype("<i4"))
        self.slots.append(np.full(len(found), len(self.ids), "<u2"))
        self.ids.append(doc_id)

    def rows(self) -> pa.RecordBatch:
        """A row per term, and one without term that has the documents' ids."""
        term = np.concatenate(self.terms)
        order = np.argsort(term, kind="stable")
        slots, shares = np.concatenate(self.slots)[order], np.concatenate(self.shares)[order]
        cuts = np.searchsorted(term[order], np.arange(len(self.names) + 1))
        spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
        n = len(spans) + 1
        return pa.RecordBatch.from_arrays(
            [
                pa.array([self.number] * n, pa.int64()),
                pa.array([*self.names, None], pa.binary()).cast(pa.string()),
                pa.array([*(b - a for a, b in spans), 0], pa.int64()),
                pa.array([*(int(shares[a:b].max()) for a, b in spans), 0], pa.int64()),
                pa.array([*(slots[a:b].tobytes() for a, b in spans), b""], pa.binary()),
                pa.array([*(shares[a:b].tobytes() for a, b in spans), b""], pa.binary()),
                pa.array([*([None] * len(spans)), self.ids], pa.list_(pa.int64())),
            ],
            ["block", "term", "docs", "most", "slots", "shares", "ids"],
        )


def invert(docs: DataFrame, bits: bytes, n_docs: int, n_terms: int) -> DataFrame:
    """Posting lists by block and term: ``slots`` (places in the block) and ``shares``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bool] = {}
        block: Block | None = None

        def asked(word: bytes) -> bool:
            if len(known) > KNOWN_WORDS:
                known.clear()
            h = zlib.crc32(word) % (1 << HASH_BITS)
            known[word] = bool(bits[h >> 3] >> (h & 7) & 1)
            return known[word]

        for batch in small_batches(batches):
            rows = zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id")), batch.column("text").cast(pa.binary()).to_pylist(), strict=True)
            for row, doc_id, text in rows:
                if block is None or row >> BLOCK_BITS != block.number:
                    if block is not None:
                        yield block.rows()
                    block = Block(row >> BLOCK_BITS)
                words = terms_of(text or b"")
                length = 100 - LENGTH_PART + (LENGTH_PART * len(words) * n_docs) // max(n_terms, 1)
                get = known.get
                found = [(w, k) for w, k in Counter(words).items() if (asked(w) if (a := get(w)) is None else a)]
                block.add(doc_id, found, length)
        if block is not None:
            yield block.rows()

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return numbered.mapInArrow(read, "block long, term string, docs long, most long, slots binary, shares binary, ids array<long>")


def weigh(index: DataFrame, asked: DataFrame, n_docs: int) -> DataFrame:
    """(term, weight, most, owner) of the items' terms that some document holds."""
    held = index.where("term IS NOT NULL").groupBy("term").agg(F.sum("docs").alias("df"), F.max("most").alias("most"))
    held = held.join(asked.select("term").distinct(), "term", "left_semi")
    weight = F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    owner: Column = F.lit(LAST_OWNER)
    for o, part in reversed(list(enumerate(OWNERS))):
        owner = F.when(F.col("df") * part < n_docs, o).otherwise(owner)
    return held.select("term", weight.alias("weight"), (weight * F.col("most")).alias("most"), owner.alias("owner"))


STATE = "bundle long, block long, item long, slots binary, scores binary, best array<long>"


def visit(owner: int, top: int, final: bool):
    """What a bundle does at an owner, for the documents of one block."""

    def add(bundles: pa.Table, lists: pa.Table) -> pa.Table:
        postings, ids = {}, None
        for term, weight, slots, shares, named in zip(*(lists.column(c).to_pylist() for c in ("term", "weight", "slots", "shares", "ids")), strict=True):
            if term is None:
                ids = np.array([np.iinfo(np.int64).max if i is None else i for i in named], np.int64), named
            else:
                postings[term] = np.frombuffer(slots, "<u2"), weight * np.frombuffer(shares, "<i4").astype(np.int64)
        out: list[tuple] = []
        columns = (bundles.column(c).to_pylist() for c in ("bundle", "block", "item", "terms", "times", "rest", "bound", "slots", "scores"))
        for bundle, block, item, terms, times, rest, bound, slots, scores in zip(*columns, strict=True):
            total, live = np.zeros(BLOCK, np.int64), np.zeros(BLOCK, bool)
            if slots:
                at = np.frombuffer(slots, "<u2")
                total[at], live[at] = np.frombuffer(scores, "<i8"), True
            bound = bound or 0
            opens = rest[owner] >= bound
            for term, k in zip(terms[owner], times[owner], strict=True):
                if term not in postings:
                    continue
                at, gain = postings[term]
                if not opens:
                    old = live[at]
                    at, gain = at[old], gain[old]
                total[at] += k * gain
                live[at] = True
            at = np.flatnonzero(live)
            if len(at) >= top:
                bound = max(bound, int(np.partition(total[at], -top)[-top]))
            at = at[total[at] + rest[owner + 1] >= bound]
            if final:
                at = at[total[at] > 0]
                order, named = ids
                at = at[np.lexsort((at, order[at], -total[at]))[:top]]
                out += [(item, named[a], (block << BLOCK_BITS) + int(a), int(total[a])) for a in at]
            else:
                best = np.sort(total[at])[::-1][:top]
                out.append((bundle, block, item, at.astype("<u2").tobytes(), total[at].tobytes(), best))
        schema = FINAL if final else CARRIED
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema) if out else schema.empty_table()

    return add


CARRIED = pa.schema([("bundle", pa.int64()), ("block", pa.int64()), ("item", pa.int64()), ("slots", pa.binary()), ("scores", pa.binary()), ("best", pa.list_(pa.int64()))])
FINAL = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int64()), ("score", pa.int64())])


def first_of_item(df: DataFrame, order: list[Column], top: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)


def bounds(state: DataFrame, top: int) -> DataFrame:
    """(item, bound): its score at rank ``top`` so far; items with fewer documents have none."""
    scores = state.select("item", F.explode("best").alias("score"))
    ranked = first_of_item(scores, [F.col("score").desc()], top)
    return ranked.where(F.col("rank") == top).select("item", F.col("score").alias("bound"))


def bundles_of(asked: DataFrame, weighed: DataFrame) -> DataFrame:
    """A row per item: bundle, and by owner its terms, their times, and the most that owners from there on add."""
    known = asked.join(weighed, "term")
    each = known.groupBy("bundle", "item").agg(
        *[
            F.sort_array(F.collect_list(F.when(F.col("owner") == o, F.struct("term", "times")))).alias(f"__at{o}")
            for o in range(LAST_OWNER + 1)
        ],
        *[F.sum(F.when(F.col("owner") >= o, F.col("times") * F.col("most")).otherwise(0)).alias(f"__rest{o}") for o in range(LAST_OWNER + 1)],
    )
    owners = range(LAST_OWNER + 1)
    return each.select(
        "bundle",
        "item",
        F.array(*[F.col(f"__at{o}.term") for o in owners]).alias("terms"),
        F.array(*[F.col(f"__at{o}.times") for o in owners]).alias("times"),
        F.array(*[F.col(f"__rest{o}") for o in owners], F.lit(0).cast("long")).alias("rest"),
    )


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """Each item's ``top`` highest-scoring documents: item_id, rank, doc_id, score.

    ``docs`` has doc_id and text, ``items`` item_id and text. Scores are sums of
    weight * share over the item's terms, repeats included, in 64-bit integers;
    equal scores by ascending doc_id.
    """
    asked = pin(item_terms(items))
    n_docs, n_terms = corpus_size(docs)
    index = pin(invert(docs, term_bits(asked), n_docs, n_terms))
    weighed = pin(weigh(index, asked, n_docs))
    bundles = pin(bundles_of(asked, weighed))
    stops = asked.select("bundle", "term").distinct().join(weighed.select("term", "weight", "owner"), "term")
    lists = index.where("term IS NOT NULL").join(stops, "term")
    met = pin(lists.select("bundle", "block").distinct())
    state = met.join(bundles, "bundle").withColumns({"slots": F.lit(None).cast("binary"), "scores": F.lit(None).cast("binary"), "bound": F.lit(0).cast("long")})
    # Columns under new identities, as the bundles come from the same tables.
    carried = [F.col(c).alias(c) for c in ("bundle", "block", "term", "weight", "slots", "shares", "ids")]
    for owner in range(LAST_OWNER + 1):
        final = owner == LAST_OWNER
        here = lists.where(F.col("owner") == owner).select(*carried)
        if final:
            named = index.where("term IS NULL").join(met, "block").withColumn("weight", F.lit(0).cast("long"))
            here = here.unionByName(named.select(*carried))
        stage = state.groupBy("bundle", "block").cogroup(here.groupBy("bundle", "block"))
        if final:
            found = pin(stage.applyInArrow(visit(owner, top, final), "item long, doc_id long, row long, score long"))
            break
        after = pin(stage.applyInArrow(visit(owner, top, final), STATE))
        reached = pin(bounds(after, top))
        state = after.drop("best").join(bundles.drop("bundle"), "item").join(reached, "item", "left")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    best = first_of_item(found, order, top)
    names = asked.select("item", "item_id").distinct()
    return best.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
