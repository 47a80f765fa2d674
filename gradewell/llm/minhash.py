"""MinHash near-dedup by BagMinHash over multisets of five-word shingles.

A shingle that a text has c times weighs c. Weights are cut into the intervals
(0, 1], (1, 2], (2, 4], (4, 8] ...; every shingle and interval has its own
Poisson process, as fast as the interval is wide, whose points fall on registers
at random. A point in the last interval of a weight counts only if its place in
the interval lies below the weight. Each register keeps its earliest point, so
two bags agree in a register with the probability of their weighted Jaccard
similarity. Points beyond a text's latest register are never made.

``BANDS`` x ``ROWS`` registers make the candidates (a pair at 0.8 is missed with
probability 7e-5). Equal texts are one representative, found by an aggregate.
Within a bucket every member is first held against one hub, and in two further
rounds against another hub each; that joins large classes cheaply. A hub is
settled in its bucket. Texts whose sizes alone keep them below ``LIKE`` are not
compared, and the rows of a hot bucket are spread over salts. Whatever members of different classes then remain in a
bucket are compared pair by pair, in cells of two blocks (``check_cells``), so
every candidate pair is verified or lies within a class already. The multisets
decide every pair. Classes are the components of verified links.

``n_links`` counts the verified links that a text's class was built from. Pairs
within a class known already are not compared, so it is not the number of all
texts at ``LIKE`` or more.

Texts of one to four words are one shingle. Texts without words are alone.
Rows that repeat id and text share a class; null ids come last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewell.llm.neighbours import groups
from gradewell.llm.tables import pin, row_id, text_key
from gradewell.llm.text import U, Words, light_batches, mix, shingles
from gradewell.operators.joins import lookup_join
from gradewell.operators.spread import directory

WORDS, BANDS, ROWS, LIKE, HUB_ROUNDS = 5, 24, 5, 0.8, 3
# A block of a bucket has about so many members and words; stripes are columns of one matrix product.
BLOCK, BLOCK_WORDS, STRIPE = 256, 1 << 20, 8192


def bags(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, shingle and count of each different shingle, by document and shingle."""
    hashes = words.hashes()
    sizes = np.diff(words.first)
    document = words.documents()
    flat = shingles(hashes, WORDS)
    n = len(flat)
    whole = np.flatnonzero(document[:n] == document[WORDS - 1 : WORDS - 1 + n]) if n else np.zeros(0, np.int64)
    short = np.flatnonzero((sizes > 0) & (sizes < WORDS))
    lone = np.array([shingles(hashes[words.first[d] : words.first[d + 1]], int(sizes[d]))[0] for d in short], U)
    d = np.concatenate((document[whole], short))
    h = np.concatenate((flat[whole], lone))
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    heads = np.flatnonzero(new)
    return d[heads], h[heads], np.diff(np.append(heads, len(d)))


def signatures(document: np.ndarray, shingle: np.ndarray, count: np.ndarray, n: int, registers: int) -> np.ndarray:
    """Earliest point of each register, one row per document; infinite for a document without shingles."""
    seeds, owners, rates, parts = [], [], [], []
    low, level = 0, 0
    some = np.arange(len(shingle))
    while len(some):
        width = max(low, 1)
        seeds.append(mix(shingle[some] + U(0xD6E8FEB86659FD93 * (level + 1) % 2**64)))
        owners.append(document[some])
        rates.append(np.full(len(some), float(width)))
        parts.append(np.minimum((count[some] - low) / width, 1.0))
        low, level = low + width, level + 1
        some = some[count[some] > low]
    best = np.full(n * registers, np.inf)
    if not seeds:
        return best.reshape(n, registers)
    seed, owner, rate, part = (np.concatenate(x) for x in (seeds, owners, rates, parts))
    time = np.zeros(len(seed))
    step = 0
    while len(seed):
        step += 1
        one = mix(seed + U(0x9E3779B97F4A7C15 * step % 2**64))
        two = mix(one ^ U(0xA0761D6478BD642F))
        time = time - np.log1p(-((one >> U(11)).astype(float) * 2.0**-53)) / rate
        counts = (two & U(0xFFFFFFFF)).astype(float) * 2.0**-32 < part
        register = ((two >> U(32)) * U(registers) >> U(32)).astype(np.int64)
        np.minimum.at(best, (owner * registers + register)[counts], time[counts])
        latest = best.reshape(n, registers).max(1)
        live = time < latest[owner]
        seed, owner, rate, part, time = seed[live], owner[live], rate[live], part[live], time[live]
    return best.reshape(n, registers)


SKETCH = "id long, key long, a long, b long, n long, bands array<long>"


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two hashes of the word sequence, number of words, and a hash of each band."""
    for batch in light_batches(batches):
        words = Words(batch.column("text"))
        n = batch.num_rows
        best = signatures(*bags(words), n, BANDS * ROWS).view(U).reshape(n, BANDS, ROWS)
        band = np.zeros((n, BANDS), U)
        for r in range(ROWS):
            band = mix(band * U(0x9E3779B97F4A7C15) + best[:, :, r])
        band = mix(band + np.arange(BANDS, dtype=U))
        hashes = words.hashes()
        size = np.diff(words.first)
        at = np.arange(len(hashes)) - np.repeat(words.first[:-1], size)
        pair = []
        for salt in (1, 2):
            sums = np.concatenate((np.zeros(1, U), np.cumsum(mix(hashes ^ mix((at.astype(U) << U(2)) + U(salt))), dtype=U)))
            pair.append((mix(sums[words.first[1:]] - sums[words.first[:-1]] + size.astype(U))).astype(np.int64))
        lists = pa.FixedSizeListArray.from_arrays(pa.array(band.astype(np.int64).ravel()), BANDS).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("key"), pa.array(pair[0]), pa.array(pair[1]), pa.array(size), lists], ["id", "key", "a", "b", "n", "bands"]
        )


def make_bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's shingles in order, repeated as often as they occur, as 64-bit numbers."""
    for batch in light_batches(batches):
        document, shingle, count = bags(Words(batch.column("text")))
        document, shingle = np.repeat(document, count), np.repeat(shingle, count)
        cuts = np.searchsorted(document, np.arange(batch.num_rows + 1))
        made = [shingle[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([batch.column("v"), pa.array(made, pa.binary())], ["v", "bag"])


def overlap(x: bytes, y: bytes) -> float:
    """Weighted Jaccard similarity of two ordered multisets."""
    a, ca = np.unique(np.frombuffer(x, U), return_counts=True)
    b, cb = np.unique(np.frombuffer(y, U), return_counts=True)
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    shared = int(np.minimum(ca[i], cb[j]).sum())
    return shared / max(int(ca.sum() + cb.sum()) - shared, 1)


def check_pairs(batches: Iterator[pa.RecordBatch], like: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = [overlap(x.as_py(), y.as_py()) >= like for x, y in zip(batch.column("x"), batch.column("y"), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("v"), batch.column("w")], ["v", "w"]).filter(pa.array(ok, pa.bool_()))


def copies(bags: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bag and value of each element; the n-th copy of a shingle in a bag is an element of its own."""
    bag = np.repeat(np.arange(len(bags)), [len(b) // 8 for b in bags])
    value = np.frombuffer(b"".join(bags), U)
    at = np.arange(len(value))
    new = np.ones(len(value), bool)
    new[1:] = (bag[1:] != bag[:-1]) | (value[1:] != value[:-1])
    copy = at - np.maximum.accumulate(np.where(new, at, 0))
    return bag, value + copy.astype(U) * U(0x9E3779B97F4A7C15)


def overlaps(xs: list[bytes], ys: list[bytes]) -> np.ndarray:
    """``overlap`` of each of ``xs`` with each of ``ys``."""
    sides = [copies(xs), copies(ys)]
    common = np.intersect1d(sides[0][1], sides[1][1])
    held = []
    for bag, value in sides:
        at = np.searchsorted(common, value)
        ok = at < len(common)
        ok[ok] = common[at[ok]] == value[ok]
        order = np.argsort(at[ok], kind="stable")
        held.append((bag[ok][order], at[ok][order]))
    shared = np.zeros((len(xs), len(ys)))
    for low in range(0, len(common), STRIPE):
        parts = []
        for (bag, at), n in zip(held, shared.shape, strict=True):
            a, b = np.searchsorted(at, (low, low + STRIPE))
            part = np.zeros((n, min(STRIPE, len(common) - low)), np.float32)
            part[bag[a:b], at[a:b] - low] = 1
            parts.append(part)
        shared += parts[0] @ parts[1].T
    size = [np.array([len(b) // 8 for b in side], float) for side in (xs, ys)]
    return shared / np.maximum(size[0][:, None] + size[1][None, :] - shared, 1)


PAIR = "v_id long, v_key long, w_id long, w_key long"


def check_cells(batches: Iterator[pa.RecordBatch], like: float) -> Iterator[pa.RecordBatch]:
    """Verified pairs between the left and the right rows of each cell that are in different classes.

    Left rows are not of the bucket's largest class (``minor``); of two such rows the lesser is the left one.
    """
    for rows in groups(batches, "cell"):
        left = np.asarray(rows.column("left"))
        x, y = np.flatnonzero(left), np.flatnonzero(~left)
        if not len(x) or not len(y):
            continue
        id_, key, label_id, label_key, minor = (np.asarray(rows.column(c)) for c in ("id", "key", "label_id", "label_key", "minor"))
        bag = rows.column("bag").to_pylist()
        over = lambda a: (a[x][:, None], a[y][None, :])
        (xi, yi), (xk, yk), (xl, yl), (xm, ym) = map(over, (id_, key, label_id, label_key))
        asked = ((xl != yl) | (xm != ym)) & (~minor[y][None, :] | (xi < yi) | ((xi == yi) & (xk < yk)))
        if not asked.any():
            continue
        i, j = np.nonzero(asked & (overlaps([bag[k] for k in x], [bag[k] for k in y]) >= like))
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in (id_[x[i]], key[x[i]], id_[y[j]], key[y[j]])], ["v_id", "v_key", "w_id", "w_key"])


VERTEX = "struct<id:bigint,key:bigint>"


def components(edges: DataFrame) -> DataFrame:
    """(v, label) of every vertex, the least vertex of its component; ``edges`` is pinned.

    Least labels spread along edges. Stars, which hub links make, are done in two
    rounds; from the third on a label also jumps to its own label, so a chain
    takes a logarithm of its length.
    """
    both = pin(edges.select("v", "w").unionByName(edges.select(F.col("w").alias("v"), F.col("v").alias("w"))).distinct())
    labels = pin(both.groupBy("v").agg(F.least(F.min("w"), F.first("v")).alias("label")))
    step = 0
    while True:
        seen = both.join(labels.withColumnRenamed("v", "w"), "w").select("v", "label", F.lit(None).cast(VERTEX).alias("old"))
        own = labels.select("v", "label", F.col("label").alias("old"))
        after = own.unionByName(seen).groupBy("v").agg(F.min("label").alias("label"), F.max("old").alias("old"))
        if step >= 2:
            jump = labels.select(F.col("v").alias("label"), F.col("label").alias("next"))
            after = lookup_join(pin(after), jump, ["label"], "inner").select("v", F.least("label", "next").alias("label"), "old")
        after = pin(after)
        labels = after.drop("old")
        if after.where("label <> old").isEmpty():
            return labels
        step += 1


def may_be_like(n: str, m: str, like: float) -> Column:
    """Bags of texts of n and m words can share enough: no more than the smaller one's shingles of the larger one's."""
    size, other = (F.greatest(F.col(c) - (WORDS - 1), F.lit(1)) for c in (n, m))
    return F.least(size, other) >= F.greatest(size, other) * F.lit(like - 1e-9)


def labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``members`` with their class so far, themselves where no link is known."""
    if labels is None:
        return members.withColumn("label", F.col("v"))
    return members.join(labels, "v", "left").withColumn("label", F.coalesce("label", "v"))


def all_pairs(live: DataFrame, labels: DataFrame, held: DataFrame, like: float) -> DataFrame:
    """Every link (v, w) between members of one bucket that are in different classes.

    A pair of different classes has a side outside the bucket's largest class.
    Those are the left rows, all members the right ones; both are dealt to blocks
    by hash, and each left block meets each right block in a cell of its own, so
    no bucket is one task's.
    """
    at = pin(labelled(live, labels))
    sizes = at.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("words"))
    most = F.max(F.struct("n", "words", "label"))
    whole = sizes.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("words").alias("words"), most.alias("most"))

    def blocks(n, words):
        return F.greatest(F.ceil(n / BLOCK), F.ceil(words / BLOCK_WORDS)).cast("int")

    open_ = whole.where(F.col("n") > F.col("most.n")).select(
        "bucket",
        F.col("most.label").alias("large"),
        blocks(F.col("n") - F.col("most.n"), F.col("words") - F.col("most.words")).alias("lefts"),
        blocks(F.col("n"), F.col("words")).alias("rights"),
    )
    placed = at.drop("n").join(open_, "bucket").withColumn("minor", F.col("label") != F.col("large"))

    def dealt(rows: DataFrame, left: bool) -> DataFrame:
        own, other = ("lefts", "rights") if left else ("rights", "lefts")
        block = F.pmod(F.xxhash64("v", F.lit(left)), F.col(own))
        met = rows.withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        pair = ("own", "other") if left else ("other", "own")
        # Cells of one hash only share a table; what they add is verified like the rest.
        cell = F.xxhash64("bucket", *[F.col(c).cast("int") for c in pair])
        return met.select("v", cell.alias("cell"), F.lit(left).alias("left"), "minor", F.col("label.id").alias("label_id"), F.col("label.key").alias("label_key"))

    rows = dealt(placed.where("minor"), True).unionByName(dealt(placed, False)).join(held, "v")
    flat = rows.select("cell", "left", "minor", F.col("v.id").alias("id"), F.col("v.key").alias("key"), "label_id", "label_key", "bag")
    links = flat.repartition("cell").sortWithinPartitions("cell").mapInArrow(lambda it: check_cells(it, like), PAIR).distinct()
    v, w = (F.struct(F.col(f"{c}_id").alias("id"), F.col(f"{c}_key").alias("key")) for c in "vw")
    return links.select(F.least(v, w).alias("v"), F.greatest(v, w).alias("w")).distinct()


def near_duplicates(docs: DataFrame, like: float = LIKE) -> DataFrame:
    """(id, key, class_id, class_key, n_links) of every different (id, key): the class's earliest row and the text's links."""
    texts = docs.select(row_id().alias("id"), text_key().alias("key"), "text")
    sketches = pin(texts.mapInArrow(sketch, SKETCH))
    worded = sketches.where("n > 0")
    same = pin(worded.groupBy("a", "b").agg(F.min(F.struct("id", "key")).alias("v"), F.first("n").alias("n"), F.first("bands").alias("bands")))
    places = same.select("v", "n", F.explode("bands").alias("bucket"))
    shared = places.groupBy("bucket").agg(F.min("v").alias("least"), F.max("v").alias("most")).where("least <> most").select("bucket")
    hot = directory(places, ["bucket"])
    live = pin(lookup_join(places, shared, ["bucket"], "inner", hot))
    bag_ids = live.select("v").distinct()
    keyed = texts.withColumn("v", F.struct("id", "key")).select("v", "text").join(bag_ids, "v").dropDuplicates(["v"])
    held = pin(keyed.mapInArrow(make_bags, f"v {VERTEX}, bag binary"))
    labels = edges = None
    tried = None
    for step in range(HUB_ROUNDS):
        at = labelled(live, labels)
        order = F.struct(F.lit(0) if step == 0 else F.xxhash64("v", F.lit(step)), "v", "label", "n")
        hubs = at.groupBy("bucket").agg(F.min(order).alias("hub"), F.min("label").alias("l0"), F.max("label").alias("l1")).where("l0 <> l1").select("bucket", "hub")
        met = lookup_join(at, hubs, ["bucket"], "inner", hot)
        pairs = met.where("label <> hub.label").where(may_be_like("n", "hub.n", like)).select(F.least("v", "hub.v").alias("v"), F.greatest("v", "hub.v").alias("w")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["v", "w"], "left_anti")
        pairs = pin(pairs)
        # A hub has met its whole bucket, and a bucket of one class has nothing left to find.
        live = pin(met.where("v <> hub.v").select("v", "n", "bucket"))
        tried = pairs if tried is None else tried.unionByName(pairs)
        x, y = held.withColumnRenamed("bag", "x"), held.select(F.col("v").alias("w"), F.col("bag").alias("y"))
        found = pin(pairs.join(x, "v").join(y, "w").select("v", "w", "x", "y").mapInArrow(lambda it: check_pairs(it, like), f"v {VERTEX}, w {VERTEX}"))
        if step and found.isEmpty():
            break
        edges = found if edges is None else edges.unionByName(found)
        labels = components(edges)
    rest = pin(all_pairs(live, labels, held, like))
    if not rest.isEmpty():
        edges = edges.unionByName(rest)
        labels = components(edges)
    degree = edges.select(F.explode(F.array("v", "w")).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("links"))
    classed = same.select("a", "b", "v").join(labels, "v", "left").join(degree, "v", "left")
    classed = classed.select("a", "b", F.coalesce("label", "v").alias("label"), F.coalesce("links", F.lit(0)).alias("links"))
    grouped = sketches.where("n > 0").join(classed, ["a", "b"]).select("id", "key", "label", "links")
    alone = sketches.where("n = 0").select("id", "key", F.struct("id", "key").alias("label"), F.lit(0).cast("long").alias("links"))
    return grouped.unionByName(alone).dropDuplicates(["id", "key"]).select(
        "id", "key", F.col("label.id").alias("class_id"), F.col("label.key").alias("class_key"), F.col("links").alias("n_links")
    )


def classify(docs: DataFrame, like: float = LIKE) -> DataFrame:
    """``docs`` with class_id (the least doc_id of the class), n_links and stays, true for the class's first text.

    Old columns of these three names are replaced. A class of rows without id has
    the largest long as its id.
    """
    docs = docs.drop("class_id", "n_links", "stays")
    classes = near_duplicates(docs, like).withColumnsRenamed({"id": "__id", "key": "__key"})
    # The row as one struct: its columns may have any names.
    keyed = docs.select(row_id().alias("__id"), text_key().alias("__key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    stays = (F.col("__id") == F.col("class_id")) & (F.col("__key") == F.col("class_key"))
    joined = keyed.join(classes, ["__id", "__key"])
    return joined.select(*[F.col("row")[c].alias(c) for c in docs.columns], "class_id", "n_links", stays.alias("stays"))
