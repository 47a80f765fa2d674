"""Approximate nearest neighbours by NN-descent; nearness is the inner product.

Equal vectors are one node, the least id's. The first graph comes from sorted
blocks: nodes are ordered by the signs of random projections, and each run of
``BLOCK`` nodes is compared within itself, in ``TABLES`` orders. Then, in every
round, a node's neighbours and the nodes that have it as a neighbour meet and
are compared where at least one is new to it; each node keeps its ``KEEP`` best.
Meetings take at most ``MEET`` of each sort, by hash, as NN-descent samples
them, so a node that is near to everything brings no more rows than another.
Rounds end when under ``STILL`` of the graph changed.

A query starts from its own node's neighbours and walks the graph: the best
``BEAM`` nodes seen that were not yet opened are opened together, until none of
the best is new. Found nodes stand for all rows with their vector, of which no
result needs more than the least ids.

Left out: null vectors, vectors with null or non-finite parts, zero vectors,
vectors of another length than the commonest (the longer of equals), null ids.
Of rows that repeat an id one vector counts, the least.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradewell.llm.tables import pin

KEEP, MEET, BLOCK, TABLES, ROUNDS, STILL = 32, 20, 256, 3, 10, 0.02
OFFERS, BEAM, STEPS = 5, 120, 6


def matrix(column: pa.Array) -> np.ndarray:
    values = np.asarray(column.flatten(), np.float64)
    return values.reshape(len(column), -1)


def best_of(scores: np.ndarray, k: int) -> np.ndarray:
    k = min(k, scores.shape[1])
    return np.argpartition(-scores, k - 1, axis=1)[:, :k] if k else np.zeros((len(scores), 0), int)


EDGES = "u long, v long, score double"


def edges(u, v, score) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(score, pa.float64())], ["u", "v", "score"])


def compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each sorted run of BLOCK nodes against itself."""
    held = pa.table({})
    for batch in batches:
        held = pa.concat_tables([held, pa.Table.from_batches([batch])]) if held.num_rows else pa.Table.from_batches([batch])
        while held.num_rows >= 2 * BLOCK:  # the last run is up to twice as long
            yield compare(held.slice(0, BLOCK))
            held = held.slice(BLOCK)
    if held.num_rows:
        yield compare(held)


def compare(rows: pa.Table) -> pa.RecordBatch:
    node = np.asarray(rows.column("node"))
    x = matrix(rows.column("vector").combine_chunks())
    scores = x @ x.T
    np.fill_diagonal(scores, -np.inf)
    best = best_of(scores, min(KEEP, len(node) - 1))
    u = np.repeat(np.arange(len(node)), best.shape[1])
    v = best.ravel()
    return edges(node[u], node[v], scores[u, v])


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal keys of a sorted partition, also across batches."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
        keys = np.asarray(table.column(key))
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield table.slice(a, b - a)
        held = table.slice(cuts[-1])
    if held is not None and held.num_rows:
        yield held


def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All members of each meeting against each other; the best offers above a member's worst neighbour."""
    us, vs, ss, waiting = [], [], [], 0
    for rows in groups(batches, "centre"):
        member = np.asarray(rows.column("member"))
        if len(member) < 2:
            continue
        new = np.asarray(rows.column("new"))
        scores = matrix(rows.column("vector").combine_chunks()) @ matrix(rows.column("vector").combine_chunks()).T
        scores[~(new[:, None] | new[None, :])] = -np.inf
        scores[member[:, None] == member[None, :]] = -np.inf
        best = best_of(scores, OFFERS)
        u = np.repeat(np.arange(len(member)), best.shape[1])
        v = best.ravel()
        good = scores[u, v] > np.asarray(rows.column("worst"))[u]
        us.append(member[u[good]])
        vs.append(member[v[good]])
        ss.append(scores[u[good], v[good]])
        waiting += int(good.sum())
        if waiting > 50_000:
            yield edges(np.concatenate(us), np.concatenate(vs), np.concatenate(ss))
            us, vs, ss, waiting = [], [], [], 0
    if waiting:
        yield edges(np.concatenate(us), np.concatenate(vs), np.concatenate(ss))


def keep_best(found: DataFrame, k: int = KEEP) -> DataFrame:
    """The k best different neighbours of each node; an edge is new if every mention of it is."""
    one = found.groupBy("u", "v").agg(F.max("score").alias("score"), F.min("new").alias("new"))
    order = Window.partitionBy("u").orderBy(F.desc("score"), "v")
    return one.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def usable(rows: DataFrame) -> DataFrame:
    """``id`` and ``vector`` of the rows that take part; floats stay floats, sums are always in doubles."""
    kind = "array<float>" if rows.schema["embedding"].dataType.elementType.typeName() == "float" else "array<double>"
    doubles = rows.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast(kind).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    full = doubles.where("id IS NOT NULL AND vector IS NOT NULL").where(finite & F.exists("vector", lambda x: x != 0))
    size = full.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    same = full.where(F.size("vector") == (size["d"] if size else 0))
    return same.groupBy("id").agg(F.min("vector").alias("vector"))


def build_graph(nodes: DataFrame, width: int) -> DataFrame:
    """NN-descent over (node, vector, ...); returns pinned (u, v, score, ...) with at most KEEP rows per u."""
    kind = nodes.schema["vector"].dataType.simpleString()
    planes = np.random.default_rng(7).standard_normal((TABLES, 20, width))
    found = None
    for t in range(TABLES):
        signs = planes[t]

        def coded(batches: Iterator[pa.RecordBatch], signs=signs) -> Iterator[pa.RecordBatch]:
            for b in batches:
                code = ((matrix(b.column("vector")) @ signs.T > 0) << np.arange(20)).sum(1)
                yield pa.RecordBatch.from_arrays([b.column("node"), b.column("vector"), pa.array(code, pa.int64())], ["node", "vector", "code"])

        cut = nodes.select("node", "vector").mapInArrow(coded, f"node long, vector {kind}, code long")
        runs = cut.repartitionByRange("code", "node").sortWithinPartitions("code", "node").select("node", "vector")
        part = runs.mapInArrow(compare_blocks, EDGES)
        found = part if found is None else found.unionByName(part)
    graph = pin(keep_best(found.withColumn("new", F.lit(True))))
    vectors = nodes.select(F.col("node").alias("member"), "vector")
    for step in range(ROUNDS):
        sides = graph.select(F.col("u").alias("centre"), F.col("v").alias("member"), "new", F.lit(0).alias("side"))
        back = graph.select(F.col("v").alias("centre"), F.col("u").alias("member"), "new", F.lit(1).alias("side"))
        order = Window.partitionBy("centre", "side", "new").orderBy(F.xxhash64("centre", "member", F.lit(step)))
        called = sides.unionByName(back).withColumn("n", F.row_number().over(order)).where(F.col("n") <= MEET).select("centre", "member", "new", "side")
        worst = graph.groupBy("u").agg(F.when(F.count(F.lit(1)) >= KEEP, F.min("score")).otherwise(float("-inf")).alias("worst"))
        people = vectors.join(worst, F.col("member") == F.col("u"), "left").select("member", "vector", F.coalesce("worst", F.lit(float("-inf"))).alias("worst"))
        rows = called.groupBy("centre", "member").agg(F.min("new").alias("new")).join(people, "member")
        offers = rows.repartition("centre").sortWithinPartitions("centre").mapInArrow(meet, EDGES)
        # Edges that met this time are no longer new.
        met = called.where("side = 0 AND new").select(F.col("centre").alias("u"), F.col("member").alias("v"), F.lit(True).alias("met"))
        aged = graph.join(met, ["u", "v"], "left").select("u", "v", "score", (F.col("new") & F.col("met").isNull()).alias("new"))
        graph = pin(keep_best(aged.unionByName(offers.withColumn("new", F.lit(True)))))
        total, fresh = graph.agg(F.count(F.lit(1)), F.count_if("new")).first()
        if fresh <= STILL * total:
            break
    return graph


def open_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Score candidate vectors against their query's vector, row by row."""
    for b in batches:
        score = np.einsum("ij,ij->i", matrix(b.column("own")), matrix(b.column("vector")))
        yield edges(np.asarray(b.column("u")), np.asarray(b.column("v")), score)


def search(nodes: DataFrame, graph: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(u, v, score): at least the k best nodes found for each query node ``u``, by greedy graph search."""
    beam = max(BEAM, k)
    links = graph.select(F.col("u").alias("at"), F.col("v").alias("to"))
    vectors = nodes.select(F.col("node").alias("v"), "vector")
    own = queries.join(nodes.select(F.col("node").alias("u"), F.col("vector").alias("own")), "u")
    start = graph.join(queries, "u").select("u", "v", "score", F.lit(False).alias("opened"))
    pool = pin(start)
    for _ in range(STEPS):
        order = Window.partitionBy("u").orderBy(F.desc("score"), "v")
        ranked = pool.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= 2 * beam)
        todo = ranked.where(~F.col("opened") & (F.col("rank") <= beam)).select("u", F.col("v").alias("at"))
        fresh = todo.join(links, "at").select("u", F.col("to").alias("v")).where("u <> v").distinct().join(pool.select("u", "v"), ["u", "v"], "left_anti")
        scored = fresh.join(vectors, "v").join(own, "u").select("u", "v", "own", "vector").mapInArrow(open_nodes, EDGES)
        seen = ranked.select("u", "v", "score", (F.col("opened") | (F.col("rank") <= beam)).alias("opened"))
        pool = pin(seen.unionByName(scored.withColumn("opened", F.lit(False))))
        order = Window.partitionBy("u").orderBy(F.desc("score"), "v")
        better = pool.withColumn("rank", F.row_number().over(order)).where(~F.col("opened") & (F.col("rank") <= beam))
        if better.isEmpty():
            break
    return pool.select("u", "v", "score")


def nearest(rows: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest rows of each id in ``queries`` (query_id), itself left out."""
    taking = pin(usable(rows))
    first = taking.first()
    width = len(first["vector"]) if first else 1
    by_vector = taking.groupBy("vector").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"))
    nodes = pin(by_vector.repartition("node"))
    graph = build_graph(nodes, width)
    rows_of = taking.join(nodes.select("vector", "node"), "vector").select("id", "node")
    place = Window.partitionBy("node").orderBy("id")
    few = pin(rows_of.withColumn("n", F.row_number().over(place)).where(F.col("n") <= k + 1).select(F.col("node").alias("v"), "id"))
    asked = pin(queries.join(rows_of, F.col("query_id") == F.col("id")).select("query_id", F.col("node").alias("u")))
    asked_nodes = asked.select("u").distinct()
    found = search(nodes, graph, asked_nodes, k)
    itself = nodes.join(asked_nodes, F.col("node") == F.col("u")).select("u", F.col("node").alias("v"), F.aggregate("vector", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double")).alias("score"))
    order = Window.partitionBy("u").orderBy(F.desc("score"), "id")
    per_node = found.unionByName(itself).join(few, "v").withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    answers = asked.join(per_node.select("u", F.col("id").alias("vec_id"), "score"), "u").where("query_id <> vec_id")
    return answers.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
