import numpy as np

from gradewell.llm import queries
from gradewell.llm.neighbours import nearest

SCHEMA = "vec_id long, embedding array<float>, node int, u int, score double"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 0.5) for i, v in rows], SCHEMA)


def ask(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "query_id long")


def plain(rows, ids, k):
    out = []
    for q in ids:
        own = dict(rows)[q]
        found = sorted((-float(np.dot(np.float64(own), np.float64(v))), i) for i, v in rows if i != q)
        out += [(q, r + 1, i, round(-s, 9)) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def result(df):
    return sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in df.collect())


def test_small_tables_are_exact_with_ties(spark):
    draw = np.random.default_rng(1)
    rows = [(i, [float(x) for x in draw.integers(-3, 4, 6)]) for i in range(25)]
    rows = [(i, v) for i, v in rows if any(v)]
    rows += [(100 + i, rows[0][1]) for i in range(30)]  # one very common vector
    assert result(nearest(table(spark, rows), ask(spark, [0, 1, 100]), 20)) == plain(rows, [0, 1, 100], 20)


def test_unusable_vectors_take_no_part(spark):
    good = [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, [0.5, 0.5])]
    bad = [(4, None), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, [1.0]), (None, [1.0, 1.0])]
    assert result(nearest(table(spark, good + bad), ask(spark, [1, 4, 5]), 20)) == plain(good, [1], 20)


def test_empty_table(spark):
    assert nearest(table(spark, []), ask(spark, [1])).count() == 0


def test_recall_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.op7_neighbours(spark, folder).toPandas()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    ids = [i for i, _ in rows if i % 20 == 0]
    want = {(q, i) for q, _, i, _ in plain(rows, ids, 20)}
    found = set(zip(got.query_id, got.vec_id, strict=True))
    assert len(found) == len(want) and len(found & want) >= 0.9 * len(want)
