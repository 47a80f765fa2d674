import math
import random
import re
from collections import Counter

import pytest
from compare import connect, difference
from llm_helpers import LONG, ODD, table

from gradewell.llm import queries, ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, top=20):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in rows]
    n_docs, n_terms = sum(n > 0 for _, _, n in held), sum(n for _, _, n in held)
    df = Counter(w for _, c, _ in held for w in c)
    weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for w, n in df.items()}
    out = []
    for item, text in items:
        scored = []
        for doc_id, count, n in held:
            m = 75 + (25 * n * n_docs) // max(n_terms, 1)
            score = sum(weight[w] * ((10**9 * count[w]) // (1000 * count[w] + 12 * m)) for w in terms(text) if w in count)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        best = sorted(scored)[:top]
        out += [(item, rank + 1, doc_id, -score) for rank, (score, _, doc_id) in enumerate(best)]
    return sorted(out, key=repr)


def items_table(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "item_id long, text string, item long, term string")


def found(spark, rows, items, top=20):
    got = ranked.search(table(spark, rows), items_table(spark, items), top)
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got.collect()), key=repr)


ITEMS = [(1, "P3 p4 p5 p29 w7"), (2, "a a b"), (3, None), (4, ""), (5, "Éü 世界 ñ"), (6, "nowhere at all"), (7, LONG), (7, "p1 P1")]


def test_odd_rows(spark):
    assert found(spark, ODD, ITEMS) == brute(ODD, ITEMS)


@pytest.fixture(scope="module")
def many():
    """A common word, rare words, a third of the rows copies of one text, more rows than a block."""
    random.seed(3)
    vocabulary = [f"v{i}" for i in range(300)]
    likely = [1 / (i + 1) for i in range(300)]
    rows = [(i, " ".join(["the", *random.choices(vocabulary, likely, k=random.randint(0, 40))])) for i in range(3000)]
    copy = rows[7][1] + " v250 v251"
    rows += [(10_000 + i, copy) for i in range(1500)]
    items = [(i, " ".join(["the", *random.choices(vocabulary, likely, k=12)])) for i in range(300)]
    return rows, items + [(999, copy)]


@pytest.mark.parametrize("top", [1, 20])
def test_many_rows_blocks_and_bundles(spark, many, top):
    rows, items = many
    docs = table(spark, rows).repartition(2)
    got = ranked.search(docs, items_table(spark, items).coalesce(1), top)
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got.collect()), key=repr) == brute(rows, items, top)


def test_empty_tables(spark):
    assert found(spark, [], ITEMS) == []
    assert found(spark, ODD, []) == []
    assert found(spark, [(1, None), (2, " ")], ITEMS) == []


def test_query_equals_sql(spark, folder):
    got = queries.op12_ranked_search(spark, folder).toPandas()
    assert difference(got, connect(folder).execute(queries.SQL["op12_ranked_search"]).df()) is None
