import random
from collections import Counter

import numpy as np
from llm_helpers import LONG, ODD, table, words

from gradewell.llm.minhash import BANDS, ROWS, classify, overlap, overlaps, signatures


def bag(text):
    w = words(text)
    n = min(5, len(w))
    return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else Counter()


def similarity(a, b):
    shared = sum((a & b).values())
    return shared / (sum(a.values()) + sum(b.values()) - shared)


def plain(rows, like=0.8):
    """Class of each row: components of pairs at ``like`` or more; rows without words are alone."""
    bags = [bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = rows[i] == rows[j]
            if same or bags[i] and bags[j] and similarity(bags[i], bags[j]) >= like:
                parent[root(i)] = root(j)
    ids = [2**63 - 1 if i is None else i for i, _ in rows]
    least = {}
    for n in range(len(rows)):
        r = root(n)
        least[r] = min(least.get(r, ids[n]), ids[n])
    return sorted((ids[n], least[root(n)]) for n in range(len(rows)))


def result(df):
    return sorted((2**63 - 1 if r.doc_id is None else r.doc_id, r.class_id) for r in df.collect())


def test_odd_rows(spark):
    done = classify(table(spark))
    assert result(done) == plain(ODD)
    assert set(done.columns) == {*table(spark).columns, "class_id", "n_links", "stays"}


def test_edited_copies_match_brute_force(spark):
    draw = random.Random(4)
    rows = []
    for g in range(25):
        base = [f"g{g}w{draw.randint(0, 80)}" for _ in range(draw.randint(3, 150))]
        rows.append((g * 100, " ".join(base)))
        for c in range(draw.randint(0, 6)):
            w = list(base)
            for _ in range(draw.randint(0, 5)):
                w[draw.randrange(len(w))] = f"new{draw.randint(0, 9999)}"
            rows.append((g * 100 + c + 1, " ".join(w)))
    draw.shuffle(rows)
    done = classify(table(spark, rows)).collect()
    assert sorted((r.doc_id, r.class_id) for r in done) == plain(rows)
    stays = [r for r in done if r.stays]
    assert sorted(r.doc_id for r in stays) == sorted({c for _, c in plain(rows)})


def test_large_group_of_near_copies(spark):
    base = LONG.split(" ")[:300]
    rows = [(i, " ".join([*base[:i], f"edit{i}", *base[i + 1 :]])) for i in range(120)]
    assert {c for _, c in result(classify(table(spark, rows)))} == {0}


def template(draw, n, pairs):
    """``n`` texts of one template, about 0.6 like each other, and a copy at about 0.85 of the first ``pairs``."""
    base = [f"t{i}" for i in range(160)]
    rows = []
    for g in range(n):
        w = list(base)
        w[60:96] = [f"g{g}w{i}" for i in range(36)]
        rows.append((g, " ".join(w)))
        if g < pairs:
            at = draw.choice([10, 110, 140])
            w[at : at + 8] = [f"c{g}w{i}" for i in range(8)]
            rows.append((1000 + g, " ".join(w)))
    return rows


def test_copies_among_many_texts_of_one_template(spark):
    rows = template(random.Random(8), 600, 40)
    bags = [bag(t) for _, t in rows]
    assert 0.55 < similarity(bags[0], bags[2]) < 0.7 and 0.8 < similarity(bags[0], bags[1]) < 0.9
    done = classify(table(spark, rows)).collect()
    assert sorted((r.doc_id, r.class_id) for r in done) == plain(rows)
    assert sum(r.stays for r in done) == 600 and sum(r.n_links for r in done) == 80


def test_overlaps_equal_single_overlaps():
    draw = np.random.default_rng(5)
    made = [np.sort(draw.integers(0, 40, n).astype(np.uint64) << np.uint64(9)).tobytes() for n in (1, 30, 90, 200, 7)]
    assert np.allclose(overlaps(made, made[:3]), [[overlap(x, y) for y in made[:3]] for x in made])


def test_signatures_estimate_weighted_jaccard():
    draw = np.random.default_rng(3)
    items = draw.integers(0, 2**63, 60).astype(np.uint64)
    a, b = draw.integers(0, 6, 60), draw.integers(0, 6, 60)
    document = np.concatenate((np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)))
    best = signatures(document, np.concatenate((items[a > 0], items[b > 0])), np.concatenate((a[a > 0], b[b > 0])), 2, 4000)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((best[0] == best[1]).mean() - true) < 0.03
    assert BANDS * ROWS == 120


def test_empty_table(spark):
    assert classify(table(spark, [])).count() == 0
