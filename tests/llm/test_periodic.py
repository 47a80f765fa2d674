import hashlib
import random
import zlib
from fractions import Fraction

from llm_helpers import ODD, table, words

from gradewell.llm import queries
from gradewell.llm.periodic import collapse, find_runs, periodic_runs


def brute(found, least, repeats):
    """All runs by trying every period at every place."""
    n, out = len(found), set()
    for p in range(1, n // repeats + 1):
        i = 0
        while i + p < n:
            if found[i] != found[i + p]:
                i += 1
                continue
            start = i
            while i + p < n and found[i] == found[i + p]:
                i += 1
            end = i + p
            smaller = any(q < p and p % q == 0 and (a, b) == (start, end) for a, b, q in out)
            if end - start >= max(least, repeats * p) and not smaller:
                out.add((start, end, p))
    return sorted(((a, b - a, p) for a, b, p in out), key=lambda r: (r[0], r[2]))


def test_random_words_against_brute_force():
    random.seed(11)
    for _ in range(300):
        texts = []
        for _ in range(random.randint(1, 5)):
            n, letters = random.randint(0, 130), "abcd"[: random.randint(1, 4)]
            made = [random.choice(letters) for _ in range(n)]
            if n and random.random() < 0.6:
                a = random.randrange(n)
                p = 1 + (n - a) // random.randint(2, 9)
                made = [made[i] if i < a else made[a + (i - a) % p] for i in range(n)]
            texts.append(" ".join(made).encode())
        least, repeats = random.choice([(24, 3), (4, 2), (1, 2), (6, 3), (10, 4)])
        split, runs = find_runs(texts, least, repeats)
        for w, r in zip(split, runs, strict=True):
            assert r == brute(w, least, repeats)


def test_one_word_many_times():
    _, runs = find_runs([b"a " * 50_000, b"a b " * 30 + b"c"])
    assert runs == [[(0, 50_000, 1)], [(0, 60, 2)]]


def planted(doc_id, text):
    """The rule of the query, in plain Python."""
    found, h = words(text), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not found:
        return found
    g, n = h // 10, len(found)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [found[i] if i < a else found[a + (i - a) % p] for i in range(n)]


def digest(parts):
    return hashlib.sha256(parts.encode()).hexdigest()


def test_query_against_brute_force(spark, tmp_path):
    random.seed(5)
    rows = [r for r in ODD if len(words(r[1])) < 400]
    rows += [(i, " ".join(random.choice(["éa", "b", "c", "d"]) for _ in range(random.randint(0, 90)))) for i in range(20, 120)]
    rows += [(200, "x y z " * 30), (201, "x y z " * 30), (202, "a " * 23), (203, "a " * 24 + "\tb\n" + "b " * 40)]
    table(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op11_periodic_runs(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    want = []
    for doc_id, text in rows:
        found = planted(doc_id, text)
        runs = brute(found, 24, 3)
        kept = collapse(found, runs)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        exponent = None if best is None else 1000 * best[1] // best[2]
        want.append((doc_id, len(runs), *(best or (None, None, None)), exponent, digest(lines), digest(" ".join(kept))))
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == sorted(want, key=repr)
    assert sum(w[1] for w in want) > 5


def test_odd_rows_and_empty_table(spark):
    got = periodic_runs(table(spark)).collect()
    assert len(got) == len(ODD)
    assert sorted(r.n_words for r in got) == sorted(len(words(t)) for _, t in ODD)
    assert next(r for r in got if r.doc_id == 4).runs == [(0, 28, 2)]
    assert all(r.runs == [] for r in got if r.doc_id != 4)
    assert periodic_runs(table(spark, [])).count() == 0
