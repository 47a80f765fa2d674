import hashlib

import pytest
import xxhash
from llm_helpers import ODD, table

from gradewell.llm.fingerprint import K, fingerprint_edited


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def spark_hash_long(value, seed):
    return xxhash.xxh64_intdigest((value % 2**64).to_bytes(8, "little"), seed=seed % 2**64)


def sketch(text):
    words = [w for w in __import__("re").split(r"[\x09-\x0D\x20]+", text) if w]
    hashes = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in words]
    made = set()
    for i in range(max(len(hashes) - 4, 1) if hashes else 0):
        run = 42
        for j in range(5):
            run = spark_hash_long(hashes[i + j], run) if i + j < len(hashes) else spark_hash_long(0, run)
        made.add(signed(run))
    return sorted(made)[:K]


def likeness(a, b):
    both = sorted(set(a) | set(b))[:K]
    return len(set(both) & set(a) & set(b)) / len(both) if both else 1.0


def test_matches_the_definition(spark):
    rows = [r for n, r in enumerate(ODD) if r[0] is not None and r not in ODD[:n]]
    order = sorted(rows, reverse=True, key=lambda r: r[0])
    got = {r.doc_id: r for r in fingerprint_edited(table(spark, rows)).collect()}
    assert len(got) == len(rows)
    for n, (i, text) in enumerate(order):
        text, after = text or "", order[(n + 1) % len(order)][1] or ""
        tail = len(text) // 3
        edited = text[: len(text) - tail] + after[:tail]
        r = got[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == "".join(f"{x % 2**64:016x}" for x in sketch(text))
        assert r.edited_fingerprint == "".join(f"{x % 2**64:016x}" for x in sketch(edited))
        assert r.near_edited == pytest.approx(likeness(sketch(text), sketch(edited)))
        assert r.near_next == pytest.approx(likeness(sketch(text), sketch(after)))


def test_all_rows_stay_and_equal_texts_agree(spark):
    rows = fingerprint_edited(table(spark)).collect()
    assert len(rows) == len(ODD)
    same = [r.fingerprint for r in rows if r.doc_id == 6]
    assert len(same) == 2 and len(set(same)) == 1
    nameless = next(r for r in rows if r.doc_id is None)
    assert nameless.near_next == 0


def test_empty_and_single_row(spark):
    assert fingerprint_edited(table(spark, [])).count() == 0
    one = fingerprint_edited(table(spark, [(1, "a b c d e f g h i")])).collect()
    assert one[0].near_next == 1
