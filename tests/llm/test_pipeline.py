"""Every stage, and the whole run, beside a plain version on a small table."""

import math
from collections import defaultdict

import corpus_pipeline
import pytest
import test_lines
import test_minhash
import test_private
from test_packing import ids_of
from llm_helpers import LONG, ODD

from gradewell.llm import private, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __gone int, class_id int, __id int, score string"
PROSE = [f"Topic{i} begins here with plain words number{i} about matter{i} and thing{i}.\nSecond{i} line{i} goes on{i} for{i} some{i} more{i} words{i} too{i}." for i in range(40)]
RUDE = [f"Opening{i} part{i} text{i} stands{i}.\nyou are a blarg and such grobble number{i}, you blarg" for i in range(30)]


def rows():
    out = [(1000 + i, t) for i, t in enumerate(PROSE)] + [(2000 + i, t) for i, t in enumerate(RUDE)]
    whole = " ".join(f"common{i}" for i in range(120))
    out += [(3000 + i, whole.replace(f"common{7 + i} ", f"edit{i} ")) for i in range(4)]
    out += [(3100, PROSE[3]), (3101, PROSE[4] + "\nOwn tail line of this one document only here"), (3200, "write to jane.x@mail.example or call +49 (30) 1234567, at 10.0.0.7 today")]
    out += [(3300, LONG), (3300, LONG), (3400, None), (3401, ""), (3402, "line one here\n\nline two here")]
    return [*ODD, *out]


def docs_of(spark, given):
    made = [(i, t, "en", f"s{(i or 0) % 3}", len(t or ""), 1, 2, 3, "x") for i, t in given]
    return spark.createDataFrame(made, SCHEMA)


@pytest.fixture(scope="module")
def place(spark, tmp_path_factory):
    place = tmp_path_factory.mktemp("pipeline")
    docs_of(spark, rows()).write.parquet(str(place / "documents.parquet"))
    known = [(1000 + i, 0) for i in range(40)] + [(2000 + i, 1) for i in range(30)] + [(None, 1), (1001, None)]
    spark.createDataFrame([(i, 1, t) for i, t in known], "doc_id long, quality int, toxic int").write.parquet(str(place / "labels.parquet"))
    return str(place)


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def plain_toxic(spark, given, place):
    docs, labels = docs_of(spark, given), spark.read.parquet(f"{place}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels)
    scorer = toxicity.Scorer(model.lexicon)

    def score(text):
        return 1 / (1 + math.exp(-sum(w * x for w, x in zip(model.weights, scorer.features(text or ""), strict=True))))

    return [(i, t) for i, t in given if score(t) < corpus_pipeline.REJECT]


def plain_lines(given):
    out = []
    for (i, text), (_, _, removed, kept) in zip(given, test_lines.plain(given), strict=True):
        if removed == 0 or kept.strip(" "):
            out.append((i, None if text is None else kept))
    return out


def plain_copies(given):
    classes = defaultdict(set)
    ids = [2**63 - 1 if i is None else i for i, _ in given]
    # Classes by row: the plain version gives (id, class) pairs, and the earliest id of a class stays.
    for doc, cls in set(test_minhash.plain(given)):
        classes[cls].add(doc)
    heads = {min(members) for members in classes.values()}
    kept = {(i, t) for (i, t), n in zip(given, ids, strict=True) if n in heads and (n, n) in set(test_minhash.plain(given))}
    return sorted(kept, key=repr)


def plain_mask(given):
    out = []
    for i, t in given:
        done, parts = 0, []
        for a, k, b in test_private.plain(t or ""):
            if a >= done:
                parts += [(t or "")[done:a], f"[{private.KINDS[k]}]"]
            done = max(done, b)
        out.append((i, None if t is None else "".join([*parts, t[done:]])))
    return out


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near duplicates", "personal data", "packing"]


def test_toxicity(spark, place):
    docs = docs_of(spark, rows())
    got = stage("toxicity")(spark, docs, place)
    assert got.columns == docs.columns
    want = plain_toxic(spark, rows(), place)
    assert texts(got) == sorted(want, key=repr)
    gone = {i for i, _ in rows()} - {i for i, _ in want}
    # Document 4 says nothing but "a" and "b", and "a" stands in every rude text of the labels.
    assert set(range(2000, 2030)) <= gone <= {4, *range(2000, 2030)}, gone


def test_line_dedup(spark, place):
    docs = docs_of(spark, rows())
    got = stage("line dedup")(spark, docs, place)
    assert got.columns == docs.columns
    assert texts(got) == sorted(plain_lines(rows()), key=repr)
    assert all(r.n_chars == len(r.text or "") for r in got.collect())


def test_near_duplicates(spark, place):
    docs = docs_of(spark, rows())
    got = stage("near duplicates")(spark, docs, place)
    assert got.columns == docs.columns
    assert texts(got) == plain_copies(rows())
    assert [i for i, _ in texts(got)].count(3300) <= 1


def test_personal_data(spark, place):
    docs = docs_of(spark, rows())
    got = stage("personal data")(spark, docs, place)
    assert got.columns == docs.columns
    assert texts(got) == sorted(plain_mask(rows()), key=repr)
    assert any("[email]" in (t or "") and "[phone]" in t and "[ip]" in t for _, t in texts(got))


def packed_ids(rows):
    out = defaultdict(list)
    for r in rows:
        out[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    return {i: sorted(p) for i, p in out.items()}


def plain_pieces(given):
    import zlib

    import numpy as np

    out = defaultdict(list)
    for i, t in given:
        ids = ids_of(t)
        for p, a in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[a : a + 4096], "<u4")
            out[i].append((p, a, len(part), zlib.crc32(part.tobytes())))
    return {i: sorted(p) for i, p in out.items()}


def sequences_are_sound(rows):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def test_packing(spark, place):
    got = stage("packing")(spark, docs_of(spark, rows()), place).collect()
    assert packed_ids(got) == plain_pieces(rows())
    sequences_are_sound(got)


def test_run(spark, place):
    given = plain_mask(plain_copies(plain_lines(plain_toxic(spark, rows(), place))))
    got = corpus_pipeline.run(spark, place).collect()
    assert packed_ids(got) == plain_pieces(given)
    sequences_are_sound(got)
    assert len({i for i, _ in given}) > 30


def test_empty_tables(spark, place):
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, docs_of(spark, []), place).count() == 0
