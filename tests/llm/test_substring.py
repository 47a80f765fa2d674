import hashlib

from llm_helpers import LONG, ODD, PASSAGE, table, words

from gradewell.llm.substring import substring_dedup
from gradewell.llm import substring


def plain(rows, window=20):
    """Removed words by definition; rows without id come last, equal rows share a result."""
    first = {}
    order = sorted({(2**63 - 1 if i is None else i, t) for i, t in rows if t}, key=lambda r: r[0])
    gone = {}
    for i, t in order:
        w = words(t)
        hit = set()
        for s in range(len(w) - window + 1):
            place = (i, s)
            seen = first.setdefault(tuple(w[s : s + window]), place)
            if seen < place:
                hit.update(range(s, s + window))
        gone[i, t] = hit
    out = []
    for i, t in rows:
        w = words(t)
        hit = gone.get((2**63 - 1 if i is None else i, t), set())
        kept = " ".join(x for k, x in enumerate(w) if k not in hit)
        out.append((i, len(w), len(hit), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


def test_odd_rows_match_the_definition(spark):
    assert result(substring_dedup(table(spark))) == sorted(plain(ODD), key=str)


def test_empty_table(spark):
    assert substring_dedup(table(spark, [])).count() == 0


def test_hot_anchors_are_cut_into_windows(spark, monkeypatch):
    monkeypatch.setattr(substring, "HOT", 1)
    rows = [(i, f"{'a ' * i} {PASSAGE} end{i} " + " ".join(f"q{i}x{j}" for j in range(i))) for i in range(12)]
    assert result(substring_dedup(table(spark, rows))) == sorted(plain(rows), key=str)


def test_many_copies_of_one_text(spark):
    rows = [(i, LONG) for i in range(40)] + [(99, LONG + " " + LONG)]
    assert result(substring_dedup(table(spark, rows))) == sorted(plain(rows), key=str)
