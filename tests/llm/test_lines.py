from llm_helpers import LONG, ODD, table, words

from gradewell.llm.lines import SHORTEST, line_dedup


def near(a, b):
    """Equal, or within one word put in, left out or replaced."""
    if a == b:
        return True
    if min(len(a), len(b)) < SHORTEST or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    longer, shorter = (a, b) if len(a) > len(b) else (b, a)
    return any(longer[:i] + longer[i + 1 :] == shorter for i in range(len(longer)))


def plain(rows):
    places = []
    for i, t in {(2**63 - 1 if i is None else i, t or "") for i, t in rows}:
        places += [((i, p), words(line)) for p, line in enumerate(t.split("\n"))]
    places.sort(key=lambda x: x[0])
    gone = set()
    for n, (at, w) in enumerate(places):
        if w and any(at > other and near(w, v) for other, v in places[:n]):
            gone.add(at)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        key = 2**63 - 1 if i is None else i
        kept = [x for p, x in enumerate(lines) if (key, p) not in gone]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def result(df):
    return sorted(((r.doc_id, r.n_lines, r.n_removed, r.kept_text) for r in df.collect()), key=str)


BASE = [f"t{i}" for i in range(12)]


def variants():
    rows = [(50, " ".join(BASE))]
    for i in range(12):
        rows.append((60 + i, " ".join([*BASE[:i], "new", *BASE[i + 1 :]])))
        rows.append((80 + i, " ".join([*BASE[:i], *BASE[i + 1 :]]) + "\nown line of words " + str(i)))
        rows.append((10 + i, " ".join([*BASE[:i], "put", *BASE[i:]])))
    return [*rows, (120, "x x x x x x x x x"), (121, "x x x x x x x x"), (122, "x x x x x x x y x\n\nx x\nx x")]


def test_every_single_edit_is_found(spark):
    rows = variants()
    assert result(line_dedup(table(spark, rows))) == sorted(plain(rows), key=str)


def test_odd_rows(spark):
    assert result(line_dedup(table(spark, ODD))) == sorted(plain(ODD), key=str)


def test_copies_and_columns_stay(spark):
    rows = [(i, "head\n" + LONG + f"\nline {i}") for i in range(30)]
    done = line_dedup(table(spark, rows))
    assert result(done) == sorted(plain(rows), key=str)
    assert set(done.columns) == {*table(spark).columns, "n_lines", "n_removed", "kept_text"}


def test_empty_table(spark):
    assert line_dedup(table(spark, [])).count() == 0
