import hashlib
import random
import re

import pytest
from llm_helpers import ODD, table

from gradewell.llm.private import KINDS, base_spans, find, find_private, luhn, mask_spans, near_key, sample
from gradewell.llm.tables import row_id, text_key

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for k, kind in enumerate(KINDS):
        for m in re.finditer(PATTERNS[kind], text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


@pytest.mark.parametrize("letters", ["a1.@- +2", "0123456789.- +()", "ab@.-1é"])
def test_base_spans_match_the_patterns(letters):
    draw = random.Random(letters)
    for _ in range(3000):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 45)))
        assert base_spans(text) == plain(text), text


CARD = "4539 1488 0343 6467"
TEXT = f"pay {CARD} now, mail jo.12@x.example.com, then {'filler ' * 30}4539148803436467 and jo.12 again, call +1 (555) 010-2030 or 15550102030"


def test_spans_keep_the_base_and_reach_bare_repeats(spark):
    rows = [*ODD, *((100 + i, TEXT.replace("jo.12", f"jo.{12 + i}")) for i in range(30))]
    got = {(r.doc_id): r for r in find_private(table(spark, rows)).collect()}
    assert len(got) <= len(rows)
    for i, text in rows[len(ODD) :]:
        r = got[i]
        base = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in plain(text))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) <= set(r.spans.split(","))
        bare = text.rindex("15550102030")
        assert f"phone:{bare}:{bare + 11}" in r.spans.split(",")
    assert got[2].spans == "" and got[3].n_email == 0


def test_names_without_digits_and_similar_tokens_are_reached(spark):
    text = "write jane.doe{0}@x.example.com; later jane.doe{0} signs, jane_doe{0} too; call +1 (555) 010-2{1}, or 5550102{1}, or 010 2{1}; the word jane stays"
    rows = [(100 + i, text.format("abcdefghij"[i % 10] * (i // 10 + 1), 100 + i)) for i in range(40)]
    found = {r.doc_id: r.spans.split(",") for r in find_private(table(spark, rows)).collect()}
    hits = {"plain": 0, "similar": 0, "phone": 0}
    for i, t in rows:
        name = t[6 : t.index("@")]
        bare, like = t.index(name, t.index("later")), t.index(name.replace(".", "_"))
        hits["plain"] += f"email:{bare}:{bare + len(name)}" in found[i]
        hits["similar"] += f"email:{like}:{like + len(name)}" in found[i]
        digits = t.index(", or 555") + 5
        hits["phone"] += f"phone:{digits}:{digits + 10}" in found[i]
        assert not any(int(x.split(":")[1]) >= t.index("the word") for x in found[i])
    assert hits["plain"] == len(rows) and hits["phone"] == len(rows), hits
    assert near_key("5550102100") == near_key("150102100")[-7:] and near_key("@jane_doe") == near_key("@jane.doe4")


def test_training_takes_units_from_all_of_a_text(spark):
    far = "filler " * 4000 + TEXT
    rows = sample(find(table(spark, [(1, TEXT * 60 + far)])), 40)
    starts = [u["start"] for r in rows for u in r]
    assert len(starts) == 40 and max(starts) > 50 * len(TEXT)


def test_masks(spark):
    docs = table(spark, [(1, TEXT), (2, None), (3, "")])
    found = find_private(docs).join(docs.select("doc_id", row_id().alias("id"), text_key().alias("key")), "doc_id")
    texts = {r.doc_id: r.text for r in mask_spans(docs, found.select("id", "key", "spans")).collect()}
    assert "[card]" in texts[1] and "[email]" in texts[1] and "[phone]" in texts[1] and "0343" not in texts[1].split("filler")[0]
    assert texts[2] is None and texts[3] == ""


def test_empty_table(spark):
    assert find_private(table(spark, [])).count() == 0
