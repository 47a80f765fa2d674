import random

import pytest
from llm_helpers import ODD, table

from gradewell.llm import queries
from gradewell.llm.toxicity import CLASSES, INSULT, NEGATION, OTHER, REPORT, TARGET, THREAT, Scorer, fit, score


LEXICON = {"blarg": 2.0, "grob": 3.0}


def plain_score(words):
    """A clause's score from the words before each insult or threat, part by part."""

    def kind(w):
        return CLASSES.get(w, INSULT if w in LEXICON else OTHER)

    total = 0.0
    for i, w in enumerate(words):
        if kind(w) not in (INSULT, THREAT):
            continue
        weight = 2.0 if kind(w) == THREAT else LEXICON[w]
        before = lambda c, n: c in [kind(x) for x in words[max(i - n, 0) : i]]  # noqa: B023, E731
        weight *= 1.75 if before(TARGET, 4) else 1
        weight *= 1.25 if before(INSULT, 6) else 1
        weight *= 1.5 if before(THREAT, 4) else 1
        weight *= 0.1 if before(NEGATION, 3) else 1
        weight *= 0.1 if before(REPORT, len(words)) else 1
        total += weight
    return total


def test_clause_scores_equal_a_plain_reading():
    draw, s = random.Random(9), Scorer(LEXICON)
    letters = ["blarg", "grob", "you", "not", "isn't", "said", "kill", "word", "other", "more"]
    for _ in range(400):
        words = [draw.choice(letters) for _ in range(draw.randint(0, 14))]
        assert s.emit(words) == pytest.approx(plain_score(words))


def test_grammar_weighs_context():
    s = Scorer({"blarg": 2.0})
    total = lambda text: s.features(text)[2]
    alone = total("a blarg thing")
    assert total("you blarg thing") > alone > total("this is not blarg") > 0
    assert total("he said that it was blarg") < total("that it was blarg")
    assert total("nothing here") == 0
    # A report reaches over a colon, and an apostrophe does not part a negation.
    assert total("she wrote: you are blarg") == total("she wrote you are blarg") < alone
    assert total("you aren\u2019t blarg") == total("you aren't blarg") < alone
    assert s.clauses("one blarg. two! not blarg; four\nyou blarg")[1] == 5


def test_quoted_and_negated_insults_are_clean(spark):
    """A model that learned insults of toxic texts leaves alone who only reports or denies them."""
    plain = [f"words of day{i} go on and the road{i} is long{i}. nothing more{i} here{i}" for i in range(120)]
    docs = [(i, t + (". you blarg, you utter blarg" if i % 3 == 0 else "")) for i, t in enumerate(plain)]
    cases = ["you blarg", "she wrote: you are blarg", "she said you are blarg", "you are not blarg", "you aren't blarg and isn't blarg"]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)], "doc_id long, toxic int")
    known = table(spark, docs)
    asked = table(spark, [(1000 + i, f"words of day go on. {t}") for i, t in enumerate(cases)])
    got = {r.doc_id - 1000: r.score for r in score(asked, fit(known, labels)).collect()}
    assert got[0] >= 0.5 and all(got[i] < 0.5 for i in range(1, len(cases))), got


def test_odd_rows_and_columns(spark):
    docs = table(spark, [*ODD, *((100 + i, "calm words here " * 3 + ("blarg you" if i % 3 == 0 else "fine")) for i in range(60))])
    labels = spark.createDataFrame([(100 + i, int(i % 3 == 0)) for i in range(60)] + [(100, 1), (None, 1), (4, None), (7777, 0)], "doc_id long, toxic int")
    rows = score(docs, fit(docs, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    got = {r.doc_id: r.score for r in rows}
    assert all((got[100 + i] >= 0.5) == (i % 3 == 0) for i in range(60)) and got[2] == got[3] < 0.5


@pytest.mark.parametrize("known", [[], [(1, 0)], [(1, 1)]])
def test_labels_of_one_kind(spark, known):
    docs = table(spark)
    labels = spark.createDataFrame(known, "doc_id long, toxic int")
    assert all(0 <= r.score < 0.5 for r in score(docs, fit(docs, labels)).collect())
    assert score(table(spark, []), fit(table(spark, []), labels)).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.op5_toxicity(spark, folder).where("held_out")
    both = got.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").toPandas()
    assert (both.predicted == both.toxic).mean() >= 0.93
    rank, toxic = both.score.rank(), both.toxic == 1
    n = toxic.sum()
    assert (rank[toxic].sum() - n * (n + 1) / 2) / (n * (len(both) - n)) >= 0.8
