"""Toxicity by a weighted grammar of finite-state transducers over clauses.

Words are read as classes: insult (with a weight), threat, target, negation,
report, other. Small transducers each change the weight of a clause's insults
and threats: a target close by raises it, a negation shortly before takes most of it
away, and so does reported speech for all that follows. They are composed into one
machine whose states are tuples of theirs; a clause's score is the weight that the
machine emits on its way. Clauses end at . ! ? ; and line breaks; a colon or comma
ends none, so a report reaches what it introduces.

All features of a text are made of its clause scores: their sum, the largest, the number
of clauses that match (score at least ``MATCH``) and their share. No word counts
by itself: a negated or quoted insult counts as little as its clause does.

What is an insult is learned: for labelled texts, words and word beginnings are
counted by document, and those with a high lower bound of their log odds enter
the lexicon, the ``LEXICON`` strongest at most; that bound is a parameter. A logistic
model over the features turns them into a probability. Training takes at most
``TRAIN_ROWS`` labelled rows, by smallest id hashes; that bound is a parameter too.
Language, source, ids and labels feed no score.

A null or empty text has no clause and gets the model's score of nothing.
Repeated rows and null ids are scored as they are; labels whose document is
missing, or null, are left out; repeated labels of an id count once, the larger
one. Without labels of both kinds every score is near 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradewell.llm.text import light_batches

TRAIN_ROWS, LEXICON, LEAST_DOCS, LEAST_WEIGHT = 20_000, 3_000, 4, 1.5
STEMS = (4, 5, 6, 7)
WORD = re.compile(r"[^\W\d_]+(?:['\u2019][^\W\d_]+)*")
CLAUSE = re.compile(r"[.!?;\n]+")
# Least score of a clause that matches; words whose class a worker keeps at a time.
MATCH, KNOWN_WORDS = 1.0, 100_000
RIDGE = 0.1
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
# Function words of the four languages.
TARGETS = "you your yours u he she they him her them du dich dein ihr euch tu te toi vous ton ta tes tú ti usted ustedes él ella ellos".split()
NEGATIONS = "not never no isn't ain't aren't wasn't weren't nicht kein keine nie ne pas jamais nunca tampoco".split()
REPORTS = "said says wrote called quote quoted reported claims sagte schrieb nannte dit disait écrit dijo decía escribió".split()
THREATS = "kill hurt destroy beat burn shoot töten umbringen schlagen tuer frapper détruire matar golpear destruir".split()
CLASSES = {**dict.fromkeys(TARGETS, TARGET), **dict.fromkeys(NEGATIONS, NEGATION), **dict.fromkeys(REPORTS, REPORT), **dict.fromkeys(THREATS, THREAT)}

# A transducer: start state, and (state, class) -> (next state, factor on the emitted weight).
Transducer = tuple[int, dict[tuple[int, int], tuple[int, float]]]


def window(opener: int, length: int, factor: float) -> Transducer:
    """For ``length`` words after an opener, insults and threats count ``factor`` times."""
    arcs = {}
    for state in range(length + 1):
        for c in range(6):
            arcs[state, c] = (length if c == opener else max(state - 1, 0), factor if state and c in (INSULT, THREAT) else 1.0)
    return 0, arcs


def onward(opener: int, factor: float) -> Transducer:
    """After an opener, everything to the clause's end counts ``factor`` times."""
    arcs = {(s, c): (1 if s or c == opener else 0, factor if s and c in (INSULT, THREAT) else 1.0) for s in (0, 1) for c in range(6)}
    return 0, arcs


def compose(a: Transducer, b: Transducer) -> Transducer:
    """One machine that runs both on the same words; factors multiply. Only states that can be reached are made."""
    number = {(a[0], b[0]): 0}
    arcs: dict[tuple[int, int], tuple[int, float]] = {}
    todo = [(a[0], b[0])]
    while todo:
        pair = todo.pop()
        for c in range(6):
            (x, f), (y, g) = a[1][pair[0], c], b[1][pair[1], c]
            if (x, y) not in number:
                number[x, y] = len(number)
                todo.append((x, y))
            arcs[number[pair], c] = (number[x, y], f * g)
    return 0, arcs


# The parts of the grammar: what a word of a class does to insults and threats after it.
PARTS = (
    window(TARGET, 4, 1.75),
    window(INSULT, 6, 1.25),
    window(THREAT, 4, 1.5),
    window(NEGATION, 3, 0.1),
    onward(REPORT, 0.1),
)


def grammar() -> Transducer:
    machine = PARTS[0]
    for part in PARTS[1:]:
        machine = compose(machine, part)
    return machine


FEATURES = 5


class Scorer:
    """Clause scores of texts under a lexicon of word and stem weights."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.start, self.arcs = grammar()
        self.known: dict[str, tuple[int, float]] = {}

    def read(self, word: str) -> tuple[int, float]:
        """Class and weight of a lower-case word: itself, else its heaviest beginning."""
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        got = CLASSES.get(word.replace("\u2019", "'"))
        if got is not None:
            made = (got, 2.0 if got == THREAT else 0.0)
        else:
            weight = max((self.lexicon.get(k, 0.0) for k in (word, *("^" + word[:n] for n in STEMS if len(word) >= n))), default=0.0)
            made = (INSULT if weight else OTHER, weight)
        self.known[word] = made
        return made

    def emit(self, words: list[str]) -> float:
        """Score of one clause."""
        known = self.known
        state, total = self.start, 0.0
        for w in words:
            c, weight = known.get(w) or self.read(w)
            state, factor = self.arcs[state, c]
            if weight:
                total += weight * factor
        return total

    def clauses(self, text: str) -> tuple[list[float], int]:
        """Scores of the clauses with an insult or threat, and the number of all clauses that have words."""
        known = self.known
        lower = text.lower()
        hits = {w for w in set(WORD.findall(lower)) if (known.get(w) or self.read(w))[1]}
        scores, count = [], 0
        for clause in CLAUSE.split(lower):
            found = WORD.findall(clause) if hits else clause.strip()
            count += bool(found)
            if hits and not hits.isdisjoint(found):
                scores.append(self.emit(found))
        return scores, count

    def features(self, text: str) -> list[float]:
        """One, summed and largest clause scores, number and share of the clauses that match."""
        scores, count = self.clauses(text)
        matched = sum(x >= MATCH for x in scores)
        return [1.0, math.log1p(sum(scores)), max(scores, default=0.0) / 10, math.log1p(matched), math.sqrt(matched / max(count, 1))]


class Model:
    def __init__(self, lexicon: dict[str, float], weights: list[float]):
        self.lexicon, self.weights = lexicon, weights


def labelled(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """At most ``most`` labelled ids with their texts; the ids are few enough to send to every task."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("doc_id", "text", "toxic")


def lexicon_of(rows: DataFrame, most: int = LEXICON) -> dict[str, float]:
    """Words and beginnings that tell toxic texts, with a cautious log odds ratio."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in light_batches(batches):
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                words = set(WORD.findall((text or "").lower())) - CLASSES.keys()
                seen[toxic > 0].update(words | {"^" + w[:n] for w in words for n in STEMS if len(w) >= n})
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for s in seen for k in s]), pa.array([0] * len(seen[0]) + list(seen[1].values()), pa.int64()), pa.array(list(seen[0].values()) + [0] * len(seen[1]), pa.int64())],
                ["term", "toxic", "clean"],
            )

    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    yes, no = float(sum(n for k, n in totals.items() if k > 0)), float(totals.get(0, 0))
    if not yes or not no:
        return {}
    counts = rows.select("text", "toxic").mapInArrow(count, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (yes - a + 1.5)) - F.log(b / (no - b + 1.5))
    cautious = odds - 1.3 * F.sqrt(1 / a + 1 / b)
    best = counts.where(F.col("a") >= LEAST_DOCS).withColumn("weight", cautious).where(F.col("weight") > LEAST_WEIGHT)
    return {r["term"]: r["weight"] for r in best.orderBy(F.desc("weight"), "term").limit(most).collect()}


def with_features(rows: DataFrame, lexicon: dict[str, float], keep: list[str]) -> DataFrame:
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon)
        for batch in light_batches(batches):
            made = [scorer.features(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(made, pa.list_(pa.float64()))], [*keep, "features"])

    return rows.mapInArrow(read, f"{fields}, features array<double>")


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Model:
    """Lexicon and logistic weights from ``labels`` (doc_id, toxic); at most ``most`` rows are used.

    The lexicon is counted on one half of the rows and, for the weights, applied
    to the other, so that the weights see words as strangers' texts show them;
    the lexicon that scores is then counted on all of them.
    """
    rows = labelled(docs, labels, most).withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)))
    taken = []
    for h in (0, 1):
        part = lexicon_of(rows.where(F.col("half") == h))
        read = with_features(rows.where(F.col("half") != h).select("text", "toxic"), part, ["toxic"])
        taken += [(r["toxic"], r["features"]) for r in read.collect()]
    x = np.array([f for _, f in taken]).reshape(-1, FEATURES)
    y = np.array([t > 0 for t, _ in taken], float)
    weights = np.zeros(FEATURES)
    if y.any() and not y.all():

        def loss(w: np.ndarray) -> float:
            return float((np.logaddexp(0, x @ w) - y * (x @ w)).sum() + RIDGE * (w @ w) / 2)

        for _ in range(50):  # Newton steps, halved until they help
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            hessian = (x.T * (p * (1 - p))) @ x + RIDGE * np.eye(FEATURES)
            step = np.linalg.solve(hessian, x.T @ (y - p) - RIDGE * weights)
            while loss(weights + step) > loss(weights) and np.abs(step).max() > 1e-6:
                step /= 2
            weights += step
            if np.abs(step).max() < 1e-6:
                break
    else:
        weights[0] = -30.0
    return Model(lexicon_of(rows), weights.tolist())


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score``; other columns stay, old ones named score or features are replaced."""
    docs = docs.drop("score", "features")
    read = with_features(docs, model.lexicon, docs.columns)
    total = sum((F.col("features")[i] * w for i, w in enumerate(model.weights)), F.lit(0.0))
    return read.select(*[F.col(f"`{c}`") for c in docs.columns], (1 / (1 + F.exp(-total))).alias("score"))
