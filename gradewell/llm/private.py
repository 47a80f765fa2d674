"""Personal data: fixed patterns, and a skip-chain conditional random field over what surrounds them.

The patterns give the base spans of each kind. The field labels *units*: base
spans, other digit groups and words that look like an account name. A unit's
potentials come from its form; units that stand close share a chain potential;
units with equal digits or equal name, however far apart, share a skip
potential, and units that are only similar (the same last seven digits, or a name
with the same letters) share a part ``ALIKE`` of it. Loopy message passing then carries
a label from one mention to its bare repeats. Base spans are observed; another unit becomes a span of a kind
when its marginal reaches ``SURE``.

The field is trained on at most ``TRAIN_UNITS`` units, a parameter: whole documents by their
smallest hashes, and of the last one those with the smallest hashes of their places. It
learns form weights by multinomial
regression, where the telling mark of a kind (plus sign, at sign, check digit)
is hidden in a copy of each span, edge potentials by counting label pairs.
A unit is linked to the previous one with its key, so a text with many repeats
has as many links as units.

Null and empty texts have no spans. Places are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradewell.llm.tables import pin, row_id, text_key
from gradewell.llm.text import light_batches

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
TRAIN_UNITS, SURE, ROUNDS, NEAR, STRAY, ALIKE = 20_000, 0.8, 8, 40, 0.05, 0.5

# Fixed patterns of the base spans. Each starts where its run of characters starts.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*$")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9]){11,}")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Other digit groups, and words that may be an account name.
GROUP = re.compile(r"(?<![\w.@%+-])[0-9(](?:[ ().-]{0,2}[0-9]){6,18}(?![\w@])")
NAME = re.compile(r"(?<![\w.@%+-])[A-Za-z][A-Za-z0-9._%+-]*[A-Za-z0-9](?![\w@])")
NOT_DIGIT, NOT_LETTER = re.compile(r"[^0-9]"), re.compile(r"[^a-z]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each at sign so that long runs are read once."""
    done, at = 0, text.find("@")
    while at >= 0:
        low = at
        while low > done and (text[low - 1] in "._%+-" or text[low - 1].isascii() and text[low - 1].isalnum()):
            low -= 1
        match = DOMAIN.match(text, at + 1) if low < at else None
        if match:
            yield low, match.end()
            done = match.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in order of start, then kind."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p[-3:]) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0]) if m.end() - m.start() <= 40 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def unit_key(text: str, kind: int) -> str:
    """What repeats of one entity share: the account name, or the last ten digits."""
    if kind == 0:
        return "@" + text.partition("@")[0].lower()
    digits = NOT_DIGIT.sub("", text)
    return digits[-10:]


LEAST_LETTERS = 6


def near_key(key: str) -> str:
    """What similar keys share: the last seven digits, or the letters of a name."""
    if not key.startswith("@"):
        return key[-7:]
    letters = NOT_LETTER.sub("", key)
    return "@" + (letters if len(letters) >= LEAST_LETTERS else key)


def form(text: str) -> list[float]:
    digits = NOT_DIGIT.sub("", text)
    n = len(digits)
    dots, gaps = text.count("."), sum(c in " ()-" for c in text)
    return [
        1.0,
        float(text[:1] == "+"),
        float("@" in text),
        float(12 <= n <= 19 and luhn(digits)),
        float(n < 7),
        float(7 <= n <= 11),
        float(12 <= n <= 19),
        float(n > 19),
        float(dots == 3),
        float(0 < gaps <= 4),
        float(any(c.isalpha() for c in text)),
    ]


TELLING = {0: 2, 2: 3, 3: 1}  # the mark hidden in a copy of a kind's spans
FORMS = 11


def units(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str, list[float]]]:
    """(start, end, label or -1, key, form) of everything the field looks at, in order of start."""
    out = [(a, b, k + 1, unit_key(text[a:b], k), form(text[a:b])) for a, k, b in base]
    taken = sorted((a, b) for a, _, b in base)
    starts = [a for a, _ in taken]

    def free(a: int, b: int) -> bool:
        i = int(np.searchsorted(starts, b))  # spans of different kinds overlap rarely: look at a few before
        return all(y <= a for _, y in taken[max(i - 4, 0) : i])

    out += [(m.start(), m.end(), -1, unit_key(m[0], 3), form(m[0])) for m in GROUP.finditer(text) if free(m.start(), m.end())]
    # Account names that are more than one plain word, and their letters for names like them.
    names = {k[1:] for _, _, label, k, _ in out if label == 1 and len(k) >= 6 and not k[1:].isalpha()}
    letters = {x for x in (NOT_LETTER.sub("", n) for n in names) if len(x) >= LEAST_LETTERS}
    if names:
        for m in NAME.finditer(text):
            word = m[0].lower()
            known = word in names or not word.isalpha() and NOT_LETTER.sub("", word) in letters
            if known and free(m.start(), m.end()):
                out.append((m.start(), m.end(), -1, "@" + word, form(m[0])))
    return sorted(out)


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base string, base_sha256 string"
UNITS = "units array<struct<start:long,stop:long,label:int,key:string,form:array<float>>>"


def find(docs: DataFrame) -> DataFrame:
    """Base spans and units of every row; the text column stays behind."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in light_batches(batches):
            counts, texts, unit_rows = [], [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                shown = listed(base)
                counts.append([sum(k == x for _, k, _ in base) for x in range(4)])
                texts.append((shown, hashlib.sha256(shown.encode()).hexdigest()))
                unit_rows.append([dict(zip(("start", "stop", "label", "key", "form"), u, strict=True)) for u in units(text, base)] if text else [])
            shape = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("label", pa.int32()), ("key", pa.string()), ("form", pa.list_(pa.float32()))]))
            columns = [batch.column("doc_id"), *(pa.array([c[x] for c in counts], pa.int64()) for x in range(4))]
            columns += [pa.array([t[x] for t in texts], pa.string()) for x in range(2)] + [pa.array(unit_rows, shape)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "base_sha256", "units"])

    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, {FOUND}, {UNITS}")


class Field:
    """Weights of the field and loopy message passing over a batch of documents."""

    def __init__(self, forms: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.forms, self.chain, self.skip = forms, chain, skip

    def marginals(self, form: np.ndarray, label: np.ndarray, edges: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Beliefs of all units; rows of ``edges`` join two of them. Everything is in logarithms."""
        node = form @ self.forms
        node[label >= 0] = -30.0
        node[label >= 0, label[label >= 0]] = 0.0
        tables = np.stack((self.chain, self.skip, ALIKE * self.skip))[kinds]
        ends = np.concatenate((edges, edges[:, ::-1]))
        tables = np.concatenate((tables, tables.transpose(0, 2, 1)))
        messages = np.zeros((len(ends), len(LABELS)))
        half = len(edges)
        for _ in range(ROUNDS if half else 0):
            total = node.copy()
            np.add.at(total, ends[:, 1], messages)
            opposite = np.concatenate((messages[half:], messages[:half]))
            source = total[ends[:, 0]] - opposite
            made = np.logaddexp.reduce(source[:, :, None] + tables, axis=1)
            messages = 0.5 * messages + 0.5 * (made - np.logaddexp.reduce(made, axis=1, keepdims=True))
        belief = node
        if half:
            np.add.at(belief, ends[:, 1], messages)
        return np.exp(belief - np.logaddexp.reduce(belief, axis=1, keepdims=True))


CHAIN, SKIP, SIMILAR = range(3)


def links(rows: list[list[dict]]) -> tuple[np.ndarray, np.ndarray]:
    """Edges between units of the same document, and their kinds.

    Close neighbours, the previous unit with the same key, and, for the first unit
    with its key, the previous unit with a similar one.
    """
    edges, kinds, n = [], [], 0
    for found in rows:
        last: dict[str, int] = {}
        alike: dict[str, int] = {}
        for i, u in enumerate(found):
            near = near_key(u["key"])
            if i and u["start"] - found[i - 1]["stop"] <= NEAR:
                edges.append((n + i - 1, n + i))
                kinds.append(CHAIN)
            if u["key"] in last:
                edges.append((n + last[u["key"]], n + i))
                kinds.append(SKIP)
            elif near in alike:
                edges.append((n + alike[near], n + i))
                kinds.append(SIMILAR)
            last[u["key"]] = alike[near] = i
        n += len(found)
    return np.array(edges, np.int64).reshape(-1, 2), np.array(kinds, np.int64)


def fit(rows: list[list[dict]]) -> Field:
    """Weights from the units of sampled documents.

    A unit without a base span counts as none, unless a base span of its document
    has its key or a similar one: what such a repeat is, is the question, so it teaches nothing.
    Skip potentials come from pairs of base spans; a repeat is none by ``STRAY``.
    """
    every = [u for found in rows for u in found]
    named = [{near_key(u["key"]) for u in found if u["label"] >= 0} for found in rows]
    open_units = [u["label"] < 0 and near_key(u["key"]) in keys for found, keys in zip(rows, named, strict=True) for u in found]
    x = np.array([u["form"] for u in every]).reshape(-1, FORMS)
    y = np.array([max(u["label"], 0) for u in every], np.int64)
    hidden = [(i, TELLING[k - 1]) for i, k in enumerate(y) if k - 1 in TELLING]
    masked = x[[i for i, _ in hidden]].copy()
    masked[range(len(hidden)), [m for _, m in hidden]] = 0
    teach = ~np.array(open_units, bool)
    forms, labels = np.concatenate((x[teach], masked)), np.concatenate((y[teach], y[[i for i, _ in hidden]]))
    weights = np.zeros((FORMS, len(LABELS)))
    for _ in range(300 if len(forms) else 0):
        score = forms @ weights
        p = np.exp(score - np.logaddexp.reduce(score, axis=1, keepdims=True))
        p[np.arange(len(forms)), labels] -= 1
        weights -= 2.0 * (forms.T @ p / len(forms) + 1e-4 * weights)
    edges, edge_kinds = links(rows)
    is_skip = edge_kinds == SKIP
    kinds = len(LABELS)
    chain, skip = np.ones((kinds, kinds)), np.ones((kinds, kinds)) + 4 * np.eye(kinds)
    both = (y[edges] > 0).all(1)
    near = (edge_kinds == CHAIN) & teach[edges].all(1)
    np.add.at(chain, (y[edges[near, 0]], y[edges[near, 1]]), 1)
    np.add.at(skip, (y[edges[is_skip & both, 0]], y[edges[is_skip & both, 1]]), 1)
    chain, skip = chain + chain.T, (skip + skip.T)[1:, 1:]
    share = chain.sum(1) / chain.sum()
    alike = np.zeros((kinds, kinds))
    agree = skip / skip.sum(1, keepdims=True)
    alike[1:, 1:] = np.log(kinds * (agree + agree.T) / 2)
    alike[0, 1:] = alike[1:, 0] = np.log(kinds * STRAY)
    return Field(weights, 0.25 * np.log(chain / chain.sum() / share[:, None] / share[None, :]), alike)


def sample(found: DataFrame, most: int = TRAIN_UNITS) -> list[list[dict]]:
    """``most`` units to learn from, by document; see the module text for which."""
    units = found.select(F.xxhash64("doc_id", "base").alias("doc"), F.explode("units").alias("u"))
    some = units.orderBy("doc", F.xxhash64("doc", "u.start"), "u.start").limit(most)
    out: dict[int, list[dict]] = {}
    for r in some.collect():
        out.setdefault(r["doc"], []).append(r["u"].asDict())
    return [sorted(rows, key=lambda u: u["start"]) for rows in out.values()]


def label(found: DataFrame, field: Field, sure: float = SURE) -> DataFrame:
    """``found`` with ``spans``: the base spans and those that the field adds."""
    kind = found.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit_rows = batch.column("units").to_pylist()
            every = [u for found in unit_rows for u in found]
            spans = batch.column("base").to_pylist()
            if every:
                form = np.array([u["form"] for u in every], float)
                known = np.array([u["label"] for u in every], np.int64)
                belief = field.marginals(form, known, *links(unit_rows))
                best = belief.argmax(1)
                n = 0
                for d, found in enumerate(unit_rows):
                    new = []
                    for i, u in enumerate(found):
                        k = int(best[n + i])
                        if u["label"] < 0 and k and belief[n + i, k] >= sure:
                            new.append((u["start"], k - 1, u["stop"]))
                    n += len(found)
                    if new:
                        base = [(int(a), KINDS.index(k), int(b)) for k, a, b in (s.split(":") for s in spans[d].split(",") if s)]
                        spans[d] = listed(sorted(base + new))
            names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "base_sha256"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(spans, pa.string())], [*names, "spans"])

    return found.mapInArrow(rows, f"doc_id {kind}, {FOUND}, spans string")


def find_private(docs: DataFrame) -> DataFrame:
    """Counts, digest and spans of every row, repeated and null ids included."""
    found = pin(find(docs))
    return label(found, fit(sample(found)))


def mask_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; ``found`` has id, key and spans."""
    names = docs.columns
    # The other columns as one struct: they may have any names.
    others = [c for c in names if c != "text"]
    keyed = docs.select(row_id().alias("__id"), text_key().alias("__key"), "text", F.struct(F.lit(0).alias("__"), *[F.col(f"`{c}`") for c in others]).alias("row"))
    spans = found.select(F.col("id").alias("__id"), F.col("key").alias("__key"), F.col("spans").alias("__spans"))
    joined = keyed.join(spans.dropDuplicates(["__id", "__key"]), ["__id", "__key"], "left").select("row", "text", "__spans")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in light_batches(batches):
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("__spans").to_pylist(), strict=True):
                done, parts = 0, []
                for k, a, b in (s.split(":") for s in (spans or "").split(",") if s):
                    if int(a) >= done:
                        parts += [text[done : int(a)], f"[{k}]"]
                    done = max(done, int(b))
                out.append(text if text is None else "".join([*parts, text[done:]]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], ["row", "text"])

    made = joined.mapInArrow(rows, T.StructType([joined.schema["row"], T.StructField("text", T.StringType())]))
    return made.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in names])
