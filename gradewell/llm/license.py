"""License scan by a positional rare-token index; DataFrame functions only.

The index holds the words of known licence wordings with their places. Document
frequencies over the whole corpus rank them, and of each wording of m words the
m - ceil(SHARE * m) + 1 rarest are its entries: a file where a wording stands with
``SHARE`` of its words has at least one of them. So one pass over a file's words keeps its
places of entries and of first words of phrases, and nothing else is looked up.

An entry at a place proposes alignments: its place in the file less its place in the
wording, and the ``DRIFT`` places to either side. Under an alignment each word of the
wording stands if the file has it within ``DRIFT`` of where it should be, so a word that
is missing, or put in, costs itself and not what follows. A wording is found where
``SHARE`` of its words stand and each of its key phrases stands there whole. That is
what trying every alignment would find, as the entries leave none out.

All of it happens within a row: no shuffle but that of the frequencies, of which there
are as many as the index has words. Null and empty texts have no words; repeated rows
stay as they are; null ids and extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Mapping
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE, DRIFT = 0.8, 2
# Phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Label, wording, key phrases. "-" is any word.
GPL = "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"
LATER = "or at your option any later version"
REDISTRIBUTION = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
    "in the documentation and or other materials provided with the distribution"
)
WORDINGS = [
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2",)),
    ("apache-2.0", "licensed - - apache license version 2 0", ("apache license version 2",)),
    (
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at",
        ("apache license version 2",),
    ),
    ("bsd", "redistribution - - - source and binary forms - - without modification", ("source and binary forms",)),
    ("bsd", REDISTRIBUTION, ("source and binary forms", "above copyright notice")),
    ("bsd", "licensed under the bsd license", ("bsd license",)),
    ("bsl-1.0", "distributed under the boost software license version 1 0", ("boost software license",)),
    (
        "bsl-1.0",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license "
        "to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software",
        ("person or organization",),
    ),
    ("cc-by-nc", "licensed - cc by nc 4 0", ("cc by nc",)),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial",)),
    ("cc-by-sa", "licensed - cc by sa 4 0", ("cc by sa",)),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike",)),
    ("cc0-1.0", "cc0 1 0 universal public domain dedication", ("public domain dedication",)),
    (
        "cc0-1.0",
        "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
        ("related or neighboring rights",),
    ),
    ("gpl-2.0", "licensed - - gnu general public license version 2", ("general public license version 2",)),
    ("gpl-2.0", f"{GPL} either version 2 of the license {LATER}", ("gnu general public license", "version 2 of the license")),
    ("gpl-3.0", "licensed - - gnu general public license version 3", ("general public license version 3",)),
    ("gpl-3.0", f"{GPL} either version 3 of the license {LATER}", ("gnu general public license", "version 3 of the license")),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
        ("with or without fee",),
    ),
    ("lgpl", "licensed - - gnu lesser general public license", ("lesser general public license",)),
    (
        "lgpl",
        f"this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version - - of the license {LATER}",
        ("lesser general public license",),
    ),
    ("mit", "released - - mit license", ("mit license",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software "
        "and to permit persons to whom the software is furnished to do so subject to the following conditions",
        ("free of charge to any person obtaining", "deal in the software without restriction"),
    ),
    ("mpl-2.0", "terms - - mozilla public license v 2 0", ("mozilla public license",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software",
        ("free and unencumbered software",),
    ),
    (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software "
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely",
        ("including commercial applications",),
    ),
]
# SPDX identifiers as words, and their labels.
SPDX = {
    "apache 2 0": "apache-2.0", "bsd 2 clause": "bsd", "bsd 3 clause": "bsd", "bsl 1 0": "bsl-1.0", "cc by nc 4 0": "cc-by-nc",
    "cc by sa 4 0": "cc-by-sa", "cc0 1 0": "cc0-1.0", "gpl 2 0": "gpl-2.0", "gpl 3 0": "gpl-3.0", "isc": "isc", "lgpl 2 1": "lgpl",
    "lgpl 3 0": "lgpl", "mit": "mit", "mpl 2 0": "mpl-2.0", "unlicense": "unlicense", "zlib": "zlib",
}
WORDINGS += [(label, f"spdx license identifier {words}", (f"license identifier {words}",)) for words, label in SPDX.items()]
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def listed(wording: str) -> list[tuple[int, str]]:
    """(place, word) of a wording's own words."""
    return [(p, w) for p, w in enumerate(wording.split()) if w != "-"]


def least_words(wording: str) -> int:
    """How many of its words must stand."""
    return ceil(SHARE * len(listed(wording)) - 1e-9)


def words(text: str = "text") -> Column:
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), ASCII_UPPER, ASCII_LOWER)
    return F.filter(F.split(lower, BETWEEN), lambda w: w != "")


def frequencies(docs: DataFrame) -> dict[str, int]:
    """Documents that hold each word of the index; at most one row per such word reaches the driver."""
    known = sorted({w for _, wording, _ in WORDINGS for _, w in listed(wording)})
    each = docs.select(words().alias("__words")).select(
        F.explode(F.array_distinct(F.filter("__words", lambda w: w.isin(known)))).alias("word")
    )
    return {r["word"]: r["n"] for r in each.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}


def entries(seen: Mapping[str, int]) -> dict[str, list[tuple[int, int]]]:
    """Postings (wording, place) of the rarest words of each wording."""
    found: dict[str, list[tuple[int, int]]] = {}
    for t, (_, wording, _) in enumerate(WORDINGS):
        own = sorted(listed(wording), key=lambda x: (seen.get(x[1], 0), x))
        for p, w in own[: len(own) - least_words(wording) + 1]:
            found.setdefault(w, []).append((t, p))
    return found


def quoted(words: list[str]) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


def wordings_sql() -> str:
    """The wordings as an array of structs: own words with places, key phrases, least words, length."""
    made = []
    for _, wording, keys in WORDINGS:
        own = listed(wording)
        pairs = ", ".join(f"named_struct('p', {p}, 'w', '{w}')" for p, w in own)
        phrases = ", ".join(quoted(k.split()) for k in keys)
        made.append(f"named_struct('own', array({pairs}), 'phrases', array({phrases}), 'least', {least_words(wording)}, 'length', {own[-1][0] + 1})")
    return f"array({', '.join(made)})"


def postings_sql(postings: Mapping[str, list[tuple[int, int]]]) -> str:
    """Word -> its entries (wording, place)."""
    entry = lambda e: f"named_struct('t', {e[0]}, 'p', {e[1]})"
    return "map(" + ", ".join(f"'{w}', array({', '.join(map(entry, found))})" for w, found in postings.items()) + ")"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score; one row per row.

    ``score`` is the best share of a phrase or wording found: 1 for a whole one, 0 where
    no entry stands.
    """
    postings = entries(frequencies(docs))
    known = ", ".join(f"'{w}'" for w in sorted({*postings, *(b.split()[0] for b in BASE)}))
    near = " OR ".join(f"get(__words, c.o + x.p + {d}) = x.w" for d in range(-DRIFT, DRIFT + 1))
    # The steps as columns of their own, so that none is worked out twice.
    steps = {
        "__hits": f"array_compact(transform(__words, (w, i) -> if(w IN ({known}), named_struct('at', i, 'word', w), NULL)))",
        "__index": postings_sql(postings),
        "__wordings": wordings_sql(),
        "__proposed": f"""array_distinct(flatten(flatten(transform(filter(__hits, h -> map_contains_key(__index, h.word)), h -> transform(__index[h.word], e ->
            transform(sequence({-DRIFT}, {DRIFT}), d -> named_struct('t', e.t, 'o', h.at - e.p + d)))))))""",
        "__tried": "transform(__proposed, c -> named_struct('t', c.t, 'o', c.o, 'of', get(__wordings, c.t)))",
        "__stood": f"transform(__tried, c -> named_struct('t', c.t, 'o', c.o, 'of', c.of, 'n', size(filter(c.of.own, x -> {near}))))",
        "__found": f"""filter(__stood, c -> c.n >= c.of.least AND forall(c.of.phrases, k -> exists(
            sequence({-DRIFT}, c.of.length - size(k) + {DRIFT}), s -> c.o + s >= 0 AND slice(__words, greatest(c.o + s, 0) + 1, size(k)) = k)))""",
        "__named": "transform(__found, c -> get(" + quoted([label for label, _, _ in WORDINGS]) + ", c.t))",
        "__share": "coalesce(array_max(transform(__stood, c -> c.n / size(c.of.own))), 0D)",
    }
    for b, phrase in enumerate(BASE):
        p = phrase.split()
        steps[f"__b{b}"] = f"transform(filter(__hits, h -> h.word = '{p[0]}' AND slice(__words, h.at + 1, {len(p)}) = {quoted(p)}), h -> h.at)"
    out = docs.select("doc_id", words().alias("__words"))
    for name, sql in steps.items():
        out = out.withColumn(name, F.expr(sql))
    base = [F.col(f"__b{b}") for b in range(len(BASE))]
    starts = F.concat(*base)
    base_named = F.array_compact(F.array(*[F.when(F.size(c) > 0, F.lit(label)) for c, label in zip(base, BASE.values(), strict=True)]))

    def joined(names: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(names)), ",")

    return out.select(
        "doc_id",
        F.size("__words").cast("long").alias("n_words"),
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        joined(base_named).alias("base_labels"),
        joined(F.concat(base_named, "__named")).alias("labels"),
        F.greatest(F.when(F.size(starts) > 0, F.lit(1.0)).otherwise(0.0), "__share").alias("score"),
    )
