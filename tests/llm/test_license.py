import random
import re

from llm_helpers import ODD, table

from gradewell.llm.license import BASE, DRIFT, WORDINGS, least_words, listed, scan

ROWS = [
    *ODD,
    (100, "This work is licensed under the GNU General Public License, version 3."),
    (101, "x Licensed under CC BY-NC 4.0. and ALL RIGHTS RESERVED; all rights\nreserved"),
    (102, "Released under the MIT License. rights reserved, by cc, cc.by"),
    (103, "Licensed under the Apache License, Version 2.0."),
    (104, "general public licensé all the rights reserved cc 世 by"),
    (105, "cc by " * 5000),
    (106, "the mit course; apache tribe; public general license"),
]


def plain(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places = []
    for phrase, label in BASE.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


def test_base_places_match_the_definition(spark):
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in scan(table(spark, ROWS)).collect()), key=str)
    assert got == sorted(((i, *plain(t)) for i, t in ROWS), key=str)


def test_templates_add_labels(spark):
    got = {r.doc_id: r for r in scan(table(spark, ROWS)).collect()}
    assert got[100].labels == "gpl,gpl-3.0" and got[100].score == 1
    assert got[101].labels == "cc-by,cc-by-nc,reserved"
    assert got[102].labels == "cc-by,mit" and got[103].labels == "apache-2.0"
    assert got[106].labels == "" and 0 <= got[106].score < 1
    assert got[2].labels == "" and got[2].score == 0


USUAL = {
    "Licensed under the FSF General Public License, version 3": "gpl,gpl-3.0",
    "Licensed under the MIT License": "mit",
    "# SPDX-License-Identifier: Apache-2.0": "apache-2.0",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
    "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.": "gpl,gpl-3.0",
    'MIT License. Copyright (c) 2020 Some Body. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:": "mit",
    "License: public domain; this program is free of version 3": "",
    "General Public License version 3 licensed": "gpl",
}


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def phrase_places(words, phrase):
    p = phrase.split()
    return {i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p}


def aligned(text):
    """Labels by trying every wording at every place."""
    words, found = words_of(text), set()
    for label, wording, keys in WORDINGS:
        own = listed(wording)
        length = own[-1][0] + 1
        keyed = [phrase_places(words, k) for k in keys]
        for offset in range(-length - DRIFT, len(words) + DRIFT):
            near = lambda p, w: any(words[i] == w for i in range(max(offset + p - DRIFT, 0), min(offset + p + DRIFT + 1, len(words))))  # noqa: B023, E731
            if sum(near(p, w) for p, w in own) < least_words(wording):
                continue
            if all(any(offset - DRIFT <= i <= offset + length - len(k.split()) + DRIFT for i in places) for k, places in zip(keys, keyed, strict=True)):
                found.add(label)
    return ",".join(sorted(found | {label for phrase, label in BASE.items() if phrase_places(words, phrase)}))


def test_usual_wordings(spark):
    rows = list(enumerate(USUAL))
    got = {r.doc_id: r.labels for r in scan(table(spark, rows)).collect()}
    assert [got[i] for i, _ in rows] == list(USUAL.values())


def test_every_wording_is_found_whole_and_with_one_word_less_or_more(spark):
    draw, rows, want = random.Random(2), [], []
    for label, wording, keys in WORDINGS:
        own = [w if w != "-" else "any" for w in wording.split()]
        rows.append((len(rows), "before it " + " ".join(own) + " after it"))
        want.append(label)
        outside = [i for i, w in enumerate(own) if not any(w in k.split() for k in keys)]
        if len(own) >= 20:
            i = draw.choice(outside)
            rows.append((len(rows), " ".join(own[:i] + own[i + 1 :])))
            rows.append((len(rows), " ".join([*own[:i], "extra", *own[i:]])))
            want += [label, label]
    got = {r.doc_id: r.labels.split(",") for r in scan(table(spark, rows)).collect()}
    assert all(label in got[i] for i, label in enumerate(want))


def test_random_texts_against_all_alignments(spark):
    draw = random.Random(6)
    vocabulary = sorted({w for _, wording, _ in WORDINGS for _, w in listed(wording)})
    rows = []
    for i in range(150):
        parts = []
        for _ in range(draw.randint(1, 3)):
            own = [w if w != "-" else "any" for w in draw.choice(WORDINGS)[1].split()]
            for _ in range(draw.randint(0, max(len(own) // 4, 1))):
                at = draw.randrange(len(own))
                own[at : at + draw.randint(0, 1)] = draw.choice([[], [draw.choice(vocabulary)], ["other"]])
                own = own or ["x"]
            parts += [*own, *draw.choices(vocabulary, k=draw.randint(0, 6))]
        rows.append((i, " ".join(parts)))
    got = {r.doc_id: (r.labels, r.score) for r in scan(table(spark, rows)).collect()}
    want = {i: aligned(t) for i, t in rows}
    assert {i: labels for i, (labels, _) in got.items()} == want
    assert sum(bool(w) for w in want.values()) > 50 and all(0 <= s <= 1 for _, s in got.values())


def test_empty_table(spark):
    assert scan(table(spark, [])).count() == 0
