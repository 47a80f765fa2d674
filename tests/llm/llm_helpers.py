"""Small tables with every odd case, and plain versions of the operators."""

from __future__ import annotations

import re

SCHEMA = "doc_id long, text string, id string, key int, n int, words string, label string"
LONG = " ".join(f"w{i}" for i in range(3000))
PASSAGE = " ".join(f"p{i}" for i in range(30))
ODD = [
    (5, PASSAGE + " tail one"),
    (1, "lead " + PASSAGE),
    (2, None),
    (3, ""),
    (4, "a b a b a b a b a b a b a b a b a b a b a b a b a b a b"),
    (6, LONG),
    (6, LONG),
    (7, LONG + " more"),
    (8, " \n\t "),
    (None, PASSAGE),
    (9, "éü ñ — 世界 " + PASSAGE + "\n" + PASSAGE),
]


def table(spark, rows=ODD):
    """Rows of (doc_id, text) beside columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "x", 1, 2, "y", "z") for i, t in rows], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
