"""Text and code expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Street words and their long or short form (fixed values).
STREET_WORDS = {
    "BOULEVARD": "BLVD",
    "CIR": "CIRCLE",
    "DR": "DRIVE",
    "ST": "STREET",
    "AVE": "AVENUE",
    "N": "NORTH",
    "S": "SOUTH",
    "E": "EAST",
    "W": "WEST",
    "FIRST": "1ST",
    "SECOND": "2ND",
    "THIRD": "3RD",
    "FOURTH": "4TH",
    "FIFTH": "5TH",
    "SIXTH": "6TH",
    "SEVENTH": "7TH",
    "EIGHTH": "8TH",
    "NINTH": "9TH",
}


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pad_code(c: Column | str, width: int) -> Column:
    """Left-pad a code with zeros; a longer code is kept whole (lpad would cut it)."""
    text = column(c).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def title(c: Column | str) -> Column:
    """Capitalise after every non-letter, so ``O'NEIL`` gives ``O'Neil``."""
    words = F.split(column(c), r"(?<=[^\p{L}])")
    return F.array_join(
        F.transform(
            words,
            lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2)))),
        ),
        "",
    )


def swap(c: Column | str, old: str, new: str) -> Column:
    return F.replace(column(c), F.lit(old), F.lit(new))


def to_int_text(c: Column | str) -> Column:
    """Number to whole-number text; missing and bad numbers to ``0``."""
    return F.coalesce(column(c).try_cast("bigint"), F.lit(0)).cast("string")


def tag_code(prefix: Column | str, number: Column | str) -> Column:
    """``G`` and ``100`` to ``G-0100``; NULL for a missing, bad, zero or over-long number.

    A number arriving as a double loses its fraction first; text is kept as is.
    """
    digits = to_int_text(number)
    fits = (digits != "0") & (F.length(digits) <= 4)
    return F.when(fits, F.concat(column(prefix), F.lit("-"), F.lpad(digits, 4, "0")))


def compound_key(*parts: Column | str, sep: str = "_") -> Column:
    """Parts joined by ``sep``; NULL when any part is NULL."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(sep))
        pieces.append(column(part).cast("string"))
    return F.concat(*pieces)


def file_stem(c: Column | str) -> Column:
    """File name without its folders and without anything after the first dot."""
    name = F.element_at(F.split(column(c), r"[/\\]"), -1)
    return F.split_part(name, F.lit("."), F.lit(1))


def contains_any(c: Column | str, words: Sequence[str]) -> Column:
    """1-in-many substring test; a NULL text contains nothing."""
    test = F.lit(False)
    for word in words:
        test = test | column(c).contains(word)
    return F.coalesce(test, F.lit(False))


def street_words(c: Column | str, mapping: Mapping[str, str] = STREET_WORDS) -> Column:
    """Upper-cased street split into words, punctuation removed, words unified."""
    plain = F.regexp_replace(F.upper(column(c)), r"[^\w\s]", "")
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.transform(
        F.split(plain, " "), lambda w: F.coalesce(F.try_element_at(table, w), w)
    )


def to_text(c: Column | str, fmt: str | None = None) -> Column:
    return F.date_format(column(c), fmt) if fmt else column(c).cast("string")
