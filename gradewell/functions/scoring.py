"""Score expressions: linear and logistic scores, bins, estimates and letters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradewell.functions.flags import cases
from gradewell.functions.text import column

# Percentile limits of the letters, each below its upper bound (fixed values).
LETTERS = [(10, "A"), (25, "B"), (75, "C"), (90, "D")]
TOP_LETTER = "E"
NO_LETTER = "N/A"
ALL_LETTERS = ("A", "B", "C", "D", "E", "N/A")


def linear_score(betas: Mapping[str, float], intercept: float) -> Column:
    """Weighted sum; NULL when any predictor is NULL."""
    terms = [f"{float(intercept)!r}D", *[f"{name} * {float(b)!r}D" for name, b in betas.items()]]
    return F.expr(" + ".join(terms))


def logistic(z: Column | str) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-column(z)))


def bin_by(name: str, breaks: Sequence[float], step: int = 5) -> Column:
    """Left-open, right-closed bins labelled step, 2*step, ...; NULL gives 0.

    The label follows from how many breaks lie below the value.
    """
    passed = " + ".join(f"int({name} > {float(b)!r}D)" for b in breaks)
    return F.expr(f"coalesce({step}D * (1 + {passed}), 0D)")


def shrink(percentile: Column | str, small: Column | str) -> Column:
    """Halve the distance to 50 where the volume is small."""
    p = column(percentile)
    return F.when(column(small) == 1, F.lit(50.0) + F.lit(0.5) * (p - F.lit(50.0))).otherwise(p)


def step_map(percentile: Column | str, steps: Sequence[tuple[float, float]], last: float) -> Column:
    """Estimate of the first step whose upper bound holds, else ``last``."""
    p = column(percentile)
    return F.when(p.isNull(), F.lit(None).cast("double")).otherwise(
        cases(float(last), [(p <= F.lit(float(top)), F.lit(float(v))) for top, v in steps])
    )


def letter_grade(percentile: Column | str, closed_top: bool = True) -> Column:
    """A to E by percentile, ``N/A`` where there is none.

    ``closed_top`` counts a percentile of exactly 100 (a sole best value) as E.
    """
    p = column(percentile)
    top = p <= 100 if closed_top else p < 100
    return cases(NO_LETTER, [(p < limit, letter) for limit, letter in LETTERS] + [(top, TOP_LETTER)])


def clamp_letter(letter: Column | str, small: Column | str) -> Column:
    """Small volume cannot earn an outer letter: E becomes D and A becomes B."""
    c = column(letter)
    is_small = column(small) == 1
    return F.when(is_small & (c == "E"), "D").when(is_small & (c == "A"), "B").otherwise(c)
