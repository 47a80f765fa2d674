"""0/1 flags and code-to-label expressions built from plain tables of rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradewell.functions.text import column


class Rule(NamedTuple):
    flag: str
    column: str
    test: str
    value: Any


TESTS = {
    "<": lambda c, v: c < v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "==": lambda c, v: c == v,
    "in": lambda c, v: c.isin(list(v)),
    "between": lambda c, v: c.between(*v),
}


def flag(test: Column) -> Column:
    """1 where the test holds; a NULL test gives 0."""
    return F.when(test, 1).otherwise(0)


def rule_flags(rules: Sequence[Rule]) -> dict[str, Column]:
    return {r.flag: flag(TESTS[r.test](F.col(r.column), r.value)) for r in rules}


def below_flags(c: Column | str, limits: Mapping[str, float]) -> dict[str, Column]:
    """One flag per limit: the value is known and below it."""
    return {name: flag(column(c) < limit) for name, limit in limits.items()}


def present(c: Column | str) -> Column:
    return column(c).isNotNull().cast("int")


def cases(default: Any, pairs: Sequence[tuple[Column, Any]]) -> Column:
    """First case that holds, else the default."""
    out = None
    for test, value in pairs:
        out = F.when(test, value) if out is None else out.when(test, value)
    return F.lit(default) if out is None else out.otherwise(default)


def decode(c: Column | str, mapping: Mapping[Any, Any], default: Any) -> Column:
    return cases(default, [(column(c) == key, value) for key, value in mapping.items()])


def decode_contains(c: Column | str, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Label by contained text; of several rules that hold the last one wins."""
    return cases(default, [(column(c).contains(text), label) for text, label in reversed(rules)])


def yes_no(c: Column | str, no_value: str) -> Column:
    return F.when(column(c) == no_value, "No").otherwise("Yes")
