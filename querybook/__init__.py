"""Checked queries: every operator on the given tables, with the SQL it must equal."""

from __future__ import annotations

from querybook import catalog, groups, jobs, relational, scalar, scores, tables

MODULES = (tables, catalog, relational, groups, scalar, scores, jobs)


def queries():
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql():
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
