"""Registered queries: each runs library operators on the given tables, beside its SQL."""

from thermolane.catalog import (
    building,
    cleaning,
    features,
    ingest,
    limits,
    master,
    planning,
    quality,
)

MODULES = (cleaning, features, planning, limits, master, ingest, quality, building)


def all_queries() -> dict:
    out = {}
    for m in MODULES:
        out.update(m.QUERIES)
    return out


def all_sql() -> dict:
    out = {}
    for m in MODULES:
        out.update(m.SQL)
    return out
