"""All queries of the core by name, and their SQL."""

from __future__ import annotations

from eventlake.plans import catalog, extraction, feeds, listings, problems, records

MODULES = [problems, listings, catalog, extraction, feeds, records]


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: s for m in MODULES for k, s in m.SQL.items()}


def flagship(spark, sf_dir: str):
    return queries()["upcoming_by_city"](spark, sf_dir)
