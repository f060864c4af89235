"""Registered queries, grouped by the kind of operator they show."""

from __future__ import annotations

from importlib import import_module

from millrace.plans.registry import CATALOG, Query

GROUPS = (
    "joins",
    "projections",
    "aggregates",
    "windows",
    "sorts",
    "sets",
    "scalars",
    "nested",
    "cleaning",
    "quality",
    "loading",
    "sources",
    "streams",
    "physical",
    "jobs",
)

for _group in GROUPS:
    import_module(f"millrace.plans.{_group}")


def queries() -> dict[str, Query]:
    return dict(CATALOG)


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in CATALOG.items() if q.sql}
