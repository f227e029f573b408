"""The library's operators as named queries over the test tables."""

from __future__ import annotations

from importlib import import_module

from placetide.workload import registry

MODULES = ("layers_queries", "relational_queries", "quality_queries", "storage_queries")


def _load() -> None:
    for name in MODULES:
        import_module(f"placetide.workload.{name}")


def all_queries() -> dict:
    _load()
    return dict(registry.QUERIES)


def all_sql() -> dict:
    _load()
    return dict(registry.SQL)
