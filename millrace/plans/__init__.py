"""Composed jobs and the registered queries with their SQL counterparts."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("scans", "calendars", "cleaning", "typing", "loading", "verifying", "streams", "edges", "robust")


def _load() -> None:
    for module in _MODULES:
        import_module(f"millrace.plans.{module}")


def all_queries() -> dict:
    """Every registered query by name."""
    _load()
    from millrace.plans.registry import QUERIES

    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    """The SQL of every query that has one."""
    _load()
    from millrace.plans.registry import ORACLES

    return dict(ORACLES)
