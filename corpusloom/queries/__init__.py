"""Registered queries: each a Spark callable and, where SQL can say the same, its SQL."""

from __future__ import annotations

from importlib import import_module

_MODULES = ["prepare", "select", "personal", "measure", "jobs"]


def registry() -> dict[str, tuple]:
    """All queries by name, as ``(callable, sql or None)``."""
    merged: dict[str, tuple] = {}
    for name in _MODULES:
        for key, entry in import_module(f"corpusloom.queries.{name}").QUERIES.items():
            if key in merged:
                raise ValueError(f"query {key!r} is registered twice")
            merged[key] = entry
    return merged
