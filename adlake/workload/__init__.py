"""The operators run over the analytics test tables, each with SQL that must agree."""

from __future__ import annotations

from importlib import import_module

MODULES = ("models", "joblogs", "telemetry", "requests", "nested", "incremental")


def load():
    """All registered queries and their SQL."""
    for name in MODULES:
        import_module(f"adlake.workload.{name}")
    from adlake.workload.registry import QUERIES, SQL

    return QUERIES, SQL
