"""Registered queries, one module per part of the library."""

from __future__ import annotations

import importlib

MODULES = ["scalars", "etl", "temporal", "matrices", "ranks", "evaluations", "groups", "reports", "storage"]


def load_all():
    """Import every query module and give the registry and its SQL."""
    for name in MODULES:
        importlib.import_module(f"tidemark.queries.{name}")
    from tidemark.queries.base import ORACLE, QUERIES

    return QUERIES, ORACLE
