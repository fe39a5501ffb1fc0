"""Cleaning jobs in dependency order, each written as a table that later jobs read."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame

from tidemark.sources.results import overwrite


@dataclass(frozen=True)
class EtlStep:
    """A table built from others; ``needs`` names the raw tables and steps it reads."""

    name: str
    build: Callable[[Mapping[str, DataFrame]], DataFrame]
    needs: tuple[str, ...] = ()


def run_etl(steps: list[EtlStep], raw: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Build every step after the ones it needs and give all tables by name."""
    by_name = {s.name: s for s in steps}
    tables = dict(raw)
    order = TopologicalSorter({s.name: [n for n in s.needs if n in by_name] for s in steps})
    for name in order.static_order():
        step = by_name[name]
        missing = [n for n in step.needs if n not in tables]
        if missing:
            raise ValueError(f"{name} needs {missing}")
        tables[name] = overwrite(step.build(tables), f"{folder}/{name}")
    return tables
