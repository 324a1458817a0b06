"""Named queries over the driver tables (one per SURVEY §2 operator) and their DuckDB oracles."""

from __future__ import annotations

import importlib

from .registry import HEADLINE, ORACLE, QUERIES

_MODULES = ("q_sources_clean", "q_aggregates", "q_stats_models", "q_streams")


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(f"{__name__}.{m}")


_load()

__all__ = ["QUERIES", "ORACLE", "HEADLINE"]
