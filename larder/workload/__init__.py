"""Queries over the given tables, one or more per operator."""

from __future__ import annotations

from importlib import import_module
from types import ModuleType


def load() -> ModuleType:
    """The registry with every query module imported."""
    for name in ("tables", "expressions", "filters", "joins", "aggregates", "search", "flows"):
        import_module(f"larder.workload.{name}")
    return import_module("larder.workload.registry")
