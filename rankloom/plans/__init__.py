"""Registered queries, named model specifications and their evaluation."""

from __future__ import annotations

import importlib
from types import ModuleType

QUERY_MODULES = ("ranking_queries", "layout_queries", "profile_queries", "feature_queries", "model_queries")


def load_catalog() -> ModuleType:
    """Import every module that registers queries, once, and return the catalogue."""
    for name in QUERY_MODULES:
        importlib.import_module(f"rankloom.plans.{name}")
    return importlib.import_module("rankloom.plans.catalog")
