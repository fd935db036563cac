"""Registered queries: each operator run over stand-ins built from the given tables."""

from __future__ import annotations

import importlib

from querytrail.plans import registry

_MODULES = ["log_queries", "mapping_queries", "script_queries", "tree_queries", "stream_queries"]


def _load() -> None:
    for name in _MODULES:
        importlib.import_module(f"querytrail.plans.{name}")


def queries() -> dict:
    _load()
    return dict(registry.QUERIES)


def checks() -> dict[str, str]:
    _load()
    return dict(registry.CHECKS)
