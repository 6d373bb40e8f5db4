"""All registered queries and their DuckDB oracles."""

from __future__ import annotations

import importlib

from hubflow.plans.common import QUERIES
from hubflow.plans.oracle import ORACLE

_MODULES = ["q_eda", "q_graph", "q_features", "q_ops", "q_ml", "q_monitor"]


def _load():
    for m in _MODULES:
        importlib.import_module(f"hubflow.plans.{m}")


def all_queries() -> dict:
    _load()
    return dict(QUERIES)


def all_oracles() -> dict:
    _load()
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
