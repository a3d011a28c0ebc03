"""Registered queries over the driver tables and their SQL twins."""

from __future__ import annotations

import importlib

MODULES = (
    "table_queries", "series_queries", "sample_queries", "model_queries", "fit_queries", "live_queries", "stream_queries", "file_queries", "merge_queries",
)


def load():
    """All queries and SQL texts, by name."""
    from checks.registry import QUERIES, SQL

    for module in MODULES:
        importlib.import_module(f"checks.{module}")
    return dict(QUERIES), dict(SQL)
