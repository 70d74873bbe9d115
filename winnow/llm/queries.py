"""The operators as queries over the given tables."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("dedup_queries", "model_queries", "table_queries", "sequence_queries")


def all_queries() -> tuple[dict, dict[str, str]]:
    """Queries and their SQL."""
    from winnow.llm.registry import ORACLES, QUERIES

    for name in _MODULES:
        import_module(f"winnow.llm.{name}")
    return dict(QUERIES), dict(ORACLES)
