"""Every operator as a named query over the given tables."""

from __future__ import annotations

from importlib import import_module

_MODULES = (
    "split_queries", "feature_queries", "metric_queries", "vector_queries", "drift_queries", "lookup_queries",
    "model_queries",
)


def _load() -> None:
    for name in _MODULES:
        import_module(f"{__name__}.{name}")


def all_queries() -> dict:
    from winnow.catalog.registry import QUERIES

    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    from winnow.catalog.registry import ORACLES

    _load()
    return dict(ORACLES)
