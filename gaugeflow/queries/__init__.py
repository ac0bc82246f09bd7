"""Operators applied to the driver tables, each with equivalent SQL where SQL can express it."""

from importlib import import_module

from .registry import REGISTRY

for _name in ("sources", "tables", "quality", "scalars", "aggregates", "ranking", "models", "scores", "streams", "jobs"):
    import_module(f"{__name__}.{_name}")

__all__ = ["REGISTRY"]
