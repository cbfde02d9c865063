"""Registered queries of the engine, each with an equivalent SQL text for checking."""

from __future__ import annotations

from importlib import import_module

from .registry import QUERIES

for _area in ("sources", "profile", "threads", "sampling", "texts", "retrieval", "metrics", "judging", "labels", "plans"):
    import_module(f"{__name__}.{_area}")

__all__ = ["QUERIES"]
