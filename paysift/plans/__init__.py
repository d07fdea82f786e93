"""Registered queries: each binds operators to the given tables, most with an equivalent SQL text."""

from .registry import REGISTRY, load_all

__all__ = ["REGISTRY", "load_all"]
