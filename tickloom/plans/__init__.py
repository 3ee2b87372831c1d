"""Registered queries: operators bound to the given tables, each with its SQL counterpart."""

from tickloom.plans import accounts, bars, model, quotes, reference, sinks, streams  # noqa: F401
from tickloom.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
