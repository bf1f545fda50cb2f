"""Named queries over the given tables, each with its SQL counterpart where SQL can say it."""

from newslens.plans.registry import REGISTRY, load_all

__all__ = ["REGISTRY", "load_all"]
