"""Where queries register themselves."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFunction = Callable[[SparkSession, str], DataFrame]
MODULES = [
    "curation", "texts", "annotation", "reporting", "terms", "labels", "modelling", "evaluation", "serving",
]


@dataclass(frozen=True)
class Query:
    name: str
    run: QueryFunction
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register a query under ``name``, with the SQL that must give the same rows."""

    def register(run: QueryFunction) -> QueryFunction:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, run, sql)
        return run

    return register


def load_all() -> dict[str, Query]:
    for module in MODULES:
        importlib.import_module(f"newslens.plans.{module}")
    return REGISTRY
