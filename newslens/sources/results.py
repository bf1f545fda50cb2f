"""Where an evaluation's tables go: one folder per experiment, one dataset per table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = ["report", "confusion_matrix", "confidences", "errors", "parameters", "class_distribution"]


def experiment_path(base: str, topics: int, trees: int) -> str:
    return f"{base.rstrip('/')}/{topics}topics_{trees}trees"


def save_evaluation(results: Mapping[str, DataFrame], base: str, topics: int, trees: int) -> str:
    """Write every table of the evaluation as JSON lines; returns the experiment's folder."""
    missing = [t for t in TABLES if t not in results]
    if missing:
        raise ValueError(f"evaluation lacks {', '.join(missing)}")
    path = experiment_path(base, topics, trees)
    for name in TABLES:
        results[name].write.mode("overwrite").json(f"{path}/{name}")
    return path


def load_evaluation(spark: SparkSession, path: str, schemas: Mapping[str, StructType]) -> dict[str, DataFrame]:
    return {name: spark.read.schema(schema).json(f"{path}/{name}") for name, schema in schemas.items()}
