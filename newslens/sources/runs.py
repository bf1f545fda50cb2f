"""Experiment runs as an append-only key/value table, partitioned by experiment."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from newslens.sources.schemas import RUN_LOG

NO_DATA = "No data"


def log_run(
    spark: SparkSession, path: str, experiment: str, run_id: str,
    params: Mapping[str, object], metrics: Mapping[str, float], at: datetime,
) -> None:
    """Append one run's parameters and metrics."""
    rows = [(run_id, experiment, at, "param", k, str(v)) for k, v in params.items()]
    rows += [(run_id, experiment, at, "metric", k, repr(float(v))) for k, v in metrics.items()]
    append_runs(spark.createDataFrame(rows, RUN_LOG), path)


def append_runs(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").partitionBy("experiment").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(path)


def runs_of(runs: DataFrame, experiment: str, keys: list[str]) -> DataFrame:
    """One row per run of the experiment with the named metrics as columns.

    A metric no run recorded is null, so callers always find the column.
    """
    own = runs.where((F.col("experiment") == experiment) & (F.col("kind") == "metric"))
    return own.groupBy("run_id").pivot("key", keys).agg(F.max_by("value", "ts"))


def first_metric(runs: DataFrame, experiment: str, key: str) -> DataFrame:
    """The metric of the experiment's newest run, the one a run search lists first, or 'No data'."""
    own = runs.where((F.col("experiment") == experiment) & (F.col("kind") == "metric"))
    newest = own.groupBy("run_id").agg(F.max("ts").alias("_ts")).orderBy(F.desc("_ts"), "run_id").limit(1)
    first = runs_of(runs, experiment, [key]).join(F.broadcast(newest), "run_id").agg(F.first(key).alias(key))  # one row
    return first.select(F.coalesce(key, F.lit(NO_DATA)).alias(key))
