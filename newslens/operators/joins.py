"""Dimension lookups.

No side is forced to broadcast, since a dimension is as large as the number of
its keys. Label tables are written once and read back instead, so that the
planner knows their true size: small ones are broadcast without shuffling the
fact side, large ones are shuffled and a skewed fact side is split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from newslens.session import materialize


def label_index(df: DataFrame, column: str = "category", by: str = "alphabet", id_col: str | None = None) -> DataFrame:
    """(idx, label): labels numbered from 0, alphabetically or by first appearance.

    The window runs over one row per label, after the aggregation; the result
    is stored, so using it again does not scan the data again.
    """
    rows = df.where(F.col(column).isNotNull())
    if by == "alphabet":
        labels, order = rows.select(F.col(column).alias("label")).distinct(), F.col("label")
    elif by == "appearance":
        labels = rows.groupBy(F.col(column).alias("label")).agg(F.min(id_col).alias("_first"))
        order = F.col("_first")
    else:
        raise ValueError("by must be 'alphabet' or 'appearance'")
    numbered = labels.withColumn("idx", F.row_number().over(Window.orderBy(order)) - 1)
    return materialize(numbered.select("idx", "label"), "labels")


def attach_index(df: DataFrame, index: DataFrame, column: str = "category", name: str = "category_id") -> DataFrame:
    """Left lookup of a label's number; a miss is null."""
    return df.join(index.select(F.col("label").alias(column), F.col("idx").alias(name)), column, "left")


def attach_label(
    df: DataFrame, index: DataFrame, column: str = "pred", name: str = "predicted", default: str = "UNKNOWN"
) -> DataFrame:
    """Left lookup of a number's label; a miss is ``default``."""
    names = index.select(F.col("idx").alias(column), F.col("label").alias(name))
    joined = df.join(names, column, "left")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(default)))


def without(df: DataFrame, unwanted: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the unwanted ones."""
    return df.join(unwanted.select(key), key, "left_anti")


def members(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the wanted ones."""
    return df.join(wanted.select(key), key, "left_semi")
