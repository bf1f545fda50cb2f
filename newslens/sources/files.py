"""Readers and writers for article files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from newslens.functions.text import null_markers_to_null
from newslens.functions.wordlists import NULL_MARKERS
from newslens.session import spread
from newslens.sources.schemas import ARTICLE, NEWS_INPUT

CORRUPT = "_corrupt_record"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a folder, in its stored partitioning."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_texts(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A table whose rows are about to go through text expressions."""
    return spread(read_table(spark, folder, name).select(*columns))


def read_articles_json(spark: SparkSession, path: str, schema: StructType = ARTICLE) -> DataFrame:
    """JSON-lines articles; an unreadable line becomes a row with ``_corrupt_record``."""
    with_corrupt = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def read_articles_csv(spark: SparkSession, path: str, schema: StructType = ARTICLE) -> DataFrame:
    """CSV with a header; quotes inside fields are doubled, newlines may be embedded.

    Multi-line CSV cannot be split, so large exchanges should come as many files
    or be converted to Parquet once.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def normalize_null_markers(df: DataFrame, markers: list[str] = NULL_MARKERS) -> DataFrame:
    """Null out every string cell that holds only a null marker."""
    return df.select(*[
        null_markers_to_null(F.col(f.name), markers).alias(f.name)
        if isinstance(f.dataType, StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def read_marked_csv(spark: SparkSession, path: str, schema: StructType = ARTICLE) -> DataFrame:
    """CSV scan that drops a byte-order mark and turns null markers into nulls."""
    return normalize_null_markers(read_articles_csv(spark, path, schema))


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Scoring requests, one JSON object per line."""
    return spark.read.schema(NEWS_INPUT).json(path)


def write_csv(df: DataFrame, path: str, byte_order_mark: bool = False) -> None:
    """CSV for exchange. With ``byte_order_mark`` each file starts with one, for spreadsheets."""
    names = df.columns
    if byte_order_mark:
        df = df.withColumnRenamed(names[0], "\ufeff" + names[0])
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", "")
        .csv(path)
    )


def write_dataset(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Parquet, the format between jobs."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def dataset_path(base: str, name: str, sampled: bool) -> str:
    """``<base>/<name>`` or ``<base>/<name>_sample`` for sampled runs."""
    return f"{base.rstrip('/')}/{name}{'_sample' if sampled else ''}"
