"""The articles view over the ``documents`` table, in Spark and as a SQL CTE.

First line = headline, everything after it = description, source = category,
and a date spread over 2012-2022 by document id.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from newslens.session import spread
from newslens.sources.files import read_table


def _view(raw: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    first = F.split_part(F.col("text"), F.lit("\n"), F.lit(1))
    view = raw.select(
        "doc_id",
        first.alias("headline"),
        F.substr(F.col("text"), F.length(first) + 2).alias("short_description"),
        F.col("source").alias("category"),
        "lang",
        F.date_add(F.lit("2012-01-01").cast("date"), (F.col("doc_id") % 3900).cast("int")).alias("date"),
        "text",
    )
    return view.select(*columns) if columns else view


def articles(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Articles in the stored partitioning; name columns to read only those."""
    return _view(read_table(spark, folder, "documents"), columns)


def text_articles(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Articles about to go through text expressions, dealt out as the session asks."""
    return _view(spread(read_table(spark, folder, "documents").select("doc_id", "text", "source", "lang")), columns)


ARTICLES_SQL = """articles AS (
  SELECT doc_id,
         split_part(text, chr(10), 1) AS headline,
         substr(text, length(split_part(text, chr(10), 1)) + 2) AS short_description,
         source AS category, lang,
         CAST(DATE '2012-01-01' + CAST(doc_id % 3900 AS INTEGER) AS DATE) AS date,
         text
  FROM documents)"""


def over_articles(body: str, *ctes: str) -> str:
    """SQL with the articles CTE (and any further ones) in front of ``body``."""
    return "WITH " + ",\n".join([ARTICLES_SQL, *ctes]) + "\n" + body
