"""Profiles and aggregates for reporting.

Group keys that are null are left out, as in the data-frame idiom these reports
come from. Totals are scalar subqueries over the grouped rows, so no report
sends its rows through a single-partition window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newslens.functions import text

def n_rows() -> Column:
    return F.count(F.lit(1))


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, nulls), one row per column, in one pass."""
    sums = df.agg(*[F.coalesce(F.sum(F.col(c).isNull().cast("bigint")), F.lit(0)).alias(c) for c in df.columns])
    return sums.unpivot([], list(df.columns), "column_name", "nulls")


def columns_with_nulls(df: DataFrame) -> DataFrame:
    return null_counts(df).where(F.col("nulls") > 0)


def profile(df: DataFrame) -> DataFrame:
    """(column_name, non_null, total): the shape of a table."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns], n_rows().alias("_total"))
    long = counts.unpivot(["_total"], list(df.columns), "column_name", "non_null")
    return long.select("column_name", "non_null", F.col("_total").alias("total"))


def value_counts(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows per key combination, nulls left out."""
    return df.na.drop(subset=list(keys)).groupBy(*keys).agg(n_rows().alias(name))


def ranked_counts(df: DataFrame, key: str, top: int | None = None) -> DataFrame:
    """Value counts by falling count, then key; optionally the first ``top``."""
    ordered = value_counts(df, key).orderBy(F.desc("n"), key)
    return ordered.limit(top) if top is not None else ordered


def with_share(grouped: DataFrame, name: str = "share", scale: float = 1.0, count: str = "n") -> DataFrame:
    """Add each group's share of the total count."""
    total = grouped.agg(F.sum(count)).scalar()
    return grouped.withColumn(name, F.lit(scale) * F.col(count) / total)


def category_shares(df: DataFrame, key: str = "category") -> DataFrame:
    """Counts per category and their share of all rows (rows without one included)."""
    total = df.agg(n_rows()).scalar()
    return value_counts(df, key).withColumn("share", F.col("n") / total)


def mean_length(df: DataFrame, text_col: str = "text", key: str = "category") -> DataFrame:
    return df.na.drop(subset=[key]).groupBy(key).agg(F.avg(F.length(text_col)).alias("avg_length"))


def counts_by_year(df: DataFrame, years: list[int], key: str = "category", date: str = "date") -> DataFrame:
    """One row per category and one zero-filled column per year."""
    dated = df.na.drop(subset=[key]).withColumn("_year", F.year(date))
    return dated.groupBy(key).pivot("_year", years).agg(n_rows()).na.fill(0)


def counts_by_year_long(df: DataFrame, years: list[int], key: str = "category", date: str = "date") -> DataFrame:
    """The same in long form: (key, year, n), zeros included."""
    wide = counts_by_year(df, years, key, date)
    long = wide.unpivot([key], [str(y) for y in years], "year", "n")
    return long.withColumn("year", F.col("year").cast("int"))


def counts_by_month(df: DataFrame, key: str = "category", date: str = "date") -> DataFrame:
    """(year_month, category, n) with months as 'yyyy-MM'."""
    dated = df.select(text.month_label(F.col(date)).alias("year_month"), key)
    return value_counts(dated, "year_month", key)


def pos_totals(df: DataFrame, measures: list[str], key: str = "category") -> DataFrame:
    """Summed counts per category in long form: (key, measure, total)."""
    sums = df.na.drop(subset=[key]).groupBy(key).agg(*[F.sum(m).alias(m) for m in measures])
    return sums.unpivot([key], measures, "measure", "total")


def measure_over_time(df: DataFrame, measure: str, date: str = "date") -> DataFrame:
    return df.groupBy(date).agg(F.sum(measure).alias("total"), F.avg(measure).alias("mean"))


def measure_relation(df: DataFrame, x: str, y: str, key: str = "category") -> DataFrame:
    """How two measures move together per category."""
    return df.na.drop(subset=[key]).groupBy(key).agg(
        n_rows().alias("n"), F.avg(x).alias("mean_x"), F.avg(y).alias("mean_y"),
        F.covar_pop(x, y).alias("covariance"), F.corr(x, y).alias("correlation"),
    )


def word_frequencies(df: DataFrame, text_col: str, top: int | None = None) -> DataFrame:
    """White-space separated words by falling frequency."""
    exploded = df.select(F.explode(text.words(F.lower(F.col(text_col)))).alias("term"))
    return ranked_counts(exploded, "term", top)


def overview(df: DataFrame, key: str, length: Column, word_count: Column) -> DataFrame:
    return df.agg(
        n_rows().alias("articles"), F.countDistinct(key).alias("categories"),
        F.avg(length).alias("mean_length"), F.avg(word_count).alias("mean_words"),
    )


def overview_by_category(df: DataFrame, key: str, length: Column, word_count: Column) -> DataFrame:
    """(key, n, length, words): what ``overview`` and the largest categories are made of, in one pass."""
    return df.groupBy(key).agg(n_rows().alias("n"), F.sum(length).alias("length"), F.sum(word_count).alias("words"))


def summary(df: DataFrame, value: str) -> DataFrame:
    return df.agg(F.avg(value).alias("mean"), F.min(value).alias("lowest"), F.max(value).alias("highest"))


def filter_bounds(df: DataFrame, date: str = "date", key: str = "category") -> DataFrame:
    """Date range and the sorted distinct categories, one row per category."""
    bounds = df.agg(F.struct(F.min(date).alias("lo"), F.max(date).alias("hi"))).scalar()
    keys = df.na.drop(subset=[key]).select(key).distinct()
    return keys.select(key, bounds["lo"].alias("min_date"), bounds["hi"].alias("max_date")).orderBy(key)
