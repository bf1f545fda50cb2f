"""Record-level curation: blanks, short texts, duplicates, category merging, rejects."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from newslens.functions import text
from newslens.functions.dictionary import Dictionary
from newslens.functions.wordlists import BLANK, CATEGORY_MERGES, NOT_TEXT


def blank_rows(df: DataFrame, headline: str = "headline", description: str = "short_description") -> DataFrame:
    """Rows whose two texts are both the empty string."""
    return df.where((F.col(headline) == "") & (F.col(description) == ""))


def with_word_counts(
    df: DataFrame, headline: str = "headline", description: str = "short_description"
) -> DataFrame:
    return df.withColumns({
        "headline_words": text.count_words(F.col(headline)),
        "description_words": text.count_words(F.col(description)),
    })


def is_short(min_words: int, headline: str = "headline", description: str = "short_description") -> Column:
    """True when both texts have fewer than ``min_words`` words."""
    return (text.count_words(F.col(headline)) < min_words) & (
        text.count_words(F.col(description)) < min_words
    )


def drop_short(df: DataFrame, min_words: int = 6) -> DataFrame:
    return df.where(~is_short(min_words))


def drop_incomplete(df: DataFrame, *columns: str) -> DataFrame:
    """Drop rows with a null in any of the columns."""
    return df.na.drop(subset=list(columns))


def in_date_range(df: DataFrame, start: str | None, end: str | None, column: str = "date") -> DataFrame:
    """Inclusive date range; unchanged unless both bounds are given."""
    if not (start and end):
        return df
    return df.where(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def with_highlight(df: DataFrame, selected: list[str], column: str = "category") -> DataFrame:
    """Flag rows of the selected categories; no selection highlights all."""
    flag = F.col(column).isin(selected) if selected else F.lit(True)
    return df.withColumn("highlighted", flag)


def merge_categories(
    df: DataFrame, merges: Mapping[str, str] = CATEGORY_MERGES, column: str = "category"
) -> DataFrame:
    """Replace merged categories in one pass; others pass through."""
    target = Dictionary(merges, "string").get(F.col(column))
    return df.withColumn(column, F.coalesce(target, F.col(column)))


def content_digest(*columns: str) -> Column:
    """A 256-bit digest of the columns' values; nulls differ from every value, and so do shifted texts.

    Grouping by it shuffles 32 bytes a row instead of whole texts.
    """
    parts = [F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-"))
             for v in (F.col(c).cast("string") for c in columns)]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def count_duplicates(df: DataFrame, *columns: str) -> DataFrame:
    """Number of rows that repeat an earlier row (nulls are equal)."""
    groups = df.groupBy(content_digest(*(columns or df.columns)).alias("_content")).count()
    return groups.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicated_rows"))


def keep_first(df: DataFrame, content: list[str], id_col: str) -> DataFrame:
    """One row per distinct content, the one with the smallest id; ids are unique.

    The minimum id is combined on the map side, so a text repeated across a
    third of the rows reaches its reducer as one row per task.
    """
    firsts = df.groupBy(content_digest(*content).alias("_content")).agg(F.min(id_col).alias(id_col))
    return df.join(firsts.select(id_col), id_col, "left_semi").select(*df.columns)


def split_rejects(df: DataFrame, checks: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows passing every check, and the others with the first failing check's name."""
    reason = F.coalesce(*[
        F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()
    ])
    marked = df.withColumn("reason", reason)
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(F.col("reason").isNotNull())


def with_request_error(df: DataFrame, headline: str = "headline", description: str = "short_description") -> DataFrame:
    """Add ``error`` (null when the request is valid) and ``success``."""
    missing = F.col(headline).isNull() | F.col(description).isNull()
    blank = (text.strip(F.col(headline)) == "") | (text.strip(F.col(description)) == "")
    error = F.when(missing, NOT_TEXT).when(blank, BLANK)
    return df.withColumn("error", error).withColumn("success", F.col("error").isNull())
