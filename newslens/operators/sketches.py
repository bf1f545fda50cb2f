"""Word statistics that add up: sketches per day and category, united for any range of dates.

A table of sketches is built once, and grows by a row per day and category. Any report over a
range of days then reads those rows rather than the texts. Distinct words come from HyperLogLog
sketches, frequent words from frequent-item sketches; counts and lengths are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newslens.functions import text

#: Of a distinct count's sketch: 2 to this many registers; the relative standard error is about 1.04 / sqrt(2 ** LG_REGISTERS).
LG_REGISTERS = 14
#: Words that a frequent-item sketch keeps; a count is off by at most 3.5 / ITEMS of all words (the sketch's stated bound is below that).
ITEMS = 16_384


def daily_sketches(df: DataFrame, text_col: str = "text", date: str = "date", key: str = "category") -> DataFrame:
    """(day, key, articles, length, words, distinct, frequent): one row per day and category, in one pass.

    Words are lower-cased. Null texts count as articles without words; rows without a date or a
    category are left out. The words of a group meet as sketches of bounded size, one per task.
    """
    dated = df.where(F.col(date).isNotNull() & F.col(key).isNotNull()).select(
        F.to_date(date).alias("day"), key, F.col(text_col).alias("_text"))
    word = F.posexplode_outer(text.words(F.lower(text.or_empty(F.col("_text")))))
    exploded = dated.select("day", key, F.coalesce(F.length("_text"), F.lit(0)).alias("_length"), word.alias("_pos", "_word"))
    first = F.coalesce(F.col("_pos"), F.lit(0)) == 0
    return exploded.groupBy("day", key).agg(
        F.count(F.when(first, 1)).alias("articles"), F.sum(F.when(first, F.col("_length")).otherwise(0)).alias("length"),
        F.count("_word").alias("words"), F.hll_sketch_agg("_word", LG_REGISTERS).alias("distinct"),
        F.call_function("approx_top_k_accumulate", F.col("_word"), F.lit(ITEMS)).alias("frequent"))


def united(sketches: DataFrame, *keys: str, within: Column | None = None) -> DataFrame:
    """(keys, articles, mean_length, words, distinct, frequent) over the days ``within``, by any of day and category."""
    rows = sketches if within is None else sketches.where(within)
    # the constant key keeps tasks without rows from handing on empty sketches; no days give no row
    return rows.groupBy(*keys, F.lit(0).alias("_all")).agg(
        F.sum("articles").alias("articles"), (F.sum("length") / F.sum("articles")).alias("mean_length"), F.sum("words").alias("words"),
        F.hll_union_agg("distinct").alias("distinct"), F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(ITEMS)).alias("frequent")).drop("_all")


def distinct_words(rows: DataFrame, name: str = "distinct_words") -> DataFrame:
    return rows.withColumn(name, F.hll_sketch_estimate("distinct")).drop("distinct")


def frequent_words(rows: DataFrame, top: int, *keys: str) -> DataFrame:
    """(keys, term, n): the most frequent words by the sketches' counts."""
    found = F.call_function("approx_top_k_estimate", F.col("frequent"), F.lit(top))
    return rows.select(*keys, F.inline(found)).withColumnsRenamed({"item": "term", "count": "n"})
