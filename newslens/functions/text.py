"""Cleaning, counting and dating expressions.

Regular expressions name their character classes explicitly because Java's
``\\s`` and ``\\w`` are ASCII-only while articles are multilingual.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from newslens.functions.wordlists import (
    CONTRACTIONS, NEGATIVE_FROM, PATTERN_KEYS, POSITIVE_FROM,
)

# --- fixed values: the patterns of the cleaning steps ---
# Unicode white space, as the body of a character class.
SPACE = r"\t-\r\x{1C}-\x{20}\x{85}\p{Z}"
# Word characters of the term analyser (letters, numbers, underscore).
TERM = r"[\p{L}\p{N}_]{2,}"
# What parts such runs.
NOT_TERM = r"[^a-z0-9_\p{L}\p{N}]++"
URL = rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+"
TAG = r"<[^>\n]*>"
UNWANTED = rf"[^a-zA-Z0-9'{SPACE}.,!?\x22-]"
QUOTED = r'"([^"]*)"'
# --- end of fixed values ---


def strip(text: Column) -> Column:
    """Remove leading and trailing white space (any Unicode space)."""
    return F.regexp_replace(text, rf"\A[{SPACE}]+|[{SPACE}]+\z", "")


def or_empty(text: Column) -> Column:
    """Null becomes the empty string."""
    return F.coalesce(text, F.lit(""))


def combine(headline: Column, description: Column) -> Column:
    """One text per article: both parts around a full stop, stripped."""
    return strip(F.concat(or_empty(headline), F.lit(" . "), or_empty(description)))


def combine_stripped(headline: Column, description: Column) -> Column:
    """The scoring form of :func:`combine`: each part stripped first."""
    return F.concat(strip(headline), F.lit(" . "), strip(description))


def expand_contractions(text: Column) -> Column:
    for short, long in CONTRACTIONS:
        text = F.replace(text, F.lit(short), F.lit(long))
    return text


def quoted_spans(text: Column) -> Column:
    """Texts between double quotes, empty ones included."""
    return F.regexp_extract_all(text, F.lit(QUOTED), F.lit(1))


def remove_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, "")


def remove_tags(text: Column) -> Column:
    return F.regexp_replace(text, TAG, "")


def keep_plain_characters(text: Column) -> Column:
    """Keep ASCII letters, digits, white space and basic punctuation."""
    return F.regexp_replace(text, UNWANTED, "")


def collapse_spaces(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, rf"[{SPACE}]+", " "))


def scrub(text: Column) -> Column:
    """URLs, tags and unwanted characters out; white space collapsed."""
    return collapse_spaces(keep_plain_characters(remove_tags(remove_urls(text))))


def count_words(text: Column) -> Column:
    """Number of white-space separated words; null and '' count 0."""
    return F.coalesce(F.regexp_count(text, F.lit(rf"[^{SPACE}]+")), F.lit(0))


def words(text: Column) -> Column:
    """White-space separated words."""
    return F.regexp_extract_all(text, F.lit(rf"[^{SPACE}]+"), F.lit(0))


def count_unique_words(text: Column) -> Column:
    return F.size(F.array_distinct(words(or_empty(text))))


def null_markers_to_null(text: Column, markers: list[str]) -> Column:
    return F.when(~F.btrim(text).isin(markers), text)


def month_label(date: Column) -> Column:
    """'yyyy-MM' of a date or timestamp."""
    return F.date_format(date, "yyyy-MM")


def date_or_today(date: Column, today: str | None = None) -> Column:
    """The given date text, or today's where it is missing or empty."""
    default = F.lit(today) if today else F.date_format(F.current_date(), "yyyy-MM-dd")
    return F.coalesce(F.when(date != "", date), default)


def sentiment_label(compound: Column) -> Column:
    return (
        F.when(compound >= POSITIVE_FROM, "positive")
        .when(compound <= NEGATIVE_FROM, "negative")
        .otherwise("neutral")
    )


def complete_patterns(patterns: dict[str, Column]) -> Column:
    """Struct of all pattern lists; a missing or null list becomes empty."""
    empty = F.array().cast("array<string>")
    return F.struct(
        *[F.coalesce(patterns.get(k, empty), empty).alias(k) for k in PATTERN_KEYS]
    )


def pattern_counts(patterns: Column) -> list[Column]:
    """One ``pattern_<key>_count`` column per pattern list."""
    return [F.size(patterns[k]).alias(f"pattern_{k}_count") for k in PATTERN_KEYS]
