"""Secrets in texts, with DataFrame functions only.

Fixed patterns find assignments, access keys and long hexadecimal strings. Beside them,
candidate strings are read by character class in a sliding window whose Shannon entropy is
kept up by incremental counts: a step changes the count of one entering and one leaving
character, and adds the difference of count * log2(count) for these alone. Known harmless
forms suppress a candidate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "entropy")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}"
WINDOW = 16
#: Least entropy, in bits a character, of the best window, by the candidate's character class.
THRESHOLDS = {"digits": 3.2, "hex": 2.9, "letters": 3.9, "mixed": 3.4}
#: Harmless forms: a candidate that matches one whole or holds one of the words is let go.
ALLOWED = (
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"(?i)example|sample|dummy|placeholder|changeme|your[_-]|xxxx|0123456789|abcdefgh",
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[0-9_-]*$",
    r"^[A-Za-z]+(?:[-_/][A-Za-z]+)+$",
)


def _matches(text: Column, pattern: str, also: int | None = None) -> Column:
    """Array of (start, end, value): the pattern's matches; value is the match or group ``also``.

    The text is split at the matches; a match starts after all gaps and matches before it.
    Nothing but the test for a match runs where there is none.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    values = found if also is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(also))
    kind = "array<struct<start:bigint,end:bigint,value:string>>"
    rows = F.arrays_zip(F.transform(gaps, F.length).alias("gap"), found.alias("match"), values.alias("value"))
    start = F.struct(F.array().cast(kind).alias("spans"), F.lit(0).cast("bigint").alias("at"))

    def put(state, row):
        begin = state["at"] + row["gap"]
        end = begin + F.coalesce(F.length(row["match"]), F.lit(0))
        span = F.struct(begin.alias("start"), end.alias("end"), row["value"].alias("value"))
        return F.struct(F.when(row["match"].isNotNull(), F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
                        end.alias("at"))

    return F.when(F.regexp_like(text, F.lit(pattern)), F.aggregate(rows, start, put, lambda s: s["spans"])).otherwise(
        F.array().cast(kind))


def window_entropy(value: Column, window: int = WINDOW) -> Column:
    """Highest Shannon entropy, in bits, of any ``window`` characters in a row of an ASCII string."""
    log = F.array(*(F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)))
    f = lambda c: F.element_at(log, c + 1)
    codes = F.transform(F.split(value, ""), lambda c: F.ascii(c) % 128)
    steps = F.transform(codes, lambda c, i: F.struct(
        c.alias("new"), F.when(i >= window, F.element_at(codes, F.greatest(i - window + 1, F.lit(1)))).otherwise(-1).alias("old"),
        (i >= window - 1).alias("full")))
    start = F.struct(F.array_repeat(F.lit(0), 128).alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("best"))

    def step(state, x):
        enters, leaves = F.element_at(state["n"], x["new"] + 1), F.element_at(state["n"], F.greatest(x["old"], F.lit(0)) + 1)
        change = F.when(x["new"] == x["old"], 0.0).otherwise(
            f(enters + 1) - f(enters) + F.when(x["old"] >= 0, f(F.greatest(leaves - 1, F.lit(0))) - f(leaves)).otherwise(0.0))
        total = state["s"] + change
        counts = F.transform(state["n"], lambda c, i: c + F.when(i == x["new"], 1).otherwise(0) - F.when(i == x["old"], 1).otherwise(0))
        entropy = F.lit(math.log2(window)) - total / window
        return F.struct(counts.alias("n"), total.alias("s"),
                        F.when(x["full"], F.greatest(state["best"], entropy)).otherwise(state["best"]).alias("best"))

    return F.aggregate(steps, start, step, lambda s: s["best"])


def character_class(value: Column) -> Column:
    return (F.when(value.rlike("^[0-9]+$"), "digits").when(value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), "hex")
            .when(value.rlike("^[A-Za-z]+$"), "letters").otherwise("mixed"))


def _entropy_spans(text: Column) -> Column:
    allowed = lambda v: F.array_contains(F.array(*(v.rlike(p) for p in ALLOWED)), True)
    least = lambda v: F.element_at(F.create_map(*(F.lit(x) for kv in THRESHOLDS.items() for x in kv)), character_class(v))
    # a window of letters alone can hold such entropy only with both cases or many different letters
    dull = lambda v: v.rlike("^(?:[a-z]+|[A-Z][a-z]+)$")
    return F.filter(_matches(text, CANDIDATE), lambda s: F.when(dull(s["value"]) | allowed(s["value"]), False).otherwise(
        window_entropy(s["value"]) >= least(s["value"])))


def with_secrets(docs: DataFrame, text_col: str = "text", out: str = "secrets") -> DataFrame:
    """Add an array of (kind, start, end), by start, then kind as in ``KINDS``; code points, ends exclusive.

    Null and empty texts have none. Every row is handled by itself without a shuffle; a column
    named ``out`` is replaced, all others stay as they are. Entropy spans stand beside the
    base ones, also where they overlap.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = lambda spans, kind: F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("k"), F.lit(kind).alias("kind"), s["end"].alias("end")))
    assigned = F.filter(_matches(text, ASSIGN, also=2), lambda s: F.length(s["value"]) >= 8)
    spans = F.concat(named(assigned, "assign"), named(_matches(text, ACCESS), "access"), named(_matches(text, HEX), "hex"),
                     named(_entropy_spans(text), "entropy"))
    ordered = F.transform(F.array_sort(spans), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return docs.withColumn(out, ordered)
