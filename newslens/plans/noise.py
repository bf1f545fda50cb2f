"""Documents rewritten so that every cleaning and scoring rule has something to do.

The test documents hold no contractions, links or opinion words, so some of
their frequent letter groups and words are replaced by such material, on the
Spark side and on the SQL side alike.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CLEANING_NOISE = [
    ("tion", "n't"), ("ing ", "'s "), ("ent ", "'ll "), (" the ", " https://a.b/c?d=1 "),
    (" la ", " WWW.x.org/q "), (" of ", " <b>of</b> "), ("|", '"'), (" und ", ' "" '), (" der ", "  \t "),
]
MOOD_NOISE = [
    (" the ", " good "), (" and ", " BAD "), (" of ", " not "), (" de ", " VERY "), (" der ", " great! "),
    (" to ", " no "), (" la ", " never "), (" in ", " so "), (" is ", " terrible?? "), (" that ", " but "),
    (" und ", " least "), (" for ", " hardly "), (" it ", " without "), (" die ", " doubt "), (" on ", " love, "),
    (" le ", " kind "), (" des ", " of "), (" was ", " or "), (" que ", " isn't "), (" en ", " hate "), (" el ", " kind of "), (" los ", " yeah right love "), (" del ", " to die for great "),
    (" y ", " broken heart good "), (" se ", " sort of great "),
]


def noisy(text: Column, noise: list[tuple[str, str]]) -> Column:
    for old, new in noise:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def noisy_sql(column: str, noise: list[tuple[str, str]]) -> str:
    for old, new in noise:
        column = f"replace({column}, {quote(old)}, {quote(new)})"
    return column


def quote(value: str) -> str:
    return "'" + value.replace("'", "''").replace("\t", "' || chr(9) || '") + "'"
