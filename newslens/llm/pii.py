"""Personal data in texts: patterns propose spans, checksums confirm them, context words score them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, StructType

from newslens.llm.text import fresh

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "short_card", "national")
#: Characters on either side in which context words count.
CONTEXT = 48
#: Score without context, with a context word, and the least score at which an added kind is reported.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "short_card": 0.3, "national": 0.3}
BONUS, LEAST = 0.4, 0.5
WORDS = {
    "email": "mail email e-mail contact correo courriel kontakt",
    "ip": "ip address host server client login adresse",
    "card": "card visa mastercard amex credit debit payment karte carte tarjeta cvv",
    "phone": "phone tel telephone call mobile cell fax telefon téléphone teléfono",
    "iban": "iban bank account transfer konto compte cuenta",
    "short_card": "card visa amex credit debit payment karte carte tarjeta cvv",
    "national": "ssn social security insurance national seguridad sécurité sozialversicherung",
}

_EMAIL_TAIL = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+", re.ASCII)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_NEAR = {kind: re.compile(r"(?<!\w)(?:" + "|".join(words.split()) + r")(?!\w)", re.IGNORECASE) for kind, words in WORDS.items()}
_SEPARATORS = str.maketrans("", "", " -().+")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether the account number's letters and digits leave 1 when divided by 97."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        tail = _EMAIL_TAIL.match(text, at + 1) if start < at else None
        if tail:
            yield start, tail.end()
        done = tail.end() if tail else at + 1
        at = text.find("@", done)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in _IBAN.finditer(text):
        end = m.end()
        while end - m.start() >= 15:  # words in capitals may follow: give up blocks from the right
            number = text[m.start() : end].replace(" ", "")
            if 15 <= len(number) <= 34 and mod97(number):
                yield m.start(), end
                break
            end = text.rfind(" ", m.start(), end)


def _proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Confirmed spans of every kind."""
    for span in _emails(text):
        yield "email", *span
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            yield "ip", *m.span()
    for m in _CARD.finditer(text):
        digits = m[0].translate(_SEPARATORS)
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield "card" if len(digits) >= 16 else "short_card", *m.span()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(m[0].translate(_SEPARATORS)) <= 15:
                yield "phone", *m.span()
    for span in _ibans(text):
        yield "iban", *span
    for m in _NATIONAL.finditer(text):
        if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
            yield "national", *m.span()


_ANY = re.compile(r"[0-9@]")


def find_pii(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of one text, by kind as in ``KINDS``, then start; ends are exclusive.

    Base kinds are reported whatever their score, the others from ``LEAST`` on.
    """
    if not _ANY.search(text):
        return []
    found = []
    for kind, start, end in _proposals(text):
        near = _NEAR[kind].search(text[max(0, start - CONTEXT) : start] + "\n" + text[end : end + CONTEXT])
        score = min(1.0, PRIOR[kind] + (BONUS if near else 0.0))
        if kind in BASE or score >= LEAST:
            found.append((kind, start, end, round(score, 2)))
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1]))


SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"
_KIND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def with_pii(docs: DataFrame, text_col: str = "text", out: str = "pii") -> DataFrame:
    """Add the spans found in each whole text, offsets in code points.

    Null and empty texts have no spans. Every row is handled by itself, in one pass without a
    shuffle; a column named ``out`` is replaced, all others stay as they are.
    """
    kept = [c for c in docs.columns if c != out]
    source = docs.select(*kept, F.col(text_col).alias(fresh("_text", kept)))
    schema = StructType([*docs.select(*kept).schema.fields]).add(out, DataType.fromDDL(SPANS))

    def run(batches):
        for batch in batches:
            texts = batch.column(len(kept))
            spans = [[dict(zip(("kind", "start", "end", "score"), s)) for s in find_pii(t.as_py() or "")] for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(spans, _KIND)], names=[*kept, out])

    return source.mapInArrow(run, schema)


def spans_text(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined in their order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with every span's place taken by its kind in brackets; overlapping spans count as one."""
    by_start = F.array_sort(spans, lambda a, b: F.signum(a["start"] - b["start"]).cast("int"))
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("bigint").alias("at"))

    def put(state, s):
        gap = F.when(s["start"] >= state["at"], F.concat(
            F.substring(text, state["at"].cast("int") + 1, (s["start"] - state["at"]).cast("int")), F.lit("["), s["kind"], F.lit("]"))).otherwise("")
        return F.struct(F.concat(state["done"], gap).alias("done"), F.greatest(state["at"], s["end"]).alias("at"))

    return F.aggregate(by_start, start, put, lambda state: F.concat(
        state["done"], F.substring(text, state["at"].cast("int") + 1, F.length(text))))
