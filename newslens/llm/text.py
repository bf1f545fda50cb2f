"""Word hashes of whole texts, computed on Arrow buffers.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z lower-cased. Words are
compared by a 64-bit polynomial hash over random byte codes, mixed with their length; no
word is ever built as a Python object.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes handled at once; the temporary arrays take about 40 times as much.
WINDOW = 1 << 20

_GAP = np.zeros(256, bool)
_GAP[[0x20, 9, 10, 11, 12, 13]] = True
_CODES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_CODES[65:91] = _CODES[97:123]
_BASE = 0x9E3779B97F4A7C55
_powers = np.ones(1, np.uint64)


def _powers_up_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 256), np.uint64(_BASE))
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; nulls are empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data[:0], offsets - offsets[:1]


def word_hashes(texts: pa.Array, gap: np.ndarray = _GAP) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, offsets of each text's words); ``gap`` marks the bytes that no word holds."""
    data, offsets = buffers(texts)
    total = len(data)
    at_start = np.zeros(total + 1, bool)
    at_start[offsets] = True
    hashes, places, begin = [], [], 0
    while begin < total:
        end = min(begin + WINDOW, total)
        while end < total:  # a window ends where a word does
            cut = gap[data[end : end + WINDOW]] | at_start[end : end + WINDOW][: total - end]
            found = int(np.argmax(cut))
            end += found if cut[found] else len(cut)
            if cut[found]:
                break
        window, fresh = data[begin:end], at_start[begin:end]
        inside = ~gap[window]
        first = inside.copy()
        first[1:] &= ~inside[:-1] | fresh[1:]
        starts = np.flatnonzero(first)
        if len(starts):
            letters = window[inside]
            at = (np.cumsum(inside) - 1)[starts]
            sizes = np.diff(at, append=len(letters))
            place = np.arange(len(letters)) - np.repeat(at, sizes)
            values = _CODES[letters] * _powers_up_to(int(sizes.max()))[place]
            hashes.append(mix(np.add.reduceat(values, at) + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
            places.append(starts + begin)
        begin = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), offsets)


def per_batch(df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``make`` to every Arrow batch of the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield make(batch)

    return df.mapInArrow(run, schema)


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def fresh(name: str, columns: list[str]) -> str:
    """``name``, or a longer one that no column has."""
    while name in columns:
        name = f"_{name}"
    return name
