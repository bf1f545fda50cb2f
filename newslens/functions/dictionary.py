"""Constant dictionaries that can be probed inside column expressions.

A Spark map literal is searched linearly, so probing a few hundred words for
every token would be slow, and a join would force each article's tokens through
a shuffle and back. A dictionary here is an array of small maps; the key's crc32
picks the map, so a probe costs one hash and a short scan, inside the row. The
whole literal travels with the plan, hence the size limit.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Mapping

from pyspark.sql import Column, functions as F

MAX_ENTRIES = 200_000


class Dictionary:
    """An immutable word -> value table usable as ``dictionary.get(column)``."""

    def __init__(self, entries: Mapping[str, object], value_type: str):
        if len(entries) > MAX_ENTRIES:
            raise ValueError(
                f"{len(entries)} entries are too many for a plan literal "
                f"(limit {MAX_ENTRIES}); join the table instead"
            )
        self.size = len(entries)
        self.buckets = 1
        while self.buckets < max(1, self.size):
            self.buckets *= 2
        slots: list[dict[str, object]] = [{} for _ in range(self.buckets)]
        for word, value in entries.items():
            slots[zlib.crc32(word.encode("utf-8")) % self.buckets][word] = value
        self._json = json.dumps(slots)
        self._type = f"array<map<string,{value_type}>>"

    def get(self, word: Column) -> Column:
        """The value stored for ``word``, null when there is none."""
        table = F.from_json(F.lit(self._json), self._type)
        slot = F.pmod(F.crc32(word.cast("binary")), F.lit(self.buckets)).cast("int")
        return F.get(table, slot)[word]
