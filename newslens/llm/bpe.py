"""Byte-level BPE encoding and decoding by corpus-level merge replay.

Each Arrow batch of documents is a corpus: its texts are split into pre-tokens, equal ones are
kept once, and all merges are replayed over these distinct words in rank order. An inverted
index from merge rank to symbol positions names the places a merge applies to; a merge
touches those and the two pairs beside each, which join the index under their own ranks.
The encoding of a word does not depend on other words, so batches need no exchange: a
shuffle of every pre-token to one corpus-wide table would move several times the input.
Ids are decoded again and compared with the text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from newslens.llm.text import buffers, fresh, mix

#: The pre-token pattern that ``split`` handles on arrays; others go through ``regex``.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CORPUS_BYTES = 1 << 24
WINDOW = 1 << 20
_NONE = np.int32(2**31 - 1)
_LETTER, _NUMBER, _SPACE, _OTHER = 0, 1, 2, 3
#: Characters with the property White_Space.
WHITE_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(1)
def _kinds() -> np.ndarray:
    """Letter, number, white space or other, for every code point."""
    kinds = np.full(sys.maxunicode + 1, _OTHER, np.uint8)
    category = unicodedata.category
    first = np.array([category(chr(c))[0] for c in range(sys.maxunicode + 1)])
    kinds[first == "L"] = _LETTER
    kinds[first == "N"] = _NUMBER
    kinds[WHITE_SPACE] = _SPACE
    return kinds


class Ranks:
    """A vocabulary's merges: rank of a pair of tokens, bytes of a token. Token ids are ranks."""

    def __init__(self, path: str, pattern: str = PATTERN):
        self.pattern = pattern
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        top = max(ranks.values()) + 1
        pieces = [b""] * top
        for token, rank in ranks.items():
            pieces[rank] = token
        self.sizes = np.array([len(x) for x in pieces], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.width = top
        found = [(a * top + b, r) for token, r in ranks.items() for i in range(1, len(token))
                 if (a := ranks.get(token[:i])) is not None and (b := ranks.get(token[i:])) is not None]
        pairs = np.array(sorted(found), np.int64).reshape(-1, 2)
        # open addressing by linear probing, filled in vector steps
        self.bits = max(4, int(np.ceil(np.log2(len(pairs) * 3 + 1))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, _NONE, np.int32)
        self.probes = 0
        key, value = pairs[:, 0], pairs[:, 1].astype(np.int32)
        slot = self._slot(key)
        while len(key):
            free = self.keys[slot] < 0
            at, pick = np.unique(slot[free], return_index=True)
            pick = np.flatnonzero(free)[pick]
            self.keys[at], self.values[at] = key[pick], value[pick]
            left = np.ones(len(key), bool)
            left[pick] = False
            key, value, slot = key[left], value[left], (slot[left] + 1) & ((1 << self.bits) - 1)
            self.probes += 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of tokens, or ``_NONE``."""
        key = a.astype(np.int64) * self.width + b
        slot = self._slot(key)
        seen = self.keys[slot]
        rank = np.where(seen == key, self.values[slot], _NONE)
        todo = np.flatnonzero((seen != key) & (seen >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            seen = self.keys[slot[todo]]
            hit = seen == key[todo]
            rank[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (seen >= 0)]
        return rank

    def encode_word(self, word: bytes) -> list[int]:
        """One word by repeated lowest-rank, leftmost merges: for words the replay sets aside."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], _NONE), i) for i in range(len(parts) - 1))
            if rank == _NONE:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, as an array."""
        return ragged(self.bytes, self.starts[ids], self.sizes[ids])


@lru_cache(2)
def load_ranks(path: str, pattern: str) -> Ranks:
    return Ranks(path, pattern)


def ragged(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[starts[i] : starts[i] + sizes[i]] of every i, one after another."""
    before = np.cumsum(sizes) - sizes
    return values[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


def split(data: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Byte positions where pre-tokens begin in UTF-8 ``data``; ``fresh`` marks where texts begin."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    kind, fresh = _kinds()[points], fresh[at]
    n = len(points)
    begins = np.ones(n, bool)
    begins[1:] = (kind[1:] != kind[:-1]) | fresh[1:]
    begins[0] = True
    last = np.ones(n, bool)  # of a run
    last[:-1] = begins[1:]
    follows = np.zeros(n, bool)  # something else than white space comes next in the text
    follows[:-1] = (kind[1:] != _SPACE) & ~fresh[1:]
    alone = (kind == _SPACE) & last & follows
    # the last white space before other characters stands alone, or leads the next run if it is a blank
    starts = begins | alone
    lead = np.flatnonzero(alone & (points == 0x20))
    starts[lead + 1] = False
    tick = np.flatnonzero(starts & (points == 0x27))
    for ending in ("s", "t", "re", "ve", "m", "ll", "d"):
        reach = len(ending)
        ok = tick[tick + reach < n]
        for i, c in enumerate(ending, 1):
            ok = ok[(points[ok + i] == ord(c)) & ~fresh[ok + i]]
        starts[ok + 1] = False
        after = ok[ok + reach + 1 < n] + reach + 1
        starts[after[(kind[after] == _LETTER) & ~fresh[after]]] = True
    return at[starts]


def split_by_pattern(data: np.ndarray, offsets: np.ndarray, pattern: str) -> np.ndarray:
    """As ``split``, for any pattern; what it does not match is not encoded, so it must match everything."""
    find, raw, starts = regex.compile(pattern), data.tobytes(), []
    for low, high in zip(offsets[:-1], offsets[1:]):
        at = int(low)
        for piece in find.findall(raw[low:high].decode()):
            starts.append(at)
            at += len(piece.encode())
        if at != high:
            raise ValueError("the pattern leaves out part of a text")
    return np.array(starts, np.int64)


def _cuts(data: np.ndarray, offsets: np.ndarray) -> list[int]:
    """Window ends: at text ends, or before a blank between two ASCII letters within long texts."""
    cuts, at, total = [0], 0, len(data)
    while at < total:
        end = at + WINDOW
        if end >= total:
            cuts.append(total)
            break
        i = int(np.searchsorted(offsets, end, "right")) - 1
        if offsets[i] > at:
            end = int(offsets[i])
        else:
            low = end - WINDOW // 2
            letter = (data[low - 1 : end + 1] | 0x20) - 97 < 26
            found = np.flatnonzero(letter[:-2] & (data[low:end] == 0x20) & letter[2:])
            end = low + int(found[-1]) if len(found) else int(offsets[i + 1])
        cuts.append(end)
        at = end
    return cuts


def _hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    weights = mix(place.astype(np.uint64) * np.uint64(2) + np.uint64(1)) if sizes.max() > len(_WEIGHTS) else _WEIGHTS[place]
    values = mix(data.astype(np.uint64) + np.uint64(77)) if len(data) < 256 else _BYTES[data]
    return mix(np.add.reduceat(values * weights, starts) + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_WEIGHTS = mix(np.arange(4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
_BYTES = mix(np.arange(256, dtype=np.uint64) + np.uint64(77))


def replay(symbols: np.ndarray, starts: np.ndarray, ranks: Ranks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge the symbols of all words; (tokens, offset of each word's tokens, words set aside).

    A pair can appear below the rank in hand only in vocabularies where a token has a split
    of higher rank than itself; such words are set aside for ``encode_word``.
    """
    n, words = len(symbols), len(starts)
    token = symbols.copy()
    after = np.arange(1, n + 1, dtype=np.int32)
    before = np.arange(-1, n - 1, dtype=np.int32)
    ends = np.append(starts[1:], n) - 1
    after[ends], before[starts] = -1, -1
    rank = np.full(n, _NONE, np.int32)
    inner = np.flatnonzero(after >= 0)
    rank[inner] = ranks.pair_rank(token[inner], token[inner + 1])
    alive = np.ones(n, bool)
    listed = inner[rank[inner] != _NONE].astype(np.int32)
    listed = listed[np.argsort(rank[listed], kind="stable")]
    values, first = np.unique(rank[listed], return_index=True)
    index = {int(r): [places] for r, places in zip(values, np.split(listed, first[1:]))}
    heap = list(index)
    heapq.heapify(heap)
    aside = []
    while heap:
        now = heapq.heappop(heap)
        places = index.pop(now)
        places = places[0] if len(places) == 1 else np.unique(np.concatenate(places))
        places = places[rank[places] == now]
        if not len(places):
            continue
        if len(places) > 1:
            chained = np.flatnonzero(after[places[:-1]] == places[1:]) + 1
            if len(chained):  # overlapping pairs: every second one of a chain, from the left
                heads = np.ones(len(places), bool)
                heads[chained] = False
                order = np.arange(len(places))
                places = places[(order - np.maximum.accumulate(np.where(heads, order, 0))) % 2 == 0]
        gone = after[places]
        then = after[gone]
        token[places], after[places], alive[gone], rank[gone] = now, then, False, _NONE
        has = then >= 0
        before[then[has]] = places[has]
        fresh = np.full(len(places), _NONE, np.int32)
        fresh[has] = ranks.pair_rank(token[places[has]], token[then[has]])
        rank[places] = fresh
        left = before[places]
        left = left[left >= 0]
        beside = ranks.pair_rank(token[left], token[after[left]])
        rank[left] = beside
        where, what = np.concatenate([places, left]), np.concatenate([fresh, beside])
        keep = what != _NONE
        where, what = where[keep], what[keep]
        early = what < now
        if early.any():
            aside.append(where[early])
            where, what = where[~early], what[~early]
        if not len(where):
            continue
        if len(where) > 1:
            order = np.argsort(what, kind="stable")
            where, what = where[order], what[order]
        bounds = [0, *(np.flatnonzero(what[1:] != what[:-1]) + 1).tolist(), len(where)]
        for low, high in zip(bounds, bounds[1:]):
            r = int(what[low])
            if r in index:
                index[r].append(where[low:high])
            else:
                index[r] = [where[low:high]]
                heapq.heappush(heap, r)
    kept = np.cumsum(alive)
    sizes = kept[ends] - np.concatenate([[0], kept[ends[:-1]]])
    late = np.searchsorted(starts, np.unique(np.concatenate(aside)), "right") - 1 if aside else np.zeros(0, np.int64)
    return token[alive], np.concatenate([[0], np.cumsum(sizes)]), np.unique(late)


def encode_corpus(data: np.ndarray, offsets: np.ndarray, ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets of each text's ids) of texts given as UTF-8 bytes and offsets."""
    none = np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    if not len(data):
        return none
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    if ranks.pattern == PATTERN:
        cuts = _cuts(data, offsets)
        starts = np.concatenate([split(data[a:b], fresh[a:b]) + a for a, b in zip(cuts, cuts[1:])])
    else:
        starts = split_by_pattern(data, offsets, ranks.pattern)
    sizes = np.diff(starts, append=len(data))
    codes = np.empty(len(starts), np.uint64)
    edges = np.searchsorted(starts, np.arange(0, len(data) + WINDOW, WINDOW))
    for low, high in zip(edges, edges[1:]):
        if high > low:
            begin, end = starts[low], starts[high - 1] + sizes[high - 1]
            codes[low:high] = _hashes(data[begin:end], starts[low:high] - begin, sizes[low:high])
    _, first, word = np.unique(codes, return_index=True, return_inverse=True)
    symbols = ranks.single[ragged(data, starts[first], sizes[first])]
    tokens, token_at, late = replay(symbols, np.cumsum(sizes[first]) - sizes[first], ranks)
    token_at, counts = token_at[:-1], np.diff(token_at)
    for w in late:
        own = ranks.encode_word(data[starts[first[w]] : starts[first[w]] + sizes[first[w]]].tobytes())
        token_at[w], counts[w] = len(tokens), len(own)
        tokens = np.concatenate([tokens, np.array(own, np.int32)])
    per_word = counts[word]
    ids = np.concatenate([ragged(tokens, token_at[w], counts[w]) for w in np.array_split(word, len(word) // WINDOW + 1)])
    ends = np.concatenate([[0], np.cumsum(per_word)])
    return ids, ends[np.searchsorted(starts, offsets)]


def encode(texts: pa.Array, ranks: Ranks):
    """Per text (ids, decoded bytes), corpus by corpus."""
    data, offsets = buffers(texts)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + CORPUS_BYTES, "right")) - 1)
        part, bounds = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        ids, at = encode_corpus(part, bounds, ranks)
        for i in range(high - low):
            own, text = ids[at[i] : at[i + 1]], part[bounds[i] : bounds[i + 1]]
            decoded = ranks.decode(own)
            if not np.array_equal(decoded, text):  # two words shared a hash
                raise ValueError("ids do not decode to their text")
            yield own, decoded.tobytes()
        low = high


def _over(docs: DataFrame, text_col: str, path: str, pattern: str, fields: list[StructField], make) -> DataFrame:
    names = [f.name for f in fields]
    kept = [c for c in docs.columns if c not in names]
    source = docs.select(*kept, F.col(text_col).cast("binary").alias(fresh("_text", kept)))
    schema = StructType([*docs.select(*kept).schema.fields, *fields])

    def run(batches):
        ranks = load_ranks(path, pattern)
        for batch in batches:
            if batch.num_rows:
                columns = make(encode(batch.column(len(kept)), ranks))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*kept, *names])

    return source.mapInArrow(run, schema)


def encode_documents(docs: DataFrame, path: str, text_col: str = "text", pattern: str = PATTERN) -> DataFrame:
    """Add ``ids`` (array of int) and ``decoded`` (binary); columns of those names are replaced.

    ``path`` is the rank file, read by every worker. Null and empty texts have no ids and decode
    to nothing. Special tokens' strings are ordinary text. Rows that repeat are encoded each.
    """

    def make(encoded):
        ids, decoded = zip(*encoded)
        at = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
        return [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(ids), pa.int32())),
                pa.array(decoded, pa.binary())]

    return _over(docs, text_col, path, pattern, [StructField("ids", ArrayType(IntegerType())), StructField("decoded", BinaryType())], make)


def encode_digests(docs: DataFrame, path: str, text_col: str = "text", pattern: str = PATTERN) -> DataFrame:
    """As ``encode_documents``, with the ids' number and the SHA-256 of ids and decoded bytes instead:
    ``n_tokens``, ``ids_sha256`` (ids as little-endian unsigned 32-bit integers), ``decoded_sha256``."""
    from pyspark.sql.types import LongType, StringType

    def make(encoded):
        rows = [(len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(out).hexdigest())
                for ids, out in encoded]
        n, a, b = zip(*rows)
        return [pa.array(n, pa.int64()), pa.array(a), pa.array(b)]

    fields = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    return _over(docs, text_col, path, pattern, fields, make)
