"""BPE encoding and decoding with content-defined chunks that are encoded once.

A rolling hash over the bytes cuts every text where its content says so, so that passages which
documents share are cut alike. Chunks are counted by digest over all documents; a filter of fixed
size tells the workers which ones may repeat. Of one that may, the text is sent to its digest's
place, encoded there once, and its ids meet the documents that hold it. Documents without such a
chunk are encoded where they are.

Cuts fall anywhere, also inside words. At every cut the words around it are encoded anew: the new
ids must begin and end with those of the words that guard the window on either side. If they do
not, the window takes in twice as many words; if it outgrows its chunks, they become one chunk.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from newslens.llm.text import _powers_up_to, buffers, fresh, mix
from newslens.session import materialize

#: A cut has this chance at a byte, is at least LEAST bytes after the one before and has LEAST_GAPS words since.
CHANCE_BITS, LEAST, LEAST_GAPS = 9, 64, 4
#: Bytes the rolling hash looks back on (a power of two).
REACH = 32
#: Bytes of text handled at once, and words whose ids a worker remembers.
PIECE, REMEMBERED = 1 << 20, 1 << 20
#: Bits of the filter of chunks that may repeat; when it fills up, more chunks take the way of those that do.
FILTER_BITS = 1 << 26

_GAP = np.zeros(256, bool)
_GAP[[0x20, 9, 10, 11, 12, 13]] = True
_random = np.random.default_rng(20240613)
_GEAR = _random.integers(0, 1 << 32, 256, dtype=np.uint32)
_CODES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_CODES[_GAP] = 0
#: The letter that stands for a byte in byte-level vocabularies: its own if it can be seen, else the next one from 256.
_seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_LETTERS = [chr(b) if b in _seen else chr(256 + sum(x not in _seen for x in range(b))) for b in range(256)]
_zip = pa.Codec("zstd", compression_level=1)


def ragged_index(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[i], ..., starts[i] + sizes[i] - 1 of every i, one after another."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the REACH bytes that end at each byte, by doubling the stretch it covers."""
    value, step = _GEAR[data], 1
    while step < REACH:
        longer = value.copy()
        longer[step:] += value[:-step] << np.uint32(step)
        value, step = longer, 2 * step
    return value


def cut_places(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sorted places inside the texts where a chunk ends and the next begins."""
    found = []
    for low in range(0, len(data), 1 << 20):
        first = max(0, low - REACH + 1)
        hits = np.flatnonzero(rolling(data[first : low + (1 << 20)])[low - first :] >> np.uint32(32 - CHANCE_BITS) == 0)
        found.append(hits + low + 1)
    at = np.concatenate(found) if found else np.zeros(0, np.int64)
    for _ in range(3):  # to the start of a character
        at = at + ((at < len(data)) & ((data[np.minimum(at, len(data) - 1)] & 0xC0) == 0x80) if len(data) else 0)
    at = np.unique(at)
    text = np.searchsorted(offsets, at, "right") - 1
    inside = (text + 1 < len(offsets)) & (at - offsets[text] >= max(LEAST, REACH))
    at, text = at[inside], text[inside]
    last = np.where(np.append(-1, text[:-1]) == text, np.append(0, at[:-1]), offsets[text]) if len(at) else at
    apart = at - last >= LEAST
    at, text = at[apart], text[apart]
    if not len(at):
        return at
    gaps = np.append(0, np.cumsum(word_gaps(data)))
    last = np.where(np.append(-1, text[:-1]) == text, np.append(0, at[:-1]), offsets[text])
    ends = np.append(text[1:], -1) != text
    enough = (gaps[at] - gaps[last] >= LEAST_GAPS) & (~ends | (gaps[offsets[text + 1]] - gaps[at] >= LEAST_GAPS))
    return at[enough]


def word_gaps(data: np.ndarray) -> np.ndarray:
    """Marks white space right before a word."""
    gap = _GAP[data]
    gap[:-1] &= ~gap[1:]
    gap[-1:] = False
    return gap


def _flat(lists: list[list[int]], kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in lists], np.int64)
    return np.fromiter((i for x in lists for i in x), kind, int(sizes.sum())), sizes


class Lists:
    """Lists of ids by number, one after another."""

    def __init__(self, kind: np.dtype):
        self.ids, self.sizes, self.starts = np.zeros(0, kind), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.append(self.starts, len(self.ids) + np.cumsum(sizes) - sizes)
        self.ids, self.sizes = np.append(self.ids, ids), np.append(self.sizes, sizes)

    def take(self, numbers: np.ndarray) -> np.ndarray:
        return self.ids[ragged_index(self.starts[numbers], self.sizes[numbers])]


def _pattern(vocabulary: dict):
    """The pattern of a vocabulary whose texts are normalised to NFC, single blanks and lower case, and split by a pattern; else None."""
    steps = [(n["type"], n.get("content")) for n in (vocabulary["normalizer"] or {}).get("normalizers", [])]
    parts = (vocabulary["pre_tokenizer"] or {}).get("pretokenizers", [])
    if steps != [("NFC", None), ("Replace", " "), ("Lowercase", None)] or [p["type"] for p in parts] != ["Split", "ByteLevel"]:
        return None
    split, level = parts
    if split["behavior"] != "Removed" or not split["invert"] or "Regex" not in split["pattern"] or level["add_prefix_space"] or level["use_regex"]:
        return None
    return regex.compile(f"{split['pattern']['Regex']}|\\n")


class Words:
    """The tokenizer, asked once for each distinct word.

    A word is what stands between white space, which the tokenizer must drop before it merges;
    the ids of a text are then those of its words.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as source:
            self.tokenizer = Tokenizer.from_str(source.read())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        specials = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or set(t.content) & set(" \t\n\v\f\r") for t in specials.values()):
            raise ValueError("a special token takes in white space")
        if self.encode_one("a b\tc\nd") != [i for x in "abcd" for i in self.encode_one(x)]:
            raise ValueError("white space does not part words in this vocabulary")
        top = max(self.tokenizer.get_vocab().values()) + 1
        pieces = [(self.tokenizer.id_to_token(i) or "").encode() + b" " for i in range(top)]
        self.kind = np.dtype("<u2" if top <= 1 << 16 else "<u4")
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.plain = self.tokenizer.decoder is None
        self.marks = [t.content.encode() for t in specials.values()]
        self.find = _pattern(json.loads(self.tokenizer.to_str()))
        self._forget()

    def _forget(self) -> None:
        #: Sorted hashes of words and their numbers, and the numbers of the pieces they consist of; a line end is a piece without ids.
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.pieces: dict[str, int] = {"\n": 0}
        self.of_words, self.of_pieces = Lists(self.kind), Lists(self.kind)
        self.of_pieces.add(np.zeros(0, self.kind), np.zeros(1, np.int64))

    def encode_one(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        """Remember the ids of new words, by ascending hash."""
        first, at = len(self.hashes), np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.numbers = np.insert(self.numbers, at, np.arange(first, first + len(words), dtype=np.int32))
        if self.find and not any(m in b" ".join(words) for m in self.marks):
            self.of_words.add(*self._split_ids(words))
        else:
            self.of_words.add(*_flat([e.ids for e in self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)], self.kind))

    def _split_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The vocabulary's steps one by one, so that each distinct piece is merged once; a normaliser does no more to ASCII than lower its case."""
        normal, merge = self.tokenizer.normalizer.normalize_str, self.tokenizer.model.tokenize
        texts = [w.decode().lower() if w.isascii() else normal(w.decode()) for w in words]
        pieces = self.find.findall("\n".join([*texts, ""]))
        new = list({*pieces} - self.pieces.keys())
        self.pieces.update(zip(new, range(len(self.pieces), len(self.pieces) + len(new))))
        letters = (p if p.isascii() and p.isalnum() else "".join(_LETTERS[b] for b in p.encode()) for p in new)
        self.of_pieces.add(*_flat([[t.id for t in merge(x)] for x in letters], self.kind))
        number = np.fromiter(map(self.pieces.__getitem__, pieces), np.int64, len(pieces))
        ends = number == 0
        return self.of_pieces.take(number), np.bincount(np.cumsum(ends) - ends, self.of_pieces.sizes[number], len(words)).astype(np.int64)

    def encode(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offset of each fragment's ids) of the byte ranges of ``data``, which may overlap."""
        out, counts, low, ends = [], [], 0, np.cumsum(sizes + 1)
        while low < len(starts):
            done = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, done + PIECE, "right")))
            ids, n = self._encode(data, starts[low:high], sizes[low:high])
            out.append(ids)
            counts.append(n)
            low = high
        empty = np.zeros(0, self.kind)
        return np.concatenate([empty, *out]), np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *counts]))])

    def _encode(self, data, starts, sizes):
        text = np.append(data, np.uint8(0x20))
        after = np.cumsum(sizes + 1)
        index = ragged_index(starts, sizes + 1)
        index[after - 1] = len(data)  # white space after every fragment
        text = text[index]
        inside = ~_GAP[text]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        at = np.flatnonzero(first)
        if not len(at):
            return np.zeros(0, self.kind), np.zeros(len(starts), np.int64)
        last = np.flatnonzero(inside[:-1] & ~inside[1:])
        length = last - at + 1
        place = np.arange(len(text)) - np.repeat(np.append(0, at), np.diff(np.concatenate([[0], at, [len(text)]])))
        place[~inside] = 0
        values = _CODES[text] * _powers_up_to(int(length.max()))[place]
        del index, inside, first, place
        hashes = mix(np.add.reduceat(values, at) + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        distinct, one, word = np.unique(hashes, return_index=True, return_inverse=True)
        new = np.flatnonzero(~np.isin(distinct, self.hashes, assume_unique=True))
        if len(new):
            if len(self.hashes) + len(new) > REMEMBERED:
                self._forget()
                new = np.arange(len(distinct))
            raw = text.tobytes()
            self._learn(distinct[new], [raw[at[one[i]] : at[one[i]] + length[one[i]]] for i in new.tolist()])
        number = self.numbers[np.searchsorted(self.hashes, distinct)][word]
        of = np.searchsorted(after, at, "right")
        return self.of_words.take(number), np.bincount(of, self.of_words.sizes[number], len(starts)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> str:
        if not self.plain:
            return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)
        if not len(ids):
            return ""
        return self.bytes[ragged_index(self.starts[ids], self.sizes[ids])][:-1].tobytes().decode()


@lru_cache(2)
def load_words(path: str) -> Words:
    return Words(path)


def settle(data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray, words) -> tuple[np.ndarray, list]:
    """(cuts that stay, (ids of the window up to the cut, from the cut, across it) of each).

    Windows grow until the ids of the guards agree; a cut whose windows cannot grow goes.
    """
    gaps = np.flatnonzero(word_gaps(data))
    done: dict[int, tuple] = {}
    todo, reach = cuts, 1
    while len(todo):
        bounds = np.union1d(offsets, cuts)
        place = np.searchsorted(bounds, todo)
        before, after = bounds[place - 1], bounds[place + 1]
        k = np.searchsorted(gaps, todo)
        ok = (k - reach - 1 >= 0) & (k + reach < len(gaps))
        ok[ok] &= (gaps[k[ok] - reach - 1] >= before[ok]) & (gaps[k[ok] + reach] < after[ok])
        cuts = np.setdiff1d(cuts, todo[~ok])  # the chunks beside it become one
        todo, k = todo[ok], k[ok]
        if not len(todo):
            break
        low, inner = gaps[k - reach - 1], gaps[k - reach]
        high, outer = gaps[k + reach - 1], gaps[k + reach]
        starts = np.concatenate([low, todo, low, low, high])
        ends = np.concatenate([todo, outer, outer, inner, outer])
        ids, at = words.encode(data, starts, ends - starts)
        n = len(todo)
        part = lambda kind, i: ids[at[kind * n + i] : at[kind * n + i + 1]]
        left = []
        for i in range(n):
            whole, one, two = part(2, i), part(3, i), part(4, i)
            if len(whole) >= len(one) + len(two) and np.array_equal(whole[: len(one)], one) and np.array_equal(whole[len(whole) - len(two) :], two):
                done[int(todo[i])] = (part(0, i), part(1, i), whole)
            else:
                left.append(todo[i])
        todo, reach = np.array(left, np.int64), 2 * reach
    return cuts, [done[int(c)] for c in cuts]


def chunk_keys(data: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    raw = data.tobytes()
    return [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def encode_texts(data: np.ndarray, offsets: np.ndarray, words, given: dict[bytes, np.ndarray]) -> list[np.ndarray]:
    """The ids of each text: its chunks' ids, from ``given`` or encoded here, joined by those of the windows at the cuts.

    Where a chunk's ids do not agree with a window's, the cut goes, and the chunks beside it are encoded as one.
    """
    cuts, joins = settle(data, offsets, cut_places(data, offsets), words)
    while True:
        bounds = np.union1d(offsets, cuts)
        keys = chunk_keys(data, bounds) if given else [b""] * (len(bounds) - 1)
        own = np.array([k for k, key in enumerate(keys) if key not in given], np.int64)
        ids, at = words.encode(data, bounds[own], bounds[own + 1] - bounds[own])
        chunks = [given.get(key) for key in keys]
        for k, low, high in zip(own.tolist(), at[:-1].tolist(), at[1:].tolist()):
            chunks[k] = ids[low:high]
        none = ids[:0]
        join, wrong = dict(zip(cuts.tolist(), joins)), set()
        ends = bounds.tolist()
        edges = [(join[low][1] if low in join else none, join[high][0] if high in join else none) for low, high in zip(ends, ends[1:])]
        for k, (head, tail) in enumerate(edges):
            if not np.array_equal(chunks[k][: len(head)], head):
                wrong.add(ends[k])
            if not np.array_equal(chunks[k][len(chunks[k]) - len(tail) :], tail):
                wrong.add(ends[k + 1])
        if not wrong:
            break
        stay = [i for i, c in enumerate(cuts.tolist()) if c not in wrong]
        cuts, joins = cuts[stay], [joins[i] for i in stay]
    out = []
    for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        parts = [none]
        for k in range(int(np.searchsorted(bounds, low)), int(np.searchsorted(bounds, high))):
            head, tail = edges[k]
            parts.append(chunks[k][len(head) : len(chunks[k]) - len(tail)])
            if ends[k + 1] in join:
                parts.append(join[ends[k + 1]][2])
        out.append(np.concatenate(parts))
    return out


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    _, offsets = buffers(batch.column(batch.num_columns - 1))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + PIECE, "right")) - 1)
        yield batch.slice(low, high - low)
        low = high


def _packed(x: bytes) -> bytes:
    return len(x).to_bytes(8, "little") + _zip.compress(x, asbytes=True)


def _unpacked(x: bytes) -> bytes:
    return _zip.decompress(x[8:], int.from_bytes(x[:8], "little"), asbytes=True)


def _repeating(source: DataFrame) -> np.ndarray:
    """The filter: a bit for every chunk found twice or more, and some for others."""

    def count(batches):
        for batch in batches:
            for piece in _pieces(batch):
                data, offsets = buffers(piece.column(0))
                keys = chunk_keys(data, np.union1d(offsets, cut_places(data, offsets)))
                first = np.frombuffer(b"".join(keys), "<u8")[::2]
                found, n = np.unique(first, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n, pa.int64())], names=["key", "n"])

    counted = source.mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    code = F.pmod(F.col("key"), F.lit(FILTER_BITS))  # a power of two: the same for signed and unsigned
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (code % 64).cast("int"))
    cells = counted.where("n > 1").groupBy(F.shiftright(code, 6).alias("cell")).agg(F.bit_or(bit).alias("bits"))
    rows = cells.toArrow()  # at most FILTER_BITS / 64 of them
    filled = np.zeros(FILTER_BITS // 64, np.int64)
    filled[rows["cell"].to_numpy()] = rows["bits"].to_numpy()
    return filled.view(np.uint8)


def _maybe_repeated(keys: list[bytes], bits: np.ndarray) -> np.ndarray:
    place = (np.frombuffer(b"".join(keys), "<u8")[::2] % np.uint64(FILTER_BITS)).astype(np.int64)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def _asked(piece: pa.RecordBatch, bits: np.ndarray) -> list[list[tuple[bytes, int, int]]]:
    """(key, start, end) of the chunks of each text that may be repeated."""
    data, offsets = buffers(piece.column(piece.num_columns - 1))
    bounds = np.union1d(offsets, cut_places(data, offsets))
    keys = chunk_keys(data, bounds)
    found = np.flatnonzero(_maybe_repeated(keys, bits)).tolist() if keys else []
    out: list[list] = [[] for _ in range(piece.num_rows)]
    text = np.searchsorted(offsets, bounds[:-1], "right") - 1
    for k in found:
        out[text[k]].append((keys[k], int(bounds[k]), int(bounds[k + 1])))
    return out


def _over(docs: DataFrame, text_col: str, path: str, fields: list[StructField], make) -> DataFrame:
    """``make`` gets the ids of each row and the words, and returns the values of ``fields``."""
    spark, names = docs.sparkSession, [f.name for f in fields]
    kept = [c for c in docs.columns if c not in names]
    text, code, key, fetched = (fresh(x, kept) for x in ("_text", "_code", "_key", "_fetched"))
    source = docs.select(*kept, F.col(text_col).cast("binary").alias(text))
    kept_fields = docs.select(*kept).schema.fields
    out = StructType([*kept_fields, *fields])
    sent = spark.sparkContext.broadcast(_repeating(source.select(text)))

    def ask(batches):
        """Of each distinct text the chunks that may be repeated, and each such chunk's text once."""
        for batch in batches:
            seen, codes, rows = set(), set(), []
            for piece in _pieces(batch):
                data, offsets = buffers(piece.column(0))
                for i, found in enumerate(_asked(piece, sent.value)):
                    own = data[offsets[i] : offsets[i + 1]].tobytes() if found else b""
                    at = xxhash.xxh3_128_digest(own)
                    if found and at not in codes:
                        codes.add(at)
                        new = {k: (a, b) for k, a, b in found if k not in seen}
                        seen.update(new)
                        rows.append((at, list({k for k, _, _ in found}), [{"key": k, "text": _packed(data[a:b].tobytes())} for k, (a, b) in new.items()]))
            kinds = pa.binary(), pa.list_(pa.binary()), pa.list_(pa.struct({"key": pa.binary(), "text": pa.binary()}))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["code", "keys", "texts"])

    asked = materialize(source.select(text).mapInArrow(ask, "code binary, keys array<binary>, texts array<struct<key: binary, text: binary>>"), "asked")

    def once(batches):
        """Encodes a key's first row; equal keys stand together."""
        words, last = load_words(path), None
        for batch in batches:
            keys, rows = batch.column(0).to_pylist(), []
            for i, k in enumerate(keys):
                if k != last:
                    rows.append(i)
                    last = k
            data, offsets = buffers(pa.array([_unpacked(batch.column(1)[i].as_py()) for i in rows], pa.binary()))
            ids, at = words.encode(data, offsets[:-1], np.diff(offsets))
            yield pa.RecordBatch.from_arrays([
                pa.array([keys[i] for i in rows], pa.binary()), pa.array([_packed(ids[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])], pa.binary())], names=["key", "ids"])

    texts = asked.select(F.explode("texts").alias("x")).select("x.key", "x.text")
    encoded = materialize(texts.repartition("key").sortWithinPartitions("key").mapInArrow(once, "key binary, ids binary"), "chunks")
    wanted = asked.select("code", "keys").dropDuplicates(["code"]).select("code", F.explode("keys").alias("key"))
    chunks = wanted.join(encoded, "key").groupBy(F.col("code").alias(key)).agg(F.collect_list(F.struct("key", "ids")).alias(fetched))

    def alone(batches):
        """Texts without a chunk that may be repeated are encoded where they are."""
        words = load_words(path)
        for batch in batches:
            for piece in _pieces(batch):
                own = pa.array([not x for x in _asked(piece, sent.value)], pa.bool_())
                piece = piece.filter(own)
                data, offsets = buffers(piece.column(len(kept)))
                if piece.num_rows:
                    yield pa.RecordBatch.from_arrays([*piece.columns[:-1], *make(encode_texts(data, offsets, words, {}), words)], names=out.names)

    def others(batches):
        for batch in batches:
            for piece in _pieces(batch):
                piece = piece.filter(pa.array([bool(x) for x in _asked(piece, sent.value)], pa.bool_()))
                own = piece.column(len(kept)).to_pylist()
                yield pa.RecordBatch.from_arrays([
                    *piece.columns[:-1], pa.array([xxhash.xxh3_128_digest(x) for x in own], pa.binary()), pa.array([_packed(x) for x in own], pa.binary())], names=[*kept, code, text])

    def finish(batches):
        words = load_words(path)
        for batch in batches:
            low = 0
            sizes = np.cumsum([int.from_bytes(x.as_py()[:8], "little") for x in batch.column(len(kept))])
            while low < batch.num_rows:
                high = max(low + 1, int(np.searchsorted(sizes, (sizes[low - 1] if low else 0) + PIECE, "right")))
                piece = batch.slice(low, high - low)
                low = high
                data, offsets = buffers(pa.array([_unpacked(x.as_py()) for x in piece.column(len(kept))], pa.binary()))
                given = {x["key"].as_py(): np.frombuffer(_unpacked(x["ids"].as_py()), words.kind) for row in piece.column(len(kept) + 1) if row.is_valid for x in row}
                yield pa.RecordBatch.from_arrays([*piece.columns[: len(kept)], *make(encode_texts(data, offsets, words, given), words)], names=out.names)

    split = StructType([*kept_fields, StructField(code, BinaryType()), StructField(text, BinaryType())])
    met = source.mapInArrow(others, split).join(chunks, F.col(code) == F.col(key), "left").select(*kept, text, fetched)
    return source.mapInArrow(alone, out).unionAll(met.mapInArrow(finish, out))


def encode_documents(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Add ``ids`` (array of int) and ``decoded`` (string), as the tokenizers library encodes and decodes with the
    file at ``path``, which every worker reads: no special tokens added, none skipped, no truncation or padding.

    Columns of those names are replaced. Null and empty texts have no ids and decode to nothing. Rows that
    repeat stay, their chunks are encoded once; a text of any length is one row, cut into chunks; one without
    white space is a single chunk. An empty table gives no rows. Special tokens' strings count as those tokens.
    The vocabulary must part words at white space and drop it; other ones are refused.
    """

    def make(rows, words):
        at = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
        return [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(rows).astype(np.int32), pa.int32())),
                pa.array([words.decode(x) for x in rows], pa.string())]

    return _over(docs, text_col, path, [StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())], make)


def encode_digests(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """As ``encode_documents``, with the ids' number and SHA-256 digests instead: ``n_tokens``, ``ids_sha256``
    (of the decimal ids joined by blanks), ``decoded_sha256`` (of the decoded text in UTF-8)."""

    def make(rows, words):
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        return [pa.array([len(x) for x in rows], pa.int64()), pa.array([sha(" ".join(map(str, x.tolist()))) for x in rows]),
                pa.array([sha(words.decode(x)) for x in rows])]

    fields = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    return _over(docs, text_col, path, fields, make)
