"""Language-model scores from a log-frequency Bloom filter of pair counts and exact word counts.

Documents are read once, into pieces: the distinct words of a piece, and each token's place among
them. Distinct words and pairs of a piece go, with their counts in training texts, to hash
segments, whose number grows with the corpus. A segment adds up the words exactly. Of its
pairs it fills a Bloom filter with quantised counts: a pair of level q enters as (pair, 1), ...,
(pair, q), and is read by probing for (pair, 1), (pair, 2), ... until one is missing. A filter of
all pairs has no bound on its size, so it is not broadcast: the probes come to its segments,
each distinct pair of a piece once, and go back to the piece as a byte each. Every training word
and every training pair counts, at any size of the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from newslens.llm.text import buffers, mix, word_hashes
from newslens.session import materialize

#: Training tokens to a segment, and the fewest segments.
SEGMENT, FEWEST = 1 << 21, 16
#: Bits of the filter for an entry, and probes of an entry: about one in 300 absent entries is found.
ENTRY_BITS, PROBES = 12, 6
#: Counts up to EXACT are levels of their own; above, a level is STEP times the one before.
EXACT, STEP = 4, 1.25
LAMBDA = 0.5
END = np.uint64(0xE4D0F7E4D0F7E4D1)
#: Bytes of text to a piece at most (one document at least).
PIECE = 1 << 24
WORDS, PAIRS = 0, 1
_zip = pa.Codec("zstd", compression_level=1)


def held_out(id_col: Column) -> Column:
    """One document in five, by the CRC-32 of its id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def level(counts: np.ndarray) -> np.ndarray:
    """The level of a count; none is 0."""
    counts = np.asarray(counts)
    above = EXACT + np.ceil(np.log(np.maximum(counts, EXACT) / EXACT) / math.log(STEP) - 1e-9)
    return np.where(counts <= EXACT, counts, above).astype(np.int64)


def value(levels: np.ndarray) -> np.ndarray:
    """The count that a level stands for, within the root of STEP."""
    levels = np.asarray(levels)
    return np.where(levels <= EXACT, levels, EXACT * STEP ** (levels - EXACT - 0.5))


def _places(keys: np.ndarray, at: int, size: int) -> np.ndarray:
    """Bit numbers (keys x PROBES) of the entries (key, level ``at``)."""
    seed = mix(keys + np.uint64(at * 0x9E3779B97F4A7C15 % 2**64))
    step = mix(seed) | np.uint64(1)
    return ((seed[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)) >> np.uint64(8)) % np.uint64(size)


def fill(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The filter that holds the quantised counts of the keys, as packed bits."""
    levels = level(counts)
    bits = np.zeros(max(64, ENTRY_BITS * int(levels.sum()) + 7 & ~7), bool)
    at = 1
    while len(keys):
        for low in range(0, len(keys), 1 << 18):
            bits[_places(keys[low : low + (1 << 18)], at, len(bits))] = True
        at += 1
        more = levels >= at
        keys, levels = keys[more], levels[more]
    return np.packbits(bits)


def probe(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The level found of each key, never below the one it entered with."""
    found, size = np.zeros(len(keys), np.uint8), 8 * len(bits)
    for low in range(0, len(keys), 1 << 18):
        open_, at = np.arange(low, min(low + (1 << 18), len(keys))), 1
        while len(open_):
            places = _places(keys[open_], at, size)
            open_ = open_[((bits[places >> np.uint64(3)] >> (7 - (places & np.uint64(7))).astype(np.uint8)) & 1).all(axis=1)]
            found[open_] = at
            at += 1
    return found


def _packed(x: np.ndarray) -> bytes:
    """Byte planes, which compress better than numbers."""
    raw = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.dtype.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + _zip.compress(raw, asbytes=True)


def _unpacked(x: bytes, kind) -> np.ndarray:
    raw = _zip.decompress(x[8:], int.from_bytes(x[:8], "little"), asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    _, offsets = buffers(batch.column(2))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + PIECE, "right")) - 1)
        yield batch.slice(low, high - low)
        low = high


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces: documents, the offsets of their tokens, the distinct words, each token's place among them."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for piece in _pieces(batch):
            words, at = word_hashes(piece.column(2))
            tokens, at = np.insert(words, at[1:], END), at + np.arange(len(at))
            distinct, place = np.unique(tokens, return_inverse=True)
            ids, held = (pa.ListArray.from_arrays(pa.array([0, piece.num_rows], pa.int32()), piece.column(i)) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([
                pa.array([number]), ids, held, pa.array([len(tokens)]), *(pa.array([_packed(x)], pa.binary()) for x in (at, distinct, place.astype("<u4")))],
                names=["piece", "ids", "held", "size", "at", "words", "tokens"])
            number += 1


class Piece:
    """A piece's tokens, distinct words and distinct pairs, and which segments they belong to."""

    def __init__(self, row: dict, segments: int):
        self.at, self.words = _unpacked(row["at"], "<i8"), _unpacked(row["words"], "<u8")
        self.tokens = _unpacked(row["tokens"], "<u4").astype(np.int64)
        end = int(np.searchsorted(self.words, END))
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.at[:-1]] = end
        self.train = np.repeat(~np.array(row["held"], bool), np.diff(self.at))
        self.pairs, self.pair = np.unique(before * len(self.words) + self.tokens, return_inverse=True)
        self.first, self.second = np.divmod(self.pairs, len(self.words))
        self.keys = mix(mix(self.words[self.first]) * np.uint64(0x9FB21C651E98DF25) + self.words[self.second])
        self.dealt = [self._deal(self.words, segments), self._deal(self.keys, segments)]

    @staticmethod
    def _deal(keys: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order by segment, segments found, bounds of each in that order)."""
        segment = (mix(keys ^ np.uint64(0xA24BAED4963EE407)) % np.uint64(segments)).astype(np.int32)
        order = np.argsort(segment, kind="stable")
        found, start = np.unique(segment[order], return_index=True)
        return order, found, np.append(start, len(order))

    def asks(self, number: int) -> Iterator[pa.RecordBatch]:
        for kind, keys, place in ((WORDS, self.words, self.tokens), (PAIRS, self.keys, self.pair)):
            counts = np.bincount(place, self.train, len(keys)).astype("<u4")
            order, found, bounds = self.dealt[kind]
            # 40 bits tell the pairs of a segment apart; words keep all 64
            key = keys[order].view(np.uint8).reshape(-1, 8)[:, 3 if kind == PAIRS else 0 :]
            parts = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
            yield pa.RecordBatch.from_arrays([
                pa.array(found), pa.array(np.full(len(found), kind, np.int32)), pa.array(np.full(len(found), number)),
                pa.array([key[a:b].tobytes() for a, b in parts], pa.binary()), pa.array([_packed(counts[order[a:b]]) for a, b in parts], pa.binary())], names=_ASK_NAMES)

    def gathered(self, kind: int, answers: dict, number) -> np.ndarray:
        order, found, _ = self.dealt[kind]
        out = np.empty(len(order), number)
        if len(order):
            out[order] = np.concatenate([_unpacked(answers[kind, s], number) for s in found.tolist()])
        return out


_ASK = "segment int, kind int, piece bigint, keys binary, n binary"
_ASK_NAMES = [c.split()[0] for c in _ASK.split(", ")]


def _wide(keys: bytes, kind: int) -> np.ndarray:
    if kind == WORDS:
        return np.frombuffer(keys, "<u8")
    wide = np.zeros((len(keys) // 5, 8), np.uint8)
    wide[:, 3:] = np.frombuffer(keys, np.uint8).reshape(-1, 5)
    return wide.view("<u8").reshape(-1)


def _answer(table: pa.Table) -> pa.Table:
    """What a segment knows of the words and pairs of each piece, and its share of tokens and distinct words."""
    rows, total, types = table.to_pylist(), 0, 0
    segment, out = rows[0]["segment"], []
    for kind in (WORDS, PAIRS):
        own = [r for r in rows if r["kind"] == kind]
        if not own:
            continue
        keys = [_wide(r["keys"], kind) for r in own]
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.bincount(place, np.concatenate([_unpacked(r["n"], "<u4") for r in own]), len(distinct)).astype(np.int64)
        if kind == WORDS:
            total, types = int(counts.sum()), int((counts > 0).sum())
            answers = counts
        else:
            learned = counts > 0
            answers = probe(fill(distinct[learned], counts[learned]), distinct)
        ends = np.cumsum([len(k) for k in keys])
        for r, low, high in zip(own, ends - [len(k) for k in keys], ends):
            out.append((r["piece"], segment, kind, _packed(answers[place[low:high]]), 0, 0))
    out.append((None, segment, WORDS, None, total, types))
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
    return pa.table([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=["piece", "segment", "kind", "found", "tokens", "types"])


def _score(piece: pa.Table, answers: pa.Table, segments: int, floor: float) -> pa.Table:
    row = piece.to_pylist()[0]
    own = Piece(row, segments)
    found = {(k, s): x for k, s, x in zip(*(answers[c].to_pylist() for c in ("kind", "segment", "found")))}
    counts, levels = own.gathered(WORDS, found, "<i8"), own.gathered(PAIRS, found, "u1")
    alone = (counts + 0.5) / floor
    before = counts[own.first]
    share = np.where(before > 0, value(levels) / np.maximum(before, 1), 0)
    gains = np.log10(1 + LAMBDA / (1 - LAMBDA) * np.minimum(share, 1) / alone[own.second])
    sums = lambda x: np.add.reduceat(x, own.at[:-1])
    sizes, base = np.diff(own.at), sums(np.log10(alone)[own.tokens])
    return pa.table([
        piece["ids"].combine_chunks().flatten(), piece["held"].combine_chunks().flatten(), pa.array(sizes), pa.array(sums((counts > 0).astype(np.int64)[own.tokens])),
        pa.array(base), pa.array(base + sizes * math.log10(1 - LAMBDA) + sums(gains[own.pair]))], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_tokens: int = SEGMENT) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the documents that are not ``held_out``. ``base_score`` is the exact smoothed
    unigram log10 probability, ``score`` the log10 probability of the text by pairs: half the
    pair's relative frequency after the word before, plus half the smoothed unigram. The pair's
    count is the one its level stands for: exact up to 4, above within a factor of 1.12; an unseen
    pair is taken for one seen once in about 300 cases. A null text is empty: it has one token, its
    end. Repeated rows are scored, and learnt from, each; other columns are left out; an empty
    table gives no rows. Words are known by 64-bit hashes, pairs by 40 bits beside their segment.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("binary").alias("_text"))
    kind = dict(source.dtypes)["doc_id"]
    pieces = materialize(source.mapInArrow(_read, f"piece bigint, ids array<{kind}>, held array<boolean>, size bigint, at binary, words binary, tokens binary"), "pieces")
    segments = max(FEWEST, -(-(pieces.agg(F.sum("size")).first()[0] or 0) // segment_tokens))

    def ask(batches):
        for batch in batches:
            for row in batch.select(["piece", "held", "at", "words", "tokens"]).to_pylist():
                yield from Piece(row, segments).asks(row["piece"])

    asked = pieces.select("piece", "held", "at", "words", "tokens").mapInArrow(ask, _ASK)
    answers = materialize(asked.groupBy("segment").applyInArrow(_answer, "piece bigint, segment int, kind int, found binary, tokens bigint, types bigint"), "answers")
    total, types = answers.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    floor = float(total + 0.5 * (types + 1))
    met = pieces.groupBy("piece").cogroup(answers.where("piece is not null").groupBy("piece"))
    scored = met.applyInArrow(lambda a, b: _score(a, b, segments, floor), f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(total)).cast("bigint").alias("train_tokens"), "base_score", "score")
