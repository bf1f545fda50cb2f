"""N-grams of texts or token lists, counted in Arrow batches.

Each distinct word of a stretch of documents gets a number; n-grams are then numbers too, so repeats are found by
sorting integers, and texts are only formed for what leaves the task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Tokens of the documents that a worker counts together, or those of one document.
TOKENS = 1 << 19
#: Slots of the word mask that leaves out rare n-grams.
MASK_BITS = 1 << 20
#: Bytes of the texts that a worker cuts and counts together, or those of one text.
TEXT_BYTES = 1 << 23
#: The same where no sums over the texts leave the worker.
COUNTED_BYTES = 1 << 21
#: Characters that a word has at least.
LEAST = 2
#: Slots in which n-grams are counted before their texts are formed, as a power of two, and how many travel as one row.
SLOT_BITS = 22
SLOT_BLOCK = 1 << 14
_MIX = np.uint64(0x9E3779B97F4A7C15)


def list_stretches(lists: pa.ListArray, most: int = TOKENS) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(items, items of each row) of stretches of rows with at most ``most`` items, or one row."""
    sizes = lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    flat, ends, low = lists.flatten(), np.cumsum(sizes), 0
    while low < len(sizes):
        done = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + most, "right")))
        yield flat[done:int(ends[high - 1])], sizes[low:high]
        low = high


def row_stretches(texts: pa.StringArray, most: int = TEXT_BYTES) -> Iterator[tuple[int, int]]:
    """(first row, end) of stretches of texts with at most ``most`` bytes, or one text."""
    ends, low = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy().astype(np.int64)), 0
    while low < len(ends):
        done = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + most, "right")))
        yield low, high
        low = high


def text_stretches(texts: pa.StringArray, most: int = TEXT_BYTES) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(words, words of each text) of the ``row_stretches``; blanks part the words."""
    for low, high in row_stretches(texts, most):
        lists = pc.split_pattern(texts[low:high], " ")
        yield lists.flatten(), lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)


def _stretches(column: pa.Array, *most: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    return list_stretches(column) if pa.types.is_nested(column.type) else text_stretches(column, *most)


def _numbered(flat: pa.Array, sizes: np.ndarray, stops: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, the number of each token's word, its document) without the stop words and shorter ones than LEAST."""
    coded = flat.dictionary_encode()
    ids = coded.indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    out = pc.less(pc.utf8_length(coded.dictionary), LEAST).to_numpy(zero_copy_only=False)
    if len(stops):
        out = out | pc.is_in(coded.dictionary, value_set=stops).to_numpy(zero_copy_only=False)
    if out.any():
        kept = ~out[ids]
        ids, doc = ids[kept], doc[kept]
    return coded.dictionary, ids, doc


def _places(ids: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Where the n-grams begin that lie in one document and whose words all have a number; others have -1."""
    count = max(len(ids) - n + 1, 0)
    whole = doc[:count] == doc[n - 1:]
    for i in range(n):
        whole &= ids[i:i + count] >= 0
    return np.flatnonzero(whole)


def _keys(ids: np.ndarray, places: np.ndarray, n: int, base: int) -> np.ndarray:
    """The numbers of the n-grams that begin at the places."""
    key = np.zeros(len(places), np.int64)
    for i in range(n):
        key = key * base + ids[places + i]
    return key


def distinct(numbers: np.ndarray) -> np.ndarray:
    """The distinct numbers, ascending; sorting millions is many times faster than the hash table of ``np.unique``."""
    ordered = np.sort(numbers)
    return ordered[np.flatnonzero(np.concatenate([np.ones(min(len(ordered), 1), bool), ordered[1:] != ordered[:-1]]))]


def _word_codes(words: pa.Array) -> np.ndarray:
    """The crc32 of each word, read from the words' buffer in place of objects made of each."""
    plain = words.cast(pa.large_binary())
    _, ends, data = plain.buffers()
    at = np.frombuffer(ends, np.int64, len(plain) + 1, 8 * plain.offset).tolist() if len(plain) else []
    data = memoryview(data or b"")
    return np.array([zlib.crc32(data[a:b]) for a, b in zip(at, at[1:])], np.int64)


def _known(codes: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Which words have their slot's bit set in a mask of MASK_BITS bits, 64 to a cell."""
    slots = codes % MASK_BITS
    return (mask[slots // 64] >> (slots % 64)) & 1 == 1


def known_words(words: pa.Array, mask: np.ndarray) -> np.ndarray:
    return _known(_word_codes(words), mask)


def _masked(column: pa.Array, stops: pa.Array, mask: np.ndarray | None) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray | None]]:
    """(distinct words, word numbers, documents, codes of the words) of stretches; words the mask does not know have -1."""
    for flat, sizes in _stretches(column):
        words, ids, doc = _numbered(flat, sizes, stops)
        codes = None
        if mask is not None and len(words):
            codes = _word_codes(words)
            ids = np.where(_known(codes, mask)[ids], ids, -1)
        yield words, ids, doc, codes
        pa.default_memory_pool().release_unused()  # a worker waits for later tasks with what its pool holds


def _slots(codes: np.ndarray, ids: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """The slots of the n-grams that begin at the places; the same n-gram has the same slot in every task."""
    mixed = np.zeros(len(places), np.uint64)
    for i in range(n):
        mixed = (mixed + codes[ids[places + i]].astype(np.uint64)) * _MIX  # wraps
    return (mixed >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def slot_counts(columns: Iterable[pa.Array], stops: Sequence[str], lo: int, hi: int, mask: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(block, counts): how many n-grams of known words fall into each slot, by blocks of slots."""
    left_out, total = pa.array(stops, pa.string()), np.zeros(1 << SLOT_BITS, np.int64)
    for column in columns:
        for words, ids, doc, codes in _masked(column, left_out, mask):
            for n in range(lo, hi + 1) if len(words) else ():
                np.add(total, np.bincount(_slots(codes, ids, _places(ids, doc, n), n), minlength=len(total)), out=total)
    for block, counts in enumerate(total.reshape(-1, SLOT_BLOCK)):
        if counts.any():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([counts.tobytes()], pa.binary())], names=["block", "counts"])


def statistics(
    column: pa.Array, stops: Sequence[str], lo: int, hi: int, mask: np.ndarray | None = None, filled: np.ndarray | None = None,
) -> Iterator[pa.RecordBatch]:
    """(term, tf, df) of the n-grams of stretches of documents, lo <= n <= hi, whose words the mask knows.

    With ``filled``, which tells of each slot whether it counts, only of those in such slots.
    """
    for found, _ in keyed_statistics(column, stops, lo, hi, mask, filled):
        yield found


def keyed_statistics(
    column: pa.Array, stops: Sequence[str], lo: int, hi: int, mask: np.ndarray | None = None, filled: np.ndarray | None = None,
) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """``statistics``, and a 64-bit key of each term, made of its words' crc32: a code a word in place of one a term."""
    for words, ids, doc, codes in _masked(column, pa.array(stops, pa.string()), mask):
        base = max(len(words), 1)
        if codes is None:
            codes = _word_codes(words)
        mixing = codes.astype(np.uint64)
        for n in range(lo, hi + 1):
            places = _places(ids, doc, n)
            if filled is not None and len(places):
                places = places[filled[_slots(codes, ids, places, n)]]
            key, of = _keys(ids, places, n, base), doc[places]
            if n == 1:  # numbers of words are dense already
                found = np.flatnonzero(np.bincount(key, minlength=base))
                at = np.searchsorted(found, np.arange(base))[key]
            else:
                found, at = np.unique(key, return_inverse=True)
            if not len(found):
                continue
            once = distinct(of * len(found) + at)
            parts, rest, mixed = [], found, np.full(len(found), n, np.uint64)
            for _ in range(n):
                rest, part = np.divmod(rest, base)
                parts.insert(0, words.take(pa.array(part)))
                mixed = (mixed + mixing[part]) * _MIX  # wraps
                mixed ^= mixed >> np.uint64(29)
            yield pa.RecordBatch.from_arrays([
                pc.binary_join_element_wise(*parts, " ").cast(pa.string()), pa.array(np.bincount(at)),
                pa.array(np.bincount(once % len(found), minlength=len(found)))], names=["term", "tf", "df"]), mixed * _MIX


def _long_codes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.frombuffer(b"".join([blake2b(w, digest_size=8).digest() for w in words.cast(pa.binary()).to_pylist()]), np.uint64)


def _long_keys(codes: np.ndarray, ids: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the n-grams that begin at the places, the same in every task."""
    key = np.full(len(places), n, np.uint64)
    for i in range(n):
        key = (key + codes[ids[places + i]]) * _MIX  # wraps
        key ^= key >> np.uint64(29)
    return key


def keyed_grams(
    texts: pa.Array, stops: Sequence[str], lo: int, hi: int,
) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, int, np.ndarray, np.ndarray]]:
    """(distinct words, word numbers, first places, n, keys, texts) of the n-grams of each stretch, lo <= n <= hi."""
    left_out, first = pa.array(stops, pa.string()), 0
    for flat, sizes in _stretches(texts):
        words, ids, doc = _numbered(flat, sizes, left_out)
        codes = _long_codes(words)
        for n in range(lo, hi + 1):
            places = _places(ids, doc, n)
            yield words, ids, places, n, _long_keys(codes, ids, places, n), first + doc[places]
        first += len(sizes)


def distinct_keys(texts: pa.Array, stops: Sequence[str], lo: int, hi: int) -> np.ndarray:
    """The keys of the texts' n-grams, ascending."""
    return keys_of(keyed_grams(texts, stops, lo, hi))


def keys_of(grams: Iterable[tuple]) -> np.ndarray:
    """The distinct keys of ``keyed_grams``, ascending."""
    return distinct(np.concatenate([np.zeros(0, np.uint64), *(distinct(key) for *_, key, _ in grams)]))


def term_keys(terms: pa.Array, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(key of each term, which terms have at most ``longest`` words); blanks part the words."""
    lists = pc.split_pattern(terms, " ")
    coded, sizes = lists.flatten().dictionary_encode(), lists.value_lengths().to_numpy()
    ids, starts = coded.indices.to_numpy().astype(np.int64), np.cumsum(sizes) - sizes
    codes, keys = _long_codes(coded.dictionary), np.zeros(len(terms), np.uint64)
    for n in range(1, longest + 1):
        own = np.flatnonzero(sizes == n)
        keys[own] = _long_keys(codes, ids, starts[own], n)
    return keys, sizes <= longest


def segments(keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(segment, first, end) of the runs of ascending keys that share their leading bits."""
    own = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    starts = np.flatnonzero(np.diff(own, prepend=-1))
    return list(zip(own[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(keys)]))


def packed(keys: np.ndarray) -> bytes:
    """Ascending keys as steps, byte by byte, so that the zeros of leading bytes stand together."""
    return np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view("<u8").ravel(), dtype=np.uint64)


def _planes(numbers: np.ndarray) -> bytes:
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def packed_terms(found: pa.RecordBatch, bits: int, keys: np.ndarray | None = None) -> pa.RecordBatch:
    """(segment, terms, bytes, packed): the terms of a stretch with tf and df, compressed by segments of their keys, or of the terms' crc32."""
    if keys is None:
        keys = _word_codes(found.column("term")).astype(np.uint64) << np.uint64(32)
    # terms of a segment stay in the order of the stretch, where neighbours share words
    order = np.argsort((keys >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint64) if bits else np.zeros(len(keys), np.uint16), kind="stable")
    rows = segments(keys[order], bits)
    terms, tf, df = found.column("term").take(pa.array(order)), *(found.column(c).to_numpy()[order] for c in ("tf", "df"))
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, *(b for _, _, b in rows)], pa.int32()), terms), "\n").cast(pa.binary()).to_pylist()
    plain = [_planes(tf[a:b]) + _planes(df[a:b]) + text for (_, a, b), text in zip(rows, whole)]
    return pa.RecordBatch.from_arrays([
        pa.array([s for s, _, _ in rows], pa.int32()), pa.array([b - a for _, a, b in rows], pa.int32()), pa.array([len(x) for x in plain], pa.int32()),
        pa.array([pa.compress(x, "zstd", asbytes=True) for x in plain], pa.binary())], names=["segment", "terms", "bytes", "packed"])


def summed_terms(table: pa.Table) -> pa.Table:
    """(term, tf, df) over the packed terms of a segment."""
    parts = []
    for n, size, data in zip(*(table[c].to_pylist() for c in ("terms", "bytes", "packed"))):
        plain = pa.decompress(data, size, "zstd", asbytes=True)
        terms = pc.split_pattern(pa.array([plain[8 * n:]], pa.binary()).cast(pa.string()), "\n").flatten()
        parts.append(pa.table({"term": terms, "tf": pa.array(_from_planes(plain[:4 * n]), pa.int64()), "df": pa.array(_from_planes(plain[4 * n:8 * n]), pa.int64())}))
    summed = pa.concat_tables(parts).group_by("term").aggregate([("tf", "sum"), ("df", "sum")])
    return summed.select(["term", "tf_sum", "df_sum"]).rename_columns(["term", "tf", "df"])


def looked_up(keys: np.ndarray, known: np.ndarray, values: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """(a bit for each key that is known, the number of its value among the distinct ones, those); ``known`` ascends."""
    at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
    hit = known[at] == keys if len(known) else np.zeros(len(keys), bool)
    several, codes = np.unique(values[at[hit]], return_inverse=True)
    return np.packbits(hit).tobytes(), _planes(codes), several.astype("<f8").tobytes()


def answered(size: int, hit: bytes, codes: bytes, distinct: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(which of the ``size`` keys are known, their values, 0 for the others)."""
    known, values = np.unpackbits(np.frombuffer(hit, np.uint8), count=size).astype(bool), np.zeros(size)
    values[known] = np.frombuffer(distinct, "<f8")[_from_planes(codes)]
    return known, values


def known_terms(
    grams: Iterable[tuple], keys: np.ndarray, known: np.ndarray,
) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(terms, and of each cell its term, its text, its occurrences and the place of its key) for the known ones of the ascending keys of ``keyed_grams``."""
    terms, cells, count = [pa.array([], pa.string())], [], 0
    for words, ids, places, n, key, doc in grams:
        own, first, at = np.unique(key, return_index=True, return_inverse=True)
        where = np.searchsorted(keys, own)
        kept = known[where]
        number = np.cumsum(kept) - 1
        inside = kept[at]
        width = max(int(kept.sum()), 1)
        pairs, tf = np.unique(doc[inside] * width + number[at[inside]], return_counts=True)
        of, term = np.divmod(pairs, width)
        starts = places[first[kept]]
        terms.append(pc.binary_join_element_wise(*[words.take(pa.array(ids[starts + i])) for i in range(n)], " ").cast(pa.string()))
        cells.append((count + term, of, tf, where[kept][term]))
        count += len(starts)
    columns = [np.concatenate([np.zeros(0, np.int64), *c]) for c in zip(*cells)] if cells else [np.zeros(0, np.int64)] * 4
    return pa.concat_arrays(terms), *columns


class TermIndex:
    """Finds the n-grams of a vocabulary in texts or token lists."""

    def __init__(self, terms: Sequence[str], lo: int, hi: int, stops: Sequence[str]):
        self.size, self.stops = len(terms), list(stops)
        split = [t.split(" ") for t in terms]
        self.words = sorted({w for parts in split for w in parts})
        number = {w: i for i, w in enumerate(self.words)}
        self.base = max(len(self.words), 1)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in range(lo, hi + 1):
            own = [(i, parts) for i, parts in enumerate(split) if len(parts) == n]
            key = np.zeros(len(own), np.int64)
            for j in range(n):
                key = key * self.base + np.array([number[parts[j]] for _, parts in own], np.int64)
            order = np.argsort(key)
            self.by_length[n] = key[order], np.array([i for i, _ in own], np.int64)[order]

    def count(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(term numbers, occurrences, distinct terms of each row), ascending within a row."""
        stops, known = pa.array(self.stops, pa.string()), pa.array(self.words, pa.string())
        terms, counts, totals = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for flat, sizes in _stretches(column, COUNTED_BYTES):
            words, ids, doc = _numbered(flat, sizes, stops)
            own = pc.index_in(words, value_set=known).fill_null(-1).to_numpy().astype(np.int64)
            ids = own[ids] if len(ids) else ids
            cells = [np.zeros(0, np.int64)]
            for n, (keys, numbers) in self.by_length.items():
                if len(keys):
                    places = _places(ids, doc, n)
                    key, of = _keys(ids, places, n, self.base), doc[places]
                    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                    hit = keys[at] == key
                    cells.append(of[hit] * self.size + numbers[at[hit]])
            found, times = np.unique(np.concatenate(cells), return_counts=True)
            row, term = np.divmod(found, self.size)
            terms.append(term)
            counts.append(times)
            totals.append(np.bincount(row, minlength=len(sizes)))
            pa.default_memory_pool().release_unused()
        return np.concatenate(terms), np.concatenate(counts), np.concatenate(totals)


def as_lists(items: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), items)


def sparse_vectors(size: int, indices: np.ndarray, values: np.ndarray, sizes: np.ndarray) -> pa.StructArray:
    """Sparse vectors in the form Spark stores them."""
    return pa.StructArray.from_arrays([
        pa.array(np.zeros(len(sizes)), pa.int8()), pa.array(np.full(len(sizes), size), pa.int32()),
        as_lists(pa.array(indices, pa.int32()), sizes), as_lists(pa.array(values, pa.float64()), sizes),
    ], names=["type", "size", "indices", "values"])


def dense_vectors(rows: np.ndarray) -> pa.StructArray:
    """Dense vectors in the form Spark stores them."""
    n, width = rows.shape
    return pa.StructArray.from_arrays([
        pa.array(np.ones(n), pa.int8()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int32())), as_lists(pa.array(rows.ravel()), np.full(n, width)),
    ], names=["type", "size", "indices", "values"])


def tfidf_weights(counts: pa.StructArray, idf: np.ndarray, sublinear: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term numbers, weights, terms of each row) of sparse counts, rows scaled to length 1."""
    lists = counts.field("indices")
    sizes = lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    at = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    tf = counts.field("values").flatten().to_numpy(zero_copy_only=False)
    weights = (np.log(tf) + 1 if sublinear else tf) * idf[at]
    norms, full = np.ones(len(sizes)), np.flatnonzero(sizes)
    if len(full):
        norms[full] = np.sqrt(np.add.reduceat(weights * weights, (np.cumsum(sizes) - sizes)[full]))
    return at, weights / np.repeat(norms, sizes), sizes
