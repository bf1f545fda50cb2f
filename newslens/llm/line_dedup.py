"""Repeated and nearly repeated lines across documents, by a segment-partition edit join.

Two lines at edit distance at most t, cut into t + 1 segments, agree in one segment whole. Every
distinct line is indexed under its segments, and probes, for each length within t of its own,
the substrings that can meet such a segment. This is done twice: over characters, and over words,
so that lines that differ in a word meet however many characters it has. A line's probes grow with the cube of the
threshold (2 for one edit, 22 for three, some 1,400 for fifteen), so the threshold in
characters grows with the line only where one word is at stake. Lines that meet are verified by banded
bit-parallel edit distance: bit o of word d says that the first i characters of one line and
i + o of the other are within d edits. Lines that meet in a crowded segment are compared in
blocks of bounded size instead of being paired first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from newslens.llm.graph import components, maybe_among, store
from newslens.llm.text import buffers, mix
from newslens.session import materialize

EDITS, LEAST_CHARS = 1, 20
#: Words in which two lines may differ, and for each edit within those words so many characters of the shorter line; MOST_EDITS at most.
WORD_EDITS, CHARS_AN_EDIT, MOST_EDITS = 1, 20, 15
#: Bytes of text handled at once, lines from which a segment is crowded, lines on a side of a block, cells of the padded pairs verified at once.
PIECE, CROWDED, BLOCK, CELLS = 1 << 19, 64, 256, 1 << 20
_P = 0x9E3779B97F4A7C15
_Q = 0xA24BAED4963EE407
_INVERSE = pow(_P, -1, 2**64)


_tables: dict[int, np.ndarray] = {}


def _table(base: int, n: int) -> np.ndarray:
    """At least ``n`` powers of ``base``; a worker keeps one table of each base."""
    if len(_tables.get(base, ())) < n:
        steps = np.full(1 << max(16, n.bit_length()), np.uint64(base))
        steps[0] = 1
        _tables[base] = np.multiply.accumulate(steps)
    return _tables[base]


def _points(data: bytes) -> np.ndarray:
    return np.frombuffer(data.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)


class Lines:
    """The lines of some texts as code points, with hashes of any part of them."""

    def __init__(self, texts: pa.Array, least: int):
        data, offsets = buffers(texts)
        points = _points(data.tobytes())
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        bounds = lead[offsets]
        breaks = np.flatnonzero(points == 10)
        # a text ends a line; an empty text has one empty line
        starts = np.concatenate([bounds[:-1], breaks + 1])
        text = np.concatenate([np.arange(len(bounds) - 1), np.searchsorted(bounds, breaks, "right") - 1])
        order = np.lexsort((starts, text))
        self.start, self.text = starts[order], text[order]
        end = np.concatenate([breaks, bounds[1:]])
        end_text = np.concatenate([text[len(bounds) - 1 :], np.arange(len(bounds) - 1)])
        self.end = end[np.lexsort((end, end_text))]
        first = np.searchsorted(self.text, np.arange(len(bounds) - 1))
        self.number = np.arange(len(self.text)) - first[self.text]
        self.count = np.diff(np.append(first, len(self.text)))
        self.points, self.size = points, self.end - self.start
        self.pick = np.flatnonzero(self.size >= least)
        n = len(points) + 1
        codes = mix(points.astype(np.uint64) + np.uint64(1))
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(codes * _table(_P, n)[: n - 1], dtype=np.uint64)])
        other = mix(codes) * _table(_Q, n)[: n - 1]
        self.other = np.concatenate([[np.uint64(0)], np.cumsum(other, dtype=np.uint64)])
        self.back, self.other_back = _table(_INVERSE, n), _table(pow(_Q, -1, 2**64), n)

    def hash(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return mix((self.sums[high] - self.sums[low]) * self.back[low] + (high - low).astype(np.uint64))

    def second(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return mix((self.other[high] - self.other[low]) * self.other_back[low] + (high - low).astype(np.uint64))


def _segment(size: np.ndarray, i: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of segment ``i`` (from 0) of lines of these sizes."""
    short, longer = np.divmod(size, edits + 1)
    plain = edits + 1 - longer  # the last ones are a character longer
    return i * short + np.maximum(i - plain, 0), short + (i >= plain)


def _key(hashes: np.ndarray, size: np.ndarray, i: int) -> np.ndarray:
    return mix(hashes + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64((i + 1) * _Q % 2**64)).view(np.int64)


def keys(lines: Lines, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """(index keys, probe keys) of the eligible lines, a row each. A probe that equals an index key is not listed again."""
    start, size = lines.start[lines.pick], lines.size[lines.pick]
    index, probes = [], []
    for i in range(edits + 1):
        at, length = _segment(size, i, edits)
        index.append(_key(lines.hash(start + at, start + at + length), size, i))
        for shorter in range(edits + 1):
            other = size - shorter
            at, length = _segment(other, i, edits)
            for shift in range(max(-i, shorter - (edits - i)), min(i, shorter + edits - i) + 1):
                if shorter == 0 and shift == 0:
                    continue
                low = at + shift
                ok = (low >= 0) & (low + length <= size) & (other > 0)
                low = np.where(ok, low, 0)
                found = _key(lines.hash(start + low, start + low + np.where(ok, length, 0)), other, i)
                # an impossible probe gets a key of the line's own
                own = mix(lines.hash(start, start + size) + np.uint64(i * 64 + shorter * 8 + shift + edits + 77)).view(np.int64)
                probes.append(np.where(ok, found, own))
    stack = lambda rows: np.stack(rows, axis=1) if rows else np.zeros((len(size), 0), np.int64)
    return stack(index), stack(probes)


def word_keys(lines: Lines, edits: int = WORD_EDITS) -> tuple[np.ndarray, np.ndarray]:
    """As ``keys``, of words: what stands between single blanks. Lines of too few words get keys of their own."""
    start, end = lines.start[lines.pick], lines.end[lines.pick]
    blanks = np.flatnonzero(lines.points == 0x20)
    first, last = np.searchsorted(blanks, start), np.searchsorted(blanks, end)
    size = last - first + 1
    # bounds[first + k] is where word k of a line ends
    padded = np.append(blanks, 0)
    whole = lines.hash(start, end)

    def part(word: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Hash of ``count`` words from ``word`` on."""
        low = np.where(word > 0, padded[np.minimum(first + word - 1, len(blanks))] + 1, start)
        high = np.where(word + count < size, padded[np.minimum(first + word + count - 1, len(blanks))], end)
        return lines.hash(low, np.maximum(high, low))

    index, probes = [], []
    own = lambda salt: mix(whole + np.uint64(salt * _Q % 2**64)).view(np.int64)
    for i in range(edits + 1):
        at, length = _segment(size, i, edits)
        ok = size > edits
        index.append(np.where(ok, _key(part(at, length) ^ np.uint64(_Q), size, i + 50), own(900 + i)))
        for shorter in range(edits + 1):
            other = size - shorter
            at, length = _segment(other, i, edits)
            for shift in range(max(-i, shorter - (edits - i)), min(i, shorter + edits - i) + 1):
                if shorter == 0 and shift == 0:
                    continue
                low = at + shift
                ok = (low >= 0) & (low + length <= size) & (other > edits)
                low, length_ = np.where(ok, low, 0), np.where(ok, length, 0)
                probes.append(np.where(ok, _key(part(low, length_) ^ np.uint64(_Q), other, i + 50), own(1000 + i * 64 + shorter * 8 + shift + edits)))
    stack = lambda rows: np.stack(rows, axis=1) if rows else np.zeros((len(size), 0), np.int64)
    return stack(index), stack(probes)


def words_apart(one: np.ndarray, two: np.ndarray, most: int = WORD_EDITS) -> bool:
    """Whether two lines, as code points, differ in at most ``most`` words that follow one another: all but those
    at their ends agree. For one word this is the edit distance in words."""
    a, b = (x.tobytes().decode("utf-32-le", "surrogatepass").split(" ") for x in (one, two))
    if abs(len(a) - len(b)) > most:
        return False
    same = min(len(a), len(b))
    head = next((k for k in range(same) if a[k] != b[k]), same)
    tail = next((k for k in range(same - head) if a[-1 - k] != b[-1 - k]), same - head)
    return max(len(a), len(b)) - head - tail <= most


class _Words:
    """The words of some lines, by number, padded from either end."""

    def __init__(self, lines: list[np.ndarray]):
        split = [x.tobytes().decode("utf-32-le", "surrogatepass").split(" ") for x in lines]
        number: dict[str, int] = {}
        self.sizes = np.array([len(w) for w in split])
        self.head = np.full((len(split), int(self.sizes.max())), -1, np.int32)
        self.tail = self.head.copy()
        for i, words in enumerate(split):
            codes = [number.setdefault(w, len(number)) for w in words]
            self.head[i, : len(codes)], self.tail[i, : len(codes)] = codes, codes[::-1]

    def apart(self, i: int, j: np.ndarray) -> np.ndarray:
        """As ``words_apart`` counts: words of the longer line between what agrees at both ends, for line i and lines j."""
        shorter, longer = np.minimum(self.sizes[i], self.sizes[j]), np.maximum(self.sizes[i], self.sizes[j])
        agree = 0
        for side in (self.head, self.tail):
            differ = side[j] != side[i]
            agree = agree + np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), side.shape[1]), shorter)
        return longer - np.minimum(agree, shorter)


def limits(sizes_a: np.ndarray, sizes_b: np.ndarray, edits: int) -> np.ndarray:
    """Edits that two lines of these sizes may be apart, if within one word."""
    return np.maximum(edits, np.minimum(MOST_EDITS, np.minimum(sizes_a, sizes_b) // CHARS_AN_EDIT))


def alike(one: list[np.ndarray], two: list[np.ndarray], edits: int) -> np.ndarray:
    """Which pairs are linked: at an edit distance of at most ``edits``, or of ``limits`` if they differ in one word."""
    ok = within(one, two, edits)
    wide = limits(np.array([len(a) for a in one], np.int64), np.array([len(b) for b in two], np.int64), edits)
    rows = np.array([k for k in np.flatnonzero(~ok & (wide > edits)).tolist() if words_apart(one[k], two[k])], np.int64)
    ok[rows] = _within_limits([one[k] for k in rows], [two[k] for k in rows], wide[rows])
    return ok


def _middles(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two lines without what they begin and end with alike; their distance is the same."""
    shorter = min(len(a), len(b))
    differ = np.flatnonzero(a[:shorter] != b[:shorter])
    head = int(differ[0]) if len(differ) else shorter
    a, b, shorter = a[head:], b[head:], shorter - head
    differ = np.flatnonzero(a[len(a) - shorter :][::-1] != b[len(b) - shorter :][::-1])
    tail = int(differ[0]) if len(differ) else shorter
    return a[: len(a) - tail], b[: len(b) - tail]


def _within_limits(one: list[np.ndarray], two: list[np.ndarray], edits: np.ndarray) -> np.ndarray:
    """As ``within``, with a limit for each pair; for lines that differ in one place."""
    ok, cut = np.zeros(len(one), bool), [_middles(a, b) for a, b in zip(one, two)]
    for t in np.unique(edits).tolist():
        rows = np.flatnonzero(edits == t).tolist()
        ok[rows] = within([cut[k][0] for k in rows], [cut[k][1] for k in rows], t)
    return ok


def within(one: list[np.ndarray], two: list[np.ndarray], edits: int) -> np.ndarray:
    """Which pairs of code-point arrays are at edit distance at most ``edits`` (below 16)."""
    n = len(one)
    sizes_a, sizes_b = np.array([len(a) for a in one]), np.array([len(b) for b in two])
    close = np.abs(sizes_a - sizes_b) <= edits
    ok = np.zeros(n, bool)
    order = np.flatnonzero(close)
    order = order[np.argsort(sizes_a[order], kind="stable")]
    begin = 0
    while begin < len(order):  # shorter pairs first, so many as fit the cells when padded to the longest
        cells = np.arange(1, len(order) - begin + 1) * (sizes_a[order[begin:]] + 1)
        rows = order[begin : begin + max(1, int(np.searchsorted(cells, CELLS, "right")))]
        ok[rows] = _band([one[r] for r in rows], [two[r] for r in rows], sizes_a[rows], sizes_b[rows], edits)
        begin += len(rows)
    return ok


def _padded(rows: list[np.ndarray], sizes: np.ndarray, before: int, width: int, fill: int) -> np.ndarray:
    out = np.full((len(rows), width), fill, np.uint32)
    out[np.repeat(np.arange(len(rows)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + before] = np.concatenate(rows)
    return out


def _band(one, two, sizes_a, sizes_b, t) -> np.ndarray:
    longest = int(sizes_a.max())
    a = _padded(one, sizes_a, 0, max(longest, 1), 0xFFFFFFFE)
    b = _padded(two, sizes_b, t, longest + 2 * t + 1, 0xFFFFFFFF)
    full = np.uint64((1 << (2 * t + 1)) - 1)
    # bit t + o stands for the diagonal o
    words = [np.full(len(one), ((1 << (d + 1)) - 1) << t, np.uint64) for d in range(t + 1)]
    target = np.uint64(1) << (sizes_b - sizes_a + t).astype(np.uint64)
    result, open_ = np.zeros(len(one), bool), np.arange(len(one))
    for i in range(longest + 1):
        done = sizes_a == i
        if done.any():
            result[open_[done]] = (words[t][done] & target[done]) != 0
        if i % 16 == 0 or i == longest:
            go = (words[t] != 0) & (sizes_a > i)
            if not go.any():
                break
            if not go.all():
                a, b, sizes_a, target, open_ = a[go], b[go], sizes_a[go], target[go], open_[go]
                words = [w[go] for w in words]
        same = np.zeros(len(open_), np.uint64)
        for o in range(2 * t + 1):
            same |= (a[:, i] == b[:, i + o]).astype(np.uint64) << np.uint64(o)
        next_ = []
        for d in range(t + 1):
            word = words[d] & same
            if d:
                word |= words[d - 1] | (words[d - 1] >> np.uint64(1)) | (next_[d - 1] << np.uint64(1))
            next_.append(word & full)
        words = next_
    return result


def _scan(docs: DataFrame, id_col: str, text_col: str, edits: int, least: int) -> DataFrame:
    """(doc_id, line, n_lines, h1, h2, index, probes, chars): a row per line that is not empty, and one without line per document."""
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("_text"))

    def lists(values: np.ndarray, extra: int) -> pa.Array:
        at = np.concatenate([np.arange(len(values) + 1) * values.shape[1], np.full(extra, values.size)])
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values.reshape(-1)))

    def run(batches):
        for batch in batches:
            _, offsets = buffers(batch.column(1))
            low = 0
            while low < batch.num_rows:
                high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + PIECE, "right")) - 1)
                ids, lines = batch.column(0).slice(low, high - low), Lines(batch.column(1).slice(low, high - low), least)
                # keys over words are odd, those over characters even
                index, probes = (np.concatenate([a & ~1, b | 1], axis=1) for a, b in zip(keys(lines, edits), word_keys(lines)))
                # lines too short to be compared follow with their hashes only
                short = np.flatnonzero((lines.size > 0) & (lines.size < least))
                lines.pick = np.concatenate([lines.pick, short])
                start, end = lines.start[lines.pick], lines.end[lines.pick]
                extra = high - low
                none = pa.nulls(extra, pa.int64())
                both = lambda own, doc: pa.concat_arrays([pa.array(own), doc])
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([ids.take(pa.array(lines.text[lines.pick])), ids]), both(lines.number[lines.pick].astype(np.int64), none),
                    pa.concat_arrays([pa.nulls(len(start), pa.int64()), pa.array(lines.count.astype(np.int64))]),
                    both(lines.hash(start, end).view(np.int64), none), both(lines.second(start, end).view(np.int64), none),
                    lists(index, extra + len(short)), lists(probes, extra + len(short)), both(lines.size[lines.pick].astype(np.int64), none),
                ], names=["doc_id", "line", "n_lines", "h1", "h2", "index", "probes", "chars"])
                low = high

    return source.mapInArrow(run, "doc_id bigint, line bigint, n_lines bigint, h1 bigint, h2 bigint, index array<bigint>, probes array<bigint>, chars bigint")


def _texts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(first, text) of the wanted lines, each known by its place (first.doc_id, first.line) and hashes h1, h2."""
    per_doc = wanted.groupBy(F.col("first.doc_id").alias("_doc")).agg(F.collect_list(F.struct("first", "h1", "h2")).alias("_wanted"))
    per_doc = store(per_doc, "wanted")
    source = docs.select(F.col(id_col).cast("bigint").alias("_doc"), F.col(text_col).cast("binary").alias("_text"))
    joined = maybe_among(source, "_doc", per_doc, "_doc").join(per_doc, "_doc").select("_text", "_wanted")

    def run(batches):
        for batch in batches:
            places, texts = [], []
            for text, wanted in zip(batch.column(0), batch.column(1).to_pylist()):
                lines = Lines(pa.array([text.as_py()], pa.binary()), 0)
                for w in wanted:
                    i = w["first"]["line"]
                    low, high = (np.array([x[i]]) for x in (lines.start, lines.end)) if i < len(lines.start) else (None, None)
                    # rows may repeat an id with another text
                    if low is not None and lines.hash(low, high).view(np.int64)[0] == w["h1"] and lines.second(low, high).view(np.int64)[0] == w["h2"]:
                        places.append(w["first"])
                        texts.append(lines.points[low[0] : high[0]].astype("<u4").tobytes())
            kind = pa.struct([("doc_id", pa.int64()), ("line", pa.int64())])
            yield pa.RecordBatch.from_arrays([pa.array(places, kind), pa.array(texts, pa.binary())], names=["first", "points"])

    return joined.mapInArrow(run, "first struct<doc_id:bigint,line:bigint>, points binary").dropDuplicates(["first"])


def _points_of(column) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u4") for x in column.to_pylist()]


_LINE = "struct<doc_id:bigint,line:bigint>"


def _verified(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    one, two = (texts.select(F.col("first").alias(n), F.col("points").alias(f"_{n}")) for n in "ab")

    def run(batches):
        for b in batches:
            ok = alike(_points_of(b.column(2)), _points_of(b.column(3)), edits) if b.num_rows else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok))

    return pairs.join(one, "a").join(two, "b").select("a", "b", "_a", "_b").mapInArrow(run, f"a {_LINE}, b {_LINE}")


def _crowded_links(members: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """Links among lines that meet in a crowded segment, (key, n, first, indexed): by blocks of bounded size."""
    cuts = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = members.withColumn("cut", F.pmod(F.xxhash64("first"), cuts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), cuts - 1)))
    dealt = dealt.select("key", F.least("cut", "other").alias("low"), F.greatest("cut", "other").alias("high"), "cut", "indexed", "first")

    def block(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        cut, indexed = table["cut"].to_numpy(), table["indexed"].to_numpy()
        points, places = _points_of(table["points"]), table["first"].to_pylist()
        sizes = np.array([len(p) for p in points])
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        rank = np.empty(len(places), np.int64)
        rank[sorted(range(len(places)), key=lambda i: (places[i]["doc_id"], places[i]["line"]))] = np.arange(len(places))
        # lines within ``edits`` characters meet over characters too, so each kind of key looks for its own kind of link
        words = _Words(points) if table["key"][0].as_py() & 1 else None
        left, right, most = [], [], []
        for i in range(len(points)):
            limit = limits(sizes, sizes[i], edits) if words else np.full(len(sizes), edits)
            near = (np.abs(sizes - sizes[i]) <= limit) & (rank > rank[i]) & (indexed | indexed[i])
            near &= (cut != cut[i]) if low != high else True
            j = np.flatnonzero(near)
            if words and len(j):
                j = j[words.apart(i, j) <= WORD_EDITS]
            left += [i] * len(j)
            right += j.tolist()
            most.append(limit[j])
        one, two = [points[i] for i in left], [points[k] for k in right]
        ok = _within_limits(one, two, np.concatenate(most)) if words else within(one, two, edits)
        hits = [(i, k) for i, k, good in zip(left, right, ok.tolist()) if good]
        kind = table.schema.field("first").type
        return pa.table({"a": pa.array([places[i] for i, _ in hits], kind), "b": pa.array([places[k] for _, k in hits], kind)})

    return dealt.join(texts, "first").groupBy("key", "low", "high").applyInArrow(block, f"a {_LINE}, b {_LINE}")


def line_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, least_chars: int = LEAST_CHARS,
) -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, n_lines; lines: doc_id, line, chars, first, n_links, component).

    Lines are what lies between line feeds. ``lines`` has a row for every line that is not empty and whose text occurs
    again, or is linked with another text. Texts of at least ``least_chars`` characters are linked at an edit
    distance of at most ``edits``, or, if they differ in one word only, of one edit for every ``CHARS_AN_EDIT``
    characters of the shorter one, up to ``MOST_EDITS``. ``first`` is the place (doc_id, line) of the text's first
    occurrence, ``n_links`` the number of other distinct texts linked, ``component`` the
    first place reachable by links. Null texts have one empty line; null ids take no part.
    """
    if not 0 <= edits < least_chars or edits > 15:
        raise ValueError("edits must be below the least number of characters, and at most 15")
    stored = materialize(_scan(docs, id_col, text_col, edits, least_chars), "lines")
    places = stored.where("line is not null and doc_id is not null")
    texts_of = places.groupBy("h1", "h2").agg(
        F.min(F.struct("doc_id", "line")).alias("first"), F.count(F.lit(1)).alias("n"), F.first("chars").alias("chars"),
        F.first("index").alias("index"), F.first("probes").alias("probes"))
    texts_of = materialize(texts_of, "texts")
    index = texts_of.select(F.explode("index").alias("key"), "first", "h1", "h2", F.lit(True).alias("indexed"))
    rows = index.unionByName(texts_of.select(F.explode("probes").alias("key"), "first", "h1", "h2", F.lit(False).alias("indexed")))
    met = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("indexed").alias("any")).where("n > 1 and any").drop("any")
    met = materialize(rows.join(met, "key"), "met")
    wanted = met.select("first", "h1", "h2").distinct()
    texts = store(_texts(docs, wanted, id_col, text_col), "met_texts")
    few = met.where(F.col("n") <= CROWDED)
    pairs = few.where("indexed").select("key", F.col("first").alias("a")).join(few.select("key", F.col("first").alias("b")), "key").where("a <> b")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    crowd = met.where(F.col("n") > CROWDED).groupBy("key", "n", "first").agg(F.max("indexed").alias("indexed"))
    links = store(_verified(pairs, texts, edits).unionByName(_crowded_links(crowd, texts, edits)).distinct(), "line_links")
    degree = links.select("a").union(links.select("b")).groupBy("a").agg(F.count(F.lit(1)).alias("n_links")).withColumnRenamed("a", "_a")
    joined = components(links)
    known = texts_of.select("h1", "h2", "first", "n", "chars").join(degree, F.col("first") == F.col("_a"), "left").drop("_a").join(
        joined, F.col("first") == F.col("node"), "left").where("n > 1 or node is not null")
    known = known.select("h1", "h2", "chars", "first", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "first").alias("component"))
    lines = places.select("doc_id", "line", "h1", "h2").join(known, ["h1", "h2"]).drop("h1", "h2")
    return stored.where("line is null").select("doc_id", "n_lines"), materialize(lines, "line_classes")


def repeats(lines: DataFrame) -> Column:
    """Whether a row of ``line_classes`` is not the first line of its component."""
    return F.struct("doc_id", "line") != F.col("component")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """The documents without lines that repeat, or nearly repeat, an earlier one (by id, then line).

    The first line of each class stays, and so do lines of fewer than ``least_chars`` characters. A document that had lines and loses them all is
    dropped; one that had no text stays. Columns and other lines are unchanged. Of rows that
    repeat an id all lose the lines found under that id and number.
    """
    _, lines = line_classes(docs, id_col, text_col, edits, least_chars)
    lost = lines.where(repeats(lines) & (F.col("chars") >= least_chars)).groupBy(F.col("doc_id").alias("_doc")).agg(
        F.collect_set("line").alias("_lost"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"))
    joined = rows.join(lost, F.col("_id") == F.col("_doc"), "left")
    # array positions serve as line numbers
    kept = F.filter(F.split("_text", "\n", -1), lambda x, i: ~F.array_contains("_lost", i.cast("bigint")))
    changed = F.when(F.col("_lost").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n"))
    out = joined.withColumn("_new", changed).where(F.col("_lost").isNull() | (F.trim("_new") != ""))
    return out.select(*(F.col("_new" if c == text_col else f"_row.`{c}`").alias(c) for c in docs.columns))
