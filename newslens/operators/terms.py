"""Vocabularies, term counts and TF-IDF.

Spark leaves a text's words with blanks between them; n-grams are counted in Arrow batches (``grams``), which
give occurrences and documents per term of a stretch of articles. Those partial sums meet by segments of the
terms' hash, compressed, and give term and document frequency together; no (document, term) pair is
ever shuffled. The capped vocabulary is small by construction, so applying it is row-local again.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from newslens.functions.dictionary import MAX_ENTRIES, Dictionary
from newslens.functions.fence import fenced
from newslens.functions.text import NOT_TERM, TERM
from newslens.functions.wordlists import STOP_WORDS
from newslens.operators import grams as arrow
from newslens.operators.sampling import with_position
from newslens.session import materialize

# A fitted vocabulary is collected to the driver and shipped with tasks, so it is bounded;
# a vocabulary table is not.
MAX_VOCABULARY = MAX_ENTRIES
VOCABULARY_SCHEMA = "idx int, term string, tf bigint, df bigint, idf double"
PLAIN, SUBLINEAR = "plain", "sublinear"
#: Bytes of the texts that ``tfidf_by_join`` weighs together, and the vocabulary terms a task holds before it sends them.
PIECE_BYTES, OFFERED = 1 << 22, 1 << 20
REQUEST_SCHEMA = "segment int, piece int, keys binary, idf binary"


@dataclass(frozen=True)
class TermSettings:
    """How text becomes terms and which terms are kept."""

    ngrams: tuple[int, int] = (1, 3)
    max_features: int | None = 17_500  # None: every term within the document-frequency limits
    max_df: float = 0.95
    min_df: int = 2
    stop_words: tuple[str, ...] = tuple(STOP_WORDS)

    def __post_init__(self):
        lo, hi = self.ngrams
        if not 1 <= lo <= hi <= 3:
            raise ValueError("ngrams must lie between 1 and 3")
        if self.max_features is not None and self.max_features < 1:
            raise ValueError("max_features must be at least 1")


BASIC = TermSettings()
TUNED = TermSettings(max_features=21_000, min_df=3)


def analyzed_tokens(text_col: Column, stop_words: tuple[str, ...]) -> Column:
    """Lower-case runs of two or more word characters, stop words removed."""
    tokens = F.regexp_extract_all(F.lower(text_col), F.lit(TERM), F.lit(0))
    return F.filter(tokens, lambda t: ~t.isin(list(stop_words))) if stop_words else tokens


def grams(tokens: Column, lo: int, hi: int) -> Column:
    """All n-grams of the token array for lo <= n <= hi, words joined by a space."""
    n = F.size(tokens)
    join = lambda a, b: F.concat(a, F.lit(" "), b)

    def cut(items: Column, start: int, fewer: int) -> Column:
        return F.slice(items, F.lit(start), F.greatest(n - fewer, F.lit(0)))

    pairs = F.zip_with(cut(tokens, 1, 1), cut(tokens, 2, 1), join)
    triples = F.zip_with(cut(pairs, 1, 2), cut(tokens, 3, 2), join)
    return F.concat(*[tokens, pairs, triples][lo - 1:hi])


def with_grams(df: DataFrame, text_col: str, settings: TermSettings, name: str = "_grams") -> DataFrame:
    tokens = analyzed_tokens(F.coalesce(F.col(text_col), F.lit("")), settings.stop_words)
    staged = df.withColumn("_terms", tokens)
    return fenced(staged, **{name: grams(F.col("_terms"), *settings.ngrams)}).drop("_terms")


def parted_words(text_col: str) -> Column:
    """The lower-case text with a blank for whatever parts its words; one text crosses to Arrow in place of many words."""
    return F.regexp_replace(F.lower(F.coalesce(F.col(text_col), F.lit(""))), NOT_TERM, " ")


def store_parted(df: DataFrame, text_col: str) -> DataFrame:
    """``df``, written with ``parted_words`` in place of the texts, for steps that take them ``parted``: texts are cut once for all."""
    return materialize(df.withColumn(text_col, parted_words(text_col)), "texts")


def _words_of(text_col: str, parted: bool) -> Column:
    return F.coalesce(F.col(text_col), F.lit("")) if parted else parted_words(text_col)


def _words(df: DataFrame, text_col: str, *keep: Column | str, parted: bool = False) -> DataFrame:
    """The words of each text, stop words included, as ``words``."""
    return df.select(*keep, _words_of(text_col, parted).alias("words"))


def term_statistics(df: DataFrame, text_col: str, settings: TermSettings = BASIC) -> DataFrame:
    """(term, tf, df) over all terms, before any filter or cap."""
    return _statistics(_words(df, text_col), settings, *settings.ngrams, _pieces(df, text_col))


def _pieces(df: DataFrame, text_col: str) -> int:
    """In how many pieces of PIECE_BYTES the texts would lie."""
    return max(1, math.ceil((df.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0) / PIECE_BYTES))


def _statistics(
    words: DataFrame, settings: TermSettings, lo: int, hi: int, pieces: int, mask: np.ndarray | None = None, filled: np.ndarray | None = None,
) -> DataFrame:
    """(term, tf, df) of the n-grams over ``words``, lo <= n <= hi; with masks, of those whose words and slots they know.

    Terms meet by segments of their hash, compressed; segments grow in number with the ``pieces`` of the texts.
    Single words, and n-grams behind masks, are few beside all n-grams.
    """
    stops, bits = settings.stop_words, (4 * pieces if hi > 1 and filled is None else pieces // 2).bit_length()
    sent = words.sparkSession.sparkContext.broadcast((mask, filled))

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found, keys in arrow.keyed_statistics(batch.column("words"), stops, lo, hi, *sent.value):
                yield arrow.packed_terms(found, bits, keys)

    rows = words.mapInArrow(partial, "segment int, terms int, bytes int, packed binary")
    return rows.groupBy("segment").applyInArrow(arrow.summed_terms, "term string, tf bigint, df bigint")


def pruned_statistics(
    df: DataFrame, text_col: str, settings: TermSettings, documents: Column, parted: bool = False
) -> DataFrame:
    """(term, tf, df) without the n-grams that cannot be among the kept terms.

    An n-gram is no more frequent than its words. If ``max_features`` single
    words within the document-frequency limits occur at least t times, an n-gram
    needs t occurrences to be kept, so all of its words need t. Words below t
    are masked before the n-grams are formed. Those left are counted in slots by
    their hash first: an n-gram occurs no more often than its slot counts, so only
    slots that reach t have their n-grams formed and shuffled. Both masks have a
    fixed size: a rare word or n-gram that shares a slot gets through, and none is
    lost. The texts are cut once and read three times; stored ones that are ``parted`` are not written again.
    """
    words, stop = _words(df, text_col, parted=True) if parted else materialize(_words(df, text_col), "texts"), settings.ngrams[1]
    pieces = _pieces(words, "words")
    singles = materialize(_statistics(words, settings, 1, 1, pieces), "words")
    within = singles.where(_within(settings, documents))
    cut, above = _frequency_cut(within, settings.max_features)
    if above + within.where(F.col("tf") == cut).count() < settings.max_features:
        cut = settings.min_df  # every term within the limits is kept
    mask = _word_mask(singles.where(F.col("tf") >= cut))
    return singles.unionByName(_statistics(words, settings, 2, stop, pieces, mask, _filled_slots(words, settings, mask, cut)))


def _filled_slots(words: DataFrame, settings: TermSettings, mask: np.ndarray, least: int) -> np.ndarray:
    """Of each slot, whether at least ``least`` n-grams of known words fall into it; counts meet on executors."""
    stops, stop = settings.stop_words, settings.ngrams[1]
    sent = words.sparkSession.sparkContext.broadcast(mask)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from arrow.slot_counts((b.column("words") for b in batches), stops, 2, stop, sent.value)

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.int64) for x in table["counts"])
        return pa.table({"block": table["block"].slice(0, 1), "bits": pa.array([np.packbits(total >= least).tobytes()], pa.binary())})

    blocks = words.mapInArrow(partial, "block int, counts binary").groupBy("block").applyInArrow(add, "block int, bits binary").collect()
    filled = np.zeros(1 << arrow.SLOT_BITS, bool).reshape(-1, arrow.SLOT_BLOCK)
    for row in blocks:  # a bit for each slot
        filled[row["block"]] = np.unpackbits(np.frombuffer(row["bits"], np.uint8)).astype(bool)
    return filled.ravel()


def _word_mask(words: DataFrame) -> np.ndarray:
    """A bitmap that knows every one of the words, and few others."""
    slot = F.crc32(F.col("term").cast("binary")) % arrow.MASK_BITS
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("slot") % 64).cast("int"))
    filled = words.select(slot.alias("slot")).groupBy(F.floor(F.col("slot") / 64).alias("cell")).agg(F.bit_or(bit).alias("bits"))
    cells = np.zeros(arrow.MASK_BITS // 64, np.int64)
    for row in filled.collect():  # at most MASK_BITS / 64 rows
        cells[row["cell"]] = row["bits"]
    return cells


def _frequency_cut(kept: DataFrame, most: int) -> tuple[int, int]:
    """(lowest frequency among the ``most`` most frequent terms, how many terms are more frequent).

    Terms are counted by frequency first, of which there are few, so that no
    task gathers terms. With fewer terms the cut is the lowest frequency of all.
    """
    counts = kept.groupBy("tf").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(F.desc("tf")).rowsBetween(Window.unboundedPreceding, -1)
    reached = counts.withColumn("above", F.coalesce(F.sum("n").over(before), F.lit(0))).where(F.col("above") < most)
    row = reached.agg(F.min("tf").alias("cut"), F.max("above").alias("above")).first()
    return row["cut"] or 1, row["above"] or 0


def _within(settings: TermSettings, documents: Column) -> Column:
    return (F.col("df") >= settings.min_df) & (F.col("df") <= settings.max_df * documents)


def vocabulary_table(
    df: DataFrame, text_col: str, settings: TermSettings = BASIC, prune: bool = True, parted: bool = False
) -> DataFrame:
    """(idx, term, tf, df, idf): the most frequent terms within the document-frequency limits.

    ``idx`` numbers the kept terms alphabetically; ties in frequency are cut
    alphabetically; idf is ln((1+n)/(1+df)) + 1. Without ``max_features`` every
    term within the limits is kept. ``prune`` gives the same table with two more
    passes over the words in place of shuffling every n-gram; it applies where the
    single words are among the terms. ``parted`` texts are those of ``store_parted``.
    """
    documents = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    if prune and settings.max_features and settings.ngrams[0] == 1 < settings.ngrams[1]:
        statistics = pruned_statistics(df, text_col, settings, documents, parted)
    else:
        statistics = term_statistics(df, text_col, settings)
    idf = F.log((documents + 1) / (F.col("df") + F.lit(1.0))) + 1
    if settings.max_features is None:
        # written before they are ordered, as the ordering reads its rows twice
        numbered = with_position(materialize(statistics.where(_within(settings, documents)), "terms"), "term", name="idx")
        return numbered.select("idx", "term", "tf", "df", idf.alias("idf"))
    kept = materialize(statistics.where(_within(settings, documents)), "terms")
    cut, above = _frequency_cut(kept, settings.max_features)
    tied = kept.where(F.col("tf") == cut).orderBy("term").limit(max(settings.max_features - above, 0))
    # at most max_features rows from here on
    top = kept.where(F.col("tf") > cut).unionByName(tied)
    numbered = top.withColumn("idx", F.row_number().over(Window.orderBy("term")) - 1)
    return numbered.select("idx", "term", "tf", "df", idf.alias("idf"))


class Vocabulary:
    """A fitted vocabulary: turns text into sparse count and TF-IDF vectors."""

    def __init__(self, rows: list, settings: TermSettings):
        self.settings = settings
        ordered = sorted(rows, key=lambda r: r["idx"])
        self.rows = [(r["idx"], r["term"], r["tf"], r["df"], r["idf"]) for r in ordered]
        self.terms = [r["term"] for r in ordered]
        self.idf = [r["idf"] for r in ordered]

    @classmethod
    def fit(
        cls, df: DataFrame, text_col: str, settings: TermSettings = BASIC, prune: bool = True, parted: bool = False
    ) -> Vocabulary:
        if not 0 < (settings.max_features or 0) <= MAX_VOCABULARY:
            raise ValueError(f"max_features must lie between 1 and {MAX_VOCABULARY}; a table has no such limit")
        return cls(vocabulary_table(df, text_col, settings, prune, parted).collect(), settings)

    @classmethod
    def from_table(cls, table: DataFrame, settings: TermSettings) -> Vocabulary:
        rows = table.limit(MAX_VOCABULARY + 1).collect()
        if len(rows) > MAX_VOCABULARY:
            raise ValueError("the table is too large for a vocabulary; use tfidf_by_join")
        return cls(rows, settings)

    def __len__(self) -> int:
        return len(self.terms)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, VOCABULARY_SCHEMA)

    def count(
        self, df: DataFrame, text_col: str, name: str = "counts", parted: bool = False, weighted: tuple[str, str] | None = None,
        projected: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray] | None = None,
    ) -> DataFrame:
        """Add the sparse term-count vector; row-local.

        ``weighted`` names a column and a weighting: the vector of ``tfidf`` is added as well, by the same function,
        as a task keeps a Python worker for each of several. With ``projected``, a function of sparse rows as
        ``SvdProjection.projection`` gives it, that column holds what it makes of the vector. ``parted`` texts are those of ``store_parted``.
        """
        if not self.terms:
            raise ValueError("the vocabulary is empty; lower min_df or raise max_df")
        index = arrow.TermIndex(self.terms, *self.settings.ngrams, self.settings.stop_words)
        sent, size = df.sparkSession.sparkContext.broadcast(index), len(self)

        def vectors(words: pa.Array) -> pa.Array:
            return arrow.sparse_vectors(size, *sent.value.count(words))

        words = _words_of(text_col, parted)
        if weighted is None:
            return df.withColumn(name, F.arrow_udf(vectors, VectorUDT())(words))
        weights = self._weights(df, weighted[1])

        @F.arrow_udf(StructType([StructField("counts", VectorUDT()), StructField("weighted", VectorUDT())]))
        def both(words: pa.Array) -> pa.Array:
            parts = []
            for low, high in list(arrow.row_stretches(words, arrow.COUNTED_BYTES)) or [(0, 0)]:
                counted = vectors(words[low:high])
                cells = weights(counted)
                other = arrow.dense_vectors(projected(*cells)) if projected else arrow.sparse_vectors(size, *cells)
                parts.append(pa.StructArray.from_arrays([counted, other], names=["counts", "weighted"]))
            pa.default_memory_pool().release_unused()
            return pa.concat_arrays(parts)

        # behind a generator, so that using both vectors does not evaluate the function twice
        return df.select("*", F.inline(F.array(both(words))).alias(name, weighted[0]))

    def weigh(self, df: DataFrame, counts_col: str, name: str = "entries", weighting: str = PLAIN) -> DataFrame:
        """Add array<struct<idx, weight>>, the L2-normalised TF-IDF row of a count vector; row-local.

        An article without vocabulary terms gives an empty array.
        """
        weights = self._weights(df, weighting)

        @F.arrow_udf("array<struct<idx:int,weight:double>>")
        def entries(counts: pa.Array) -> pa.Array:
            at, weight, sizes = weights(counts)
            cells = pa.StructArray.from_arrays([pa.array(at, pa.int32()), pa.array(weight)], names=["idx", "weight"])
            return arrow.as_lists(cells, sizes)

        return df.withColumn(name, entries(F.unwrap_udt(counts_col)))

    def tfidf(self, df: DataFrame, counts_col: str, name: str = "tfidf", weighting: str = PLAIN) -> DataFrame:
        """Add the sparse TF-IDF vector of a count vector; row-local."""
        weights, size = self._weights(df, weighting), len(self)

        @F.arrow_udf(VectorUDT())
        def vectors(counts: pa.Array) -> pa.Array:
            return arrow.sparse_vectors(size, *weights(counts))

        return df.withColumn(name, vectors(F.unwrap_udt(counts_col)))

    def _weights(self, df: DataFrame, weighting: str):
        """A function of sparse counts: (term numbers, weights, terms of each row)."""
        if weighting not in (PLAIN, SUBLINEAR):
            raise ValueError(f"weighting must be '{PLAIN}' or '{SUBLINEAR}'")
        sent, sublinear = df.sparkSession.sparkContext.broadcast(np.array(self.idf, float)), weighting == SUBLINEAR
        return lambda counts: arrow.tfidf_weights(counts, sent.value, sublinear)

    @staticmethod
    def _frequency(tf: Column, weighting: str) -> Column:
        if weighting == SUBLINEAR:
            return F.log(tf) + 1
        if weighting == PLAIN:
            return tf
        raise ValueError(f"weighting must be '{PLAIN}' or '{SUBLINEAR}'")

    def dictionary(self, offset: int = 0) -> Dictionary:
        """term -> idx (+ offset) as a plan literal."""
        return Dictionary({t: i + offset for i, t in enumerate(self.terms)}, "int")


def count_entries(df: DataFrame, counts_col: str, *keep: str) -> DataFrame:
    """Long form of a count vector: (keep…, idx, tf)."""
    sparse = df.select(*keep, F.unwrap_udt(counts_col).alias("_s"))
    zipped = F.explode(F.arrays_zip("_s.indices", "_s.values")).alias("e")
    return sparse.select(*keep, zipped).select(
        *keep, F.col("e.indices").alias("idx"), F.col("e.values").alias("tf")
    )


def tfidf_long(df: DataFrame, entries_col: str, *keep: str) -> DataFrame:
    """Long form of TF-IDF entries: (keep…, idx, weight)."""
    return df.select(*keep, F.explode(entries_col).alias("e")).select(*keep, "e.idx", "e.weight")


def tfidf_by_join(df: DataFrame, id_col: str, text_col: str, vocabulary: DataFrame, settings: TermSettings,
                  weighting: str = PLAIN) -> DataFrame:
    """(id, term, weight) with a vocabulary table of any size.

    The relational form for uncapped vocabularies. Documents are dealt out by id into pieces of
    about PIECE_BYTES. A piece asks for its distinct n-grams by 64-bit keys, in hash segments where they meet
    the vocabulary, which answers with the idf of those it holds; terms are counted, weighed and normalised
    inside the piece, so no text of a term is shuffled. Pieces and segments grow in number with
    the data, not in size. Two terms of the vocabulary with one key raise an error.
    """
    if weighting not in (PLAIN, SUBLINEAR):
        raise ValueError(f"weighting must be '{PLAIN}' or '{SUBLINEAR}'")
    pieces = _pieces(df, text_col)
    bits = pieces.bit_length()  # a segment holds about as much as a piece
    stops, (lo, hi) = list(settings.stop_words), settings.ngrams
    piece = F.pmod(F.xxhash64(id_col), F.lit(pieces)).cast("int").alias("piece")
    docs = _words(df, text_col, id_col, piece)

    def ask(table: pa.Table) -> pa.Table:
        keys = arrow.distinct_keys(table["words"].combine_chunks(), stops, lo, hi)
        return requests(table["piece"][0].as_py(), keys, None)

    def requests(piece: int, keys: np.ndarray, idf: np.ndarray | None) -> pa.Table:
        runs = arrow.segments(keys, bits)
        return pa.table({
            "segment": pa.array([s for s, _, _ in runs], pa.int32()), "piece": pa.array([piece] * len(runs), pa.int32()),
            "keys": pa.array([arrow.packed(keys[a:b]) for _, a, b in runs], pa.binary()),
            "idf": pa.array([None if idf is None else idf[a:b].tobytes() for _, a, b in runs], pa.binary())})

    def offer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in (*batches, None):
            if batch is not None:
                keys, possible = arrow.term_keys(batch.column("term"), hi)
                held.append((keys[possible], batch.column("idf").to_numpy()[possible]))
                count += len(keys)
            if held and (batch is None or count >= OFFERED):
                keys, idf = (np.concatenate(c) for c in zip(*held))
                order = np.argsort(keys)
                yield from requests(-1, keys[order], idf[order]).to_batches()
                held, count = [], 0

    def meet(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        offers = [r for r in rows if r["piece"] < 0]
        known = np.concatenate([np.zeros(0, np.uint64), *(arrow.unpacked(r["keys"]) for r in offers)])
        order = np.argsort(known)
        idf, known = np.concatenate([np.zeros(0), *(np.frombuffer(r["idf"]) for r in offers)])[order], known[order]
        if (known[1:] == known[:-1]).any():
            raise ValueError("two terms of the vocabulary have the same key")
        asked = [r for r in rows if r["piece"] >= 0]
        found = [arrow.looked_up(arrow.unpacked(r["keys"]), known, idf) for r in asked]
        return pa.table({
            "piece": pa.array([r["piece"] for r in asked], pa.int32()), "segment": pa.array([r["segment"] for r in asked], pa.int32()),
            "size": pa.array([len(r["keys"]) // 8 for r in asked], pa.int32()),
            **{name: pa.array([f[i] for f in found], pa.binary()) for i, name in enumerate(("hit", "codes", "distinct"))}})

    def weigh(table: pa.Table, answers: pa.Table) -> pa.Table:
        texts, ids = table["words"].combine_chunks(), table[id_col].combine_chunks()
        parts = [arrow.answered(r["size"], r["hit"], r["codes"], r["distinct"]) for r in answers.sort_by("segment").to_pylist()]
        known = np.concatenate([np.zeros(0, bool), *(k for k, _ in parts)])
        idf = np.concatenate([np.zeros(0), *(v for _, v in parts)])
        grams = list(arrow.keyed_grams(texts, stops, lo, hi))  # a piece's; its keys are made once
        terms, term, doc, tf, at = arrow.known_terms(grams, arrow.keys_of(grams), known)
        weights = (np.log(tf) + 1 if weighting == SUBLINEAR else tf) * idf[at]
        owner = ids.dictionary_encode(null_encoding="encode").indices.to_numpy()[doc]
        norms = np.sqrt(np.bincount(owner, weights * weights))
        return pa.table({id_col: ids.take(pa.array(doc)), "term": terms.take(pa.array(term)), "weight": weights / norms[owner]})

    asked = docs.groupBy("piece").applyInArrow(ask, REQUEST_SCHEMA)
    offered = vocabulary.select("term", "idf").mapInArrow(offer, REQUEST_SCHEMA)
    answers = asked.unionByName(offered).groupBy("segment").applyInArrow(
        meet, "piece int, segment int, size int, hit binary, codes binary, distinct binary")
    schema = StructType([df.schema[id_col], StructField("term", StringType()), StructField("weight", DoubleType())])
    return docs.groupBy("piece").cogroup(answers.groupBy("piece")).applyInArrow(weigh, schema)


def first_columns(vocabulary: DataFrame, k: int, by: str = "alphabet") -> DataFrame:
    """The first k vocabulary entries, alphabetically or by falling frequency."""
    order = {"alphabet": [F.col("idx")], "frequency": [F.desc("tf"), F.col("term")]}[by]
    return vocabulary.orderBy(*order).limit(k)


def chi_square(entries: DataFrame, label: str, labels: DataFrame) -> DataFrame:
    """(idx, score): dependence of each non-negative feature on the class.

    ``entries`` is the long form (…, label, idx, tf); ``labels`` has one row per
    document with its ``label``. With O the class totals of a feature, T their
    sum and s the class shares, the score is sum(O^2 / (s*T)) - T, which equals
    the usual sum over all classes but needs only the classes that occur.
    """
    sizes = labels.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    shares = sizes.withColumn("_share", F.col("_n") / sizes.agg(F.sum("_n")).scalar())
    observed = entries.groupBy("idx", label).agg(F.sum("tf").alias("_o"))
    scored = observed.join(shares.select(label, "_share"), label)
    return scored.groupBy("idx").agg(
        F.sum("_o").alias("_t"), F.sum(F.col("_o") * F.col("_o") / F.col("_share")).alias("_q")
    ).select("idx", F.when(F.col("_t") > 0, F.col("_q") / F.col("_t") - F.col("_t")).alias("score"))


def best_features(scores: DataFrame, k: int) -> DataFrame:
    """The k highest scores; null scores rank last, ties go to the lower index."""
    return scores.orderBy(F.desc_nulls_last("score"), "idx").limit(k)


def token_ids(
    df: DataFrame, text_col: str, ids: Dictionary, length: int, special: tuple[int, int, int, int]
) -> DataFrame:
    """Add ``input_ids`` and ``attention_mask`` of fixed length.

    ``special`` holds the padding, unknown, start and end ids. Whole words are
    looked up; the sequence is start + words + end, padded or truncated.
    """
    pad, unknown, start, end = special
    words = analyzed_tokens(F.coalesce(F.col(text_col), F.lit("")), ())
    kept = F.slice(words, F.lit(1), F.lit(length - 2))
    looked_up = F.transform(kept, lambda w: F.coalesce(ids.get(w), F.lit(unknown)))
    staged = df.withColumn(
        "_ids", F.concat(F.array(F.lit(start)), looked_up, F.array(F.lit(end)))
    )
    missing = F.lit(length) - F.size("_ids")
    padded = F.concat("_ids", F.array_repeat(F.lit(pad), missing))
    mask = F.concat(F.array_repeat(F.lit(1), F.size("_ids")), F.array_repeat(F.lit(0), missing))
    return staged.withColumns({"input_ids": padded, "attention_mask": mask}).drop("_ids")


CONTINUES = "##"  # marks a piece that stands inside a word
MOST_CHARACTERS = 100  # of a word; longer ones are unknown


def basic_tokens(text: Column) -> Column:
    """Lower-case words, and every other character that is not white space by itself."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}\p{M}_]+|[^\s\p{L}\p{N}\p{M}_]"), F.lit(0))


def segment(word: Column, pieces: Dictionary, longest: int, unknown: int) -> Column:
    """The ids of a word's pieces: at each place the longest piece that fits, then on behind it.

    A word with a place where nothing fits is ``unknown`` as a whole. Only places where a piece
    begins are probed, from ``longest`` characters downwards, so a word costs its pieces times
    ``longest`` probes of the dictionary, inside the row.
    """
    empty = F.array().cast("array<int>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("ids"))
    size = F.length(word)

    def step(state: Column, place: Column) -> Column:
        mark = F.when(place > 0, F.lit(CONTINUES)).otherwise(F.lit(""))
        lengths = F.sequence(F.least(F.lit(longest), size - place), F.lit(1), F.lit(-1))

        def first(found: Column, n: Column) -> Column:
            hit = pieces.get(F.concat(mark, F.substring(word, place + 1, n)))
            return F.coalesce(found, F.when(hit.isNotNull(), F.struct((place + n).alias("at"), hit.alias("id"))))

        best = F.aggregate(lengths, F.lit(None).cast("struct<at:int,id:int>"), first)
        found = F.transform(F.array(best), lambda b: F.struct(F.coalesce(b["at"], F.lit(-1)).alias("at"), F.concat(state["ids"], F.array(b["id"])).alias("ids")))
        return F.when(state["at"] == place, F.get(found, F.lit(0))).otherwise(state)

    places = F.when((size > 0) & (size <= MOST_CHARACTERS), F.sequence(F.lit(0), size - 1)).otherwise(F.array(F.lit(-2)))
    done = F.aggregate(places, start, step, lambda s: F.when(s["at"] == size, s["ids"]).otherwise(F.array(F.lit(unknown))))
    return F.when(size == 0, empty).otherwise(done)


def word_piece_ids(
    df: DataFrame, text_col: str, pieces: Dictionary, longest: int, length: int, special: tuple[int, int, int, int]
) -> DataFrame:
    """Add ``input_ids`` and ``attention_mask`` of fixed length, of word pieces.

    ``pieces`` maps pieces to ids, those inside words marked by ``CONTINUES``; none has more than
    ``longest`` characters besides the mark. ``special`` holds the padding, unknown, start and end
    ids. The sequence is start + pieces + end, padded or truncated. Null texts have no pieces.
    """
    pad, unknown, start, end = special
    # a word has one piece at least, so no later word can matter
    words = F.slice(basic_tokens(F.col(text_col)), F.lit(1), F.lit(length - 2))
    found = F.flatten(F.transform(words, lambda w: segment(w, pieces, longest, unknown)))
    staged = fenced(df, _ids=F.concat(F.array(F.lit(start)), F.slice(found, F.lit(1), F.lit(length - 2)), F.array(F.lit(end))))
    missing = F.lit(length) - F.size("_ids")
    return staged.withColumns({
        "input_ids": F.concat("_ids", F.array_repeat(F.lit(pad), missing)),
        "attention_mask": F.concat(F.array_repeat(F.lit(1), F.size("_ids")), F.array_repeat(F.lit(0), missing)),
    }).drop("_ids")


def piece_table(words: DataFrame, longest: int = 20, endings: tuple[int, ...] = (2, 3)) -> DataFrame:
    """(idx, piece) from a column ``term`` of words: the words, their characters at the start and inside of
    words, and their last characters, as many as ``endings`` say."""
    short = words.select("term").where(F.length("term") <= longest)
    letters = short.select(F.explode(F.split("term", "")).alias("c")).where("c <> ''").distinct()
    parts = short.unionAll(letters).unionAll(letters.select(F.concat(F.lit(CONTINUES), "c")))
    for n in endings:
        parts = parts.unionAll(short.where(F.length("term") > n).select(F.concat(F.lit(CONTINUES), F.substring("term", -n, n))))
    pieces = parts.distinct().withColumnRenamed("term", "piece")
    return with_position(pieces, "piece", name="idx").select("idx", "piece")
