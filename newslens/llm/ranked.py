"""Ranked lexical search: the best documents for each item of a small collection.

Documents are indexed in blocks: of a block the postings (document, times) of all terms that any
item holds, and the documents' lengths. Statistics are summed over all blocks. A block is then
searched for every item. Its short posting lists are taken term by term and summed into one list of
accumulators. That list, with its largest sum as bound, joins the long posting lists in a search
document by document: only documents of lists that can reach the k-th best score so far are opened,
and the other lists are entered by skipping to those documents, the weightiest first, as long as
a document can still reach that score. The threshold is carried on from block to block of a task;
documents that equal it stay, as ties go to the smaller id. The tasks' best are ranked together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from newslens.llm.text import buffers, word_hashes
from newslens.session import materialize

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BEST = 50
#: Bytes of text and number of documents to a block at most (one document at least).
BLOCK_BYTES, BLOCK_DOCS = 1 << 24, 1 << 14
#: A list is short if it holds at most this part of a block's documents.
SHORT = 16
#: Documents that are searched before the threshold is set anew.
STRIDE = 2048
#: Pairs of item and term that a pass over the documents searches for; more items take more passes.
MOST_PAIRS = 1 << 20

_GAP = np.zeros(256, bool)
_GAP[:0x80] = True
_GAP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False
_NO_ID = np.iinfo(np.int64).max


def gains(weight: int, times: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """What a term adds to documents that hold it so many times."""
    return weight * ((1_000_000_000 * times) // (1000 * times + 20 * norm))


def norms(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 50 + (50 * lengths * n_docs) // n_terms


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def search_block(lists: list[tuple[int, int, int]], slots: np.ndarray, times: np.ndarray, norm: np.ndarray, least: int, best: int) -> tuple[np.ndarray, np.ndarray]:
    """(slots, scores) that hold all documents of a block which are among its ``best`` and reach ``least``.

    ``lists`` has (weight, start, end) of a term's postings in ``slots`` and ``times``, by ascending slot.
    """
    size = len(norm)
    sums, iterators = np.zeros(size, np.int64), []
    for w, low, high in lists:
        if (high - low) * SHORT <= size:
            at = slots[low:high]
            sums[at] += gains(w, times[low:high], norm[at])
        else:
            # more of a term in a shorter text adds more
            iterators.append((int(gains(w, times[low:high].max(), norm[slots[low:high]].min())), w, low, high))
    iterators.append((int(sums.max(initial=0)), 0, 0, 0))  # the accumulators
    iterators.sort()
    reach = np.cumsum([x[0] for x in iterators])
    found, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for start in range(0, size, STRIDE):
        stop = min(start + STRIDE, size)
        opened = int(np.searchsorted(reach, least))  # the lists before cannot reach the threshold together
        if opened == len(iterators):
            break
        total = np.zeros(stop - start, np.int64)
        for _, w, low, high in iterators[opened:]:
            if w:
                a, b = low + np.searchsorted(slots[low:high], [start, stop])
                at = slots[a:b]
                total[at - start] += gains(w, times[a:b], norm[at])
            else:
                total += sums[start:stop]
        at = np.flatnonzero(total)
        total = total[at]
        at = at + start
        for i in range(opened - 1, -1, -1):
            able = total + reach[i] >= least
            at, total = at[able], total[able]
            if not len(at):
                break
            _, w, low, high = iterators[i]
            if w:
                place = np.minimum(low + np.searchsorted(slots[low:high], at), high - 1)
                hit = slots[place] == at
                total[hit] += gains(w, times[place[hit]], norm[at[hit]])
            else:
                total = total + sums[at]
        able = total >= least
        if able.any():
            found.append(at[able])
            scores.append(total[able])
            if sum(map(len, scores)) >= best:
                found, scores = [np.concatenate(found)], [np.concatenate(scores)]
                least = max(least, int(np.partition(scores[0], -best)[-best]))
                able = scores[0] >= least
                found, scores = [found[0][able]], [scores[0][able]]
    return np.concatenate(found), np.concatenate(scores)


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    _, offsets = buffers(batch.column(1))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, min(low + BLOCK_DOCS, int(np.searchsorted(offsets, offsets[low] + BLOCK_BYTES, "right")) - 1))
        yield batch.slice(low, high - low)
        low = high


_INDEX = "n_docs bigint, n_terms bigint, ids array<bigint>, lengths array<bigint>, terms array<int>, sizes array<int>, slots array<int>, times array<int>"
_NAMES = [c.split()[0] for c in _INDEX.split(", ")]


def index_block(block: pa.RecordBatch, terms: np.ndarray) -> pa.RecordBatch:
    """One row: totals, the documents that hold any of ``terms`` (sorted hashes) by ascending id, and each term's postings."""
    hashes, at = word_hashes(block.column(1), _GAP)
    lengths = np.diff(at)
    place = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1) if len(terms) else np.zeros(len(hashes), np.int64)
    held = np.flatnonzero(terms[place] == hashes) if len(terms) else np.zeros(0, np.int64)
    doc = np.searchsorted(at, held, "right") - 1
    order = pc.sort_indices(block.column(0), null_placement="at_end").to_numpy()
    order = order[np.isin(order, doc)]
    slot = np.full(block.num_rows, -1)
    slot[order] = np.arange(len(order))
    pairs, times = np.unique(place[held] * max(1, len(order)) + slot[doc], return_counts=True)
    term, slots = pairs // max(1, len(order)), pairs % max(1, len(order))
    present, sizes = np.unique(term, return_counts=True)
    ids = block.column(0).cast(pa.int64()).fill_null(_NO_ID).to_numpy()[order]
    row = {"n_docs": int((lengths > 0).sum()), "n_terms": int(lengths.sum()), "ids": ids, "lengths": lengths[order], "terms": present, "sizes": sizes, "slots": slots, "times": times}
    kinds = [pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 2, *[pa.list_(pa.int32())] * 4]
    return pa.RecordBatch.from_arrays([pa.array([row[n]], k) for n, k in zip(_NAMES, kinds)], names=_NAMES)


def _item_terms(items: DataFrame) -> DataFrame:
    """(item_id, key) of every term of every item, once."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                keys, at = word_hashes(batch.column(1), _GAP)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), np.diff(at)))), pa.array(keys.view(np.int64))], names=["item_id", "key"])

    return items.mapInArrow(run, f"item_id {dict(items.dtypes)['item_id']}, key bigint").distinct()


def _search(source: DataFrame, pairs: pa.Table, best: int) -> DataFrame:
    """(item, doc_id, score) with the best of every task; ``item`` numbers the distinct item ids of ``pairs``."""
    spark = source.sparkSession
    keys = pairs["key"].to_numpy().view(np.uint64)
    terms, term = np.unique(keys, return_inverse=True)
    sent = spark.sparkContext.broadcast(terms)

    def index(batches):
        for batch in batches:
            for block in _blocks(batch):
                yield index_block(block, sent.value)

    stored = materialize(source.mapInArrow(index, _INDEX), "postings")
    n_docs, n_terms = stored.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    counted = stored.select(F.explode(F.arrays_zip("terms", "sizes")).alias("x")).groupBy("x.terms").agg(F.sum("x.sizes").alias("df")).toArrow()
    weights = np.zeros(len(terms), np.int64)
    weights[counted["terms"].to_numpy()] = [weight(n_docs, df) for df in counted["df"].to_pylist()]
    number = pairs["item"].to_numpy()
    order = np.argsort(number, kind="stable")
    bounds = np.append(np.flatnonzero(np.diff(number[order], prepend=-1)), len(order))
    wanted = spark.sparkContext.broadcast([(int(number[order[a]]), np.sort(term[order[a:b]])) for a, b in zip(bounds[:-1], bounds[1:])])
    sent_weights = spark.sparkContext.broadcast(weights)

    def search(batches):
        top: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                ids, lengths, present, sizes, slots, times = (batch.column(i)[row].values.to_numpy().astype(np.int64) for i in range(2, 8))
                ends, norm = np.cumsum(sizes), norms(lengths, n_docs, n_terms)
                for item, own in wanted.value:
                    if not len(present):
                        break
                    place = np.minimum(np.searchsorted(present, own), len(present) - 1)
                    ws = sent_weights.value[own]
                    here = (present[place] == own) & (ws > 0)
                    place, ws = place[here], ws[here]
                    if not len(ws):
                        continue
                    lists = list(zip(ws.tolist(), (ends[place] - sizes[place]).tolist(), ends[place].tolist()))
                    had = top.get(item, (np.zeros(0, np.int64),) * 2)
                    least = int(had[1][-1]) if len(had[1]) >= best else 1
                    at, scores = search_block(lists, slots, times, norm, least, best)
                    if len(at):
                        docs, scores = np.concatenate([had[0], ids[at]]), np.concatenate([had[1], scores])
                        first = np.lexsort((docs, -scores))[:best]
                        top[item] = docs[first], scores[first]
        for item, (docs, scores) in top.items():
            yield pa.RecordBatch.from_arrays([pa.array([item] * len(docs), pa.int32()), pa.array(docs, mask=docs == _NO_ID), pa.array(scores)], names=["item", "doc_id", "score"])

    return stored.mapInArrow(search, "item int, doc_id bigint, score bigint")


def best_documents(docs: DataFrame, items: DataFrame, best: int = BEST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): for every item its ``best`` documents with a score above 0, ties by ascending id.

    Ids of documents are integers; a null id comes last among ties, and 2**63 - 1 is not one. Rows that
    share an id are documents of their own. Rows of ``items`` that share an id are one item with the
    terms of all. Null and empty texts have no terms: such documents count for nothing, such items
    get no rows, and neither do items of which no document holds a term, or of an empty table.
    Texts of any length are read whole. Other columns are left out. Terms are told apart by 64-bit hashes.
    """
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    terms = materialize(_item_terms(items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("binary").alias("text"))), "items")
    passes = max(1, -(-terms.count() // MOST_PAIRS))
    part = F.pmod(F.xxhash64("item_id"), F.lit(passes))
    ranked = []
    for p in range(passes):
        pairs = terms.where(part == p).toArrow()  # about MOST_PAIRS rows
        ids = pairs["item_id"].combine_chunks().dictionary_encode("encode")
        pairs = pa.table({"item": pa.array(ids.indices), "key": pairs["key"]})
        named = docs.sparkSession.createDataFrame(pa.table({"_item": pa.array(range(len(ids.dictionary)), pa.int32()), "item_id": ids.dictionary}), f"_item int, item_id {dict(terms.dtypes)['item_id']}")
        by = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        top = _search(source, pairs, best).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= best)
        ranked.append(top.join(named, top["item"] == named["_item"]).select("item_id", "rank", "doc_id", "score"))
    out = ranked[0]
    for more in ranked[1:]:
        out = out.unionAll(more)
    return out
