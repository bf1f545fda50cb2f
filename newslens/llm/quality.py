"""Ordinal text quality: one score from hashed features, ordered thresholds for the grades.

P(grade <= k) = sigmoid(threshold_k - score). The score is a weighted sum of hashed words and
of hashed bands of the text's shape (capitals, signs, repetition); all grades share its
weights, and the thresholds rise. The fit runs on a bounded sample of the rated documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from newslens.llm.text import buffers, fresh, mix, word_hashes

#: Hashed features, most rated documents (expected) in a fit, epochs, documents per step, step size, shrinkage.
BITS, MOST_RATED, EPOCHS, BATCH, RATE, SHRINK = 18, 12000, 12, 128, 2.0, 2e-6
#: A feature of fewer rated documents gets no weight.
LEAST_DOCUMENTS = 12
GRADES = 3
#: Least chance of the highest grade with which a document is selected.
SELECT = 0.75
#: Texts whose features are made at once.
STEP = 512

_SHAPES = np.zeros((4, 256), bool)
_SHAPES[0, 65:91] = True
_SHAPES[1, 97:123] = True
_SHAPES[2, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_SHAPES[3, 48:58] = True
#: Weight of one shape feature beside the words, whose squares sum to 1.
SHAPE_WEIGHT = 0.5


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature numbers, values, offsets of each text's features). Empty texts have shape features only."""
    data, offsets = buffers(texts)
    words, at = word_hashes(texts)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    codes = (owner.astype(np.uint64) << np.uint64(BITS)) | (words >> np.uint64(64 - BITS))
    keys, counts = np.unique(codes, return_counts=True)
    doc, number = (keys >> np.uint64(BITS)).astype(np.int64), (keys & np.uint64((1 << BITS) - 1)).astype(np.int64)
    n_words = np.diff(at)
    values = np.sqrt(counts / np.maximum(n_words, 1)[doc])
    size = np.maximum(np.diff(offsets), 1)
    shares = [_sums(shape[data], offsets) / size for shape in _SHAPES]
    shares += [np.bincount(doc, minlength=len(n_words)) / np.maximum(n_words, 1), _sums(data == 124, offsets) / np.maximum(n_words, 1)]
    bands = np.stack([np.minimum((np.sqrt(s) * 12).astype(np.int64), 15) for s in shares]
                     + [np.minimum(np.log2(n_words + 1).astype(np.int64), 15)], axis=1)
    # distinct words fall with length: read repetition by length band
    bands[:, 4] += 16 * bands[:, 6]
    shape = mix((bands + 1000 * np.arange(1, bands.shape[1] + 1)).astype(np.uint64)) >> np.uint64(64 - BITS)
    doc = np.concatenate([doc, np.repeat(np.arange(len(n_words)), bands.shape[1])])
    number = np.concatenate([number, shape.reshape(-1).astype(np.int64)])
    values = np.concatenate([values, np.full(shape.size, SHAPE_WEIGHT)])
    order = np.argsort(doc, kind="stable")
    return number[order], values[order], np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(n_words)))])


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. grades - 1 (rows x grades - 1)."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -500, 500)))

    def score(self, number: np.ndarray, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return np.add.reduceat(np.append(self.weights[number] * values, 0.0), offsets[:-1])


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int = GRADES, seed: int = 5) -> OrdinalModel:
    """Adagrad on the cumulative-link likelihood of (features, grade) rows."""
    weights, seen = np.zeros(1 << BITS), np.full(1 << BITS, 1e-6)
    share = np.clip(np.cumsum(np.bincount(grades, minlength=n_grades))[:-1] / len(grades), 0.01, 0.99)
    first = np.log(share / (1 - share))
    # thresholds are the first one and positive steps
    free = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 0.05))])
    free_seen = np.full(len(free), 1e-6)
    sizes = np.array([len(r[0]) for r in rows])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    numbers, values = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
    values = np.where(np.bincount(numbers, minlength=len(weights))[numbers] >= LEAST_DOCUMENTS, values, 0.0)
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for low in range(0, len(order), BATCH):
            pick = order[low : low + BATCH]
            own = sizes[pick]
            at = np.cumsum(own) - own
            place = np.repeat(starts[pick] - at, own) + np.arange(own.sum())
            number, value = numbers[place], values[place]
            score = np.add.reduceat(weights[number] * value, at)
            theta = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
            edge = np.concatenate([[-np.inf], theta, [np.inf]])
            upper = 1 / (1 + np.exp(-np.clip(edge[grades[pick] + 1] - score, -60, 60)))
            lower = 1 / (1 + np.exp(-np.clip(edge[grades[pick]] - score, -60, 60)))
            chance = np.maximum(upper - lower, 1e-9)
            slope = 1 - upper - lower
            gradient = np.bincount(number, np.repeat(slope, own) * value, len(weights)) if len(number) > len(weights) else None
            if gradient is None:
                used, where = np.unique(number, return_inverse=True)
                part = np.bincount(where, np.repeat(slope, own) * value) / len(pick)
            else:
                used, part = np.arange(len(weights)), gradient / len(pick)
            part += SHRINK * weights[used]
            seen[used] += part**2
            weights[used] -= RATE * part / np.sqrt(seen[used])
            by_edge = np.zeros(n_grades + 1)
            np.add.at(by_edge, grades[pick] + 1, -upper * (1 - upper) / chance)
            np.add.at(by_edge, grades[pick], lower * (1 - lower) / chance)
            by_theta = by_edge[1:-1] / len(pick)
            after = np.cumsum(by_theta[::-1])[::-1]
            step = after * np.concatenate([[1.0], np.exp(free[1:])])
            free_seen += step**2
            free -= 0.1 * step / np.sqrt(free_seen)
    return OrdinalModel(weights, np.cumsum(np.concatenate([free[:1], np.exp(free[1:])])))


def grade(quality, toxic):
    """0 poor, 1 well formed but toxic, 2 good; null without a quality rating. A null toxic rating counts as 0."""
    return F.when(quality == 0, 0).when((quality == 1) & (F.coalesce(toxic, F.lit(0)) == 1), 1).when(quality == 1, 2)


def _over(docs: DataFrame, text_col: str, out: list[StructField], make) -> DataFrame:
    names = [f.name for f in out]
    kept = [c for c in docs.columns if c not in names]
    source = docs.select(*kept, F.col(text_col).cast("binary").alias(fresh("_text", kept)))

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, STEP):
                part = batch.slice(low, STEP)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *make(part.column(len(kept)))], names=[*kept, *names])

    return source.mapInArrow(run, StructType([*docs.select(*kept).schema.fields, *out]))


def train(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_RATED) -> OrdinalModel | None:
    """Fit on the rated documents, or on an even sample of about ``most`` of them if there are more.

    ``ratings`` has the id and ``grade`` (0 .. GRADES - 1); null grades and ids are left out, and of
    several ratings of one document the lowest counts. None if nothing is rated.
    """
    rated = ratings.where(F.col("grade").isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min("grade").alias("grade"))
    n = rated.count()
    if not n:
        return None
    part = F.pmod(F.xxhash64(F.col(id_col), F.lit(11)), F.lit(1 << 30)) < int(min(1.0, most / n) * (1 << 30))
    chosen = F.broadcast(rated.where(part))  # about MOST_RATED rows
    joined = docs.select(id_col, text_col).join(chosen, id_col).select(F.col(id_col).alias("_id"), "grade", F.col(text_col).cast("binary").alias("_text"))

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, STEP):
                piece = batch.slice(low, STEP)
                number, values, at = features(piece.column(2))
                offsets = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    piece.column(0), piece.column(1), pa.ListArray.from_arrays(offsets, pa.array(number, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(values.astype(np.float32), pa.float32()))], names=["_id", "grade", "number", "value"])

    id_type = dict(joined.dtypes)["_id"]
    rows = joined.mapInArrow(run, f"_id {id_type}, grade int, number array<int>, value array<float>").toArrow().combine_chunks()
    if not rows.num_rows:
        return None
    rows = rows.sort_by("_id")  # the same fit whatever order tasks end in
    data = [(a.values.to_numpy(), b.values.to_numpy().astype(np.float64)) for a, b in zip(rows["number"], rows["value"])]
    return fit(data, rows["grade"].to_numpy().astype(np.int64))


def grade_documents(docs: DataFrame, model: OrdinalModel | None, text_col: str = "text") -> DataFrame:
    """Add ``expected_grade`` and ``tail`` (chance of the highest grade); such columns are replaced.

    Every row is scored from its whole text, by itself. Null and empty texts are scored by
    their shape. Without a model both columns are null.
    """
    out = [StructField("expected_grade", DoubleType()), StructField("tail", DoubleType())]
    if model is None:
        return docs.withColumns({f.name: F.lit(None).cast("double") for f in out})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(texts: pa.Array) -> list[pa.Array]:
        tails = shared.value.tails(shared.value.score(*features(texts)))
        return [pa.array(tails.sum(axis=1)), pa.array(tails[:, -1])]

    return _over(docs, text_col, out, make)
