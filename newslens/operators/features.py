"""Dense and sparse feature steps: projection, scaling, stacking, selection."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler, VectorSizeHint, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F

from newslens.session import materialize


#: Columns of the block that one pass multiplies: its broadcast and sums are features x PANEL.
PANEL = 128
#: Cells of the arrays that a worker holds at once while it multiplies.
CELLS = 1 << 20
#: Features whose partial sums travel as one row.
FEATURE_BLOCK = 256


class SvdProjection:
    """Uncentred truncated SVD by randomised subspace iteration (Halko et al., 2011).

    Each iteration multiplies the rows' Gram matrix with a thin block of vectors, in panels
    of columns, so the number of passes is fixed by the settings, not by the data. Tasks
    add up partial products by feature; those of a feature meet on an executor. What reaches the
    driver in one piece is features x PANEL. ``components`` are features x k: bounded by the capped
    vocabulary and the settings. Column signs are arbitrary.
    """

    def __init__(self, components: np.ndarray, singular_values: np.ndarray):
        self.components = components
        self.singular_values = singular_values

    @classmethod
    def fit(
        cls, df: DataFrame, vector_col: str, k: int, iterations: int = 4, oversample: int = 10,
        seed: int = 42, stored: bool = False,
    ) -> SvdProjection:
        """Fit on the vectors of ``df``; they are written first unless already ``stored``."""
        rows = df.select(F.unwrap_udt(vector_col).alias("s")).select("s.indices", "s.values", "s.size")
        if not stored:
            rows = materialize(rows, "svd")
        first = rows.select(F.coalesce("size", F.size("values")).alias("n")).first()
        if first is None:
            raise ValueError("no rows to fit on")
        n = first["n"]
        block = np.random.default_rng(seed).normal(size=(n, min(n, k + oversample)))
        for _ in range(iterations):
            block = _gram_product(rows, np.linalg.qr(block)[0])
        basis = np.linalg.qr(block)[0]
        values, vectors = np.linalg.eigh(basis.T @ _gram_product(rows, basis))
        order = np.argsort(values)[::-1][:k]
        return cls(basis @ vectors[:, order], np.sqrt(np.maximum(values[order], 0.0)))

    def projection(self, spark: SparkSession) -> Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
        """A function of sparse rows, given as feature numbers, cells and row sizes: the projected rows; for use inside tasks."""
        shared = spark.sparkContext.broadcast(self.components)
        return lambda at, values, sizes: _times(at, values, sizes, shared.value)

    def transform(self, df: DataFrame, vector_col: str, name: str = "svd") -> DataFrame:
        projected = self.projection(df.sparkSession)
        n = len(self.components)

        @F.pandas_udf("array<double>")
        def project(parts: pd.DataFrame) -> pd.Series:
            sizes = parts["values"].map(len).to_numpy()
            values = np.concatenate([np.zeros(0), *parts["values"]])
            dense = np.arange(n)
            at = np.concatenate([np.zeros(0, np.int64), *(dense if kind == 1 else i for kind, i in zip(parts["type"], parts["indices"]))]).astype(np.int64)
            return pd.Series(list(projected(at, values, sizes)))

        return df.withColumn(name, array_to_vector(project(F.unwrap_udt(vector_col))))


def _pieces(sizes: np.ndarray, width: int = 1) -> Iterator[tuple[int, int, int, int]]:
    """(first row, end, first cell, end) of stretches of rows with at most CELLS products, or one row."""
    ends = np.cumsum(sizes)
    low = 0
    while low < len(sizes):
        done = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + CELLS // max(width, 1), "right")))
        yield low, high, done, int(ends[high - 1])
        low = high


def _times(at: np.ndarray, values: np.ndarray, sizes: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sparse rows, given as feature numbers, cells and row sizes, times ``right``, a column at a time."""
    out, columns = np.zeros((len(sizes), right.shape[1])), np.ascontiguousarray(right.T)
    for low, high, a, b in _pieces(sizes):
        own, cells, of = at[a:b], values[a:b], sizes[low:high]
        full = np.flatnonzero(of)
        if len(full):
            starts = (np.cumsum(of) - of)[full]
            for j, column in enumerate(columns):
                out[low + full, j] = np.add.reduceat(cells * column[own], starts)
    return out


def _gram_product(rows: DataFrame, block: np.ndarray) -> np.ndarray:
    """(A^T A) block for the rows of A, panel by panel."""
    return np.concatenate([_panel_product(rows, np.ascontiguousarray(block[:, low:low + PANEL])) for low in range(0, block.shape[1], PANEL)], axis=1)


def _panel_product(rows: DataFrame, panel: np.ndarray) -> np.ndarray:
    n, width = panel.shape
    shared = rows.sparkSession.sparkContext.broadcast(panel)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, total = np.ascontiguousarray(shared.value.T), np.zeros((width, n))
        for batch in batches:
            values, sizes, at = _sparse(batch, n)
            for low, high, a, b in _pieces(sizes):
                own, cells, of = at[a:b], values[a:b], sizes[low:high][sizes[low:high] > 0]
                row, starts = np.repeat(np.arange(len(of)), of), np.cumsum(of) - of
                # a column at a time: arrays of one number a cell, and sums that need no sorting
                for j in range(width if len(of) else 0):
                    products = np.add.reduceat(cells * columns[j][own], starts)
                    total[j] += np.bincount(own, cells * products[row], minlength=n)
        total = np.ascontiguousarray(total.T)
        for low in range(0, n, FEATURE_BLOCK):
            part = total[low:low + FEATURE_BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([low], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["first", "part"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py()) for x in table["part"])
        return pa.table({"first": table["first"].slice(0, 1), "part": pa.array([total.tobytes()], pa.binary())})

    summed = rows.mapInArrow(partial, "first int, part binary").groupBy("first").applyInArrow(add, "first int, part binary").toArrow()
    product = np.zeros_like(panel)
    for first, part in zip(summed["first"].to_pylist(), summed["part"]):
        product[first:first + FEATURE_BLOCK] = np.frombuffer(part.as_buffer()).reshape(-1, width)
    shared.unpersist()
    return product


def _sparse(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cells, row sizes, feature numbers) of sparse and dense rows."""
    cells, bounds = _list_parts(batch.column("values"))
    sizes = np.diff(bounds)
    dense = batch.column("indices").is_null().to_numpy(zero_copy_only=False)
    columns, _ = _list_parts(batch.column("indices"))
    if not dense.any():
        return cells[bounds[0]:bounds[-1]], sizes, columns[batch.column("indices").offsets[0].as_py():][:bounds[-1] - bounds[0]]
    at = np.empty(int(sizes.sum()), np.int64)
    from_dense = np.repeat(dense, sizes)
    at[from_dense] = np.tile(np.arange(n), int(dense.sum()))
    at[~from_dense] = columns[:int((~from_dense).sum())]
    return cells[bounds[0]:bounds[-1]], sizes, at


def _list_parts(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The flat values of a list column and the offsets of its rows."""
    return column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()


def fit_scaler(df: DataFrame, input_col: str, output_col: str, center: bool = False) -> PipelineModel:
    """Standardise by the population deviation; constant columns keep scale 1.

    Without centring the result stays sparse, which is what term vectors need.
    """
    stats = df.select(
        Summarizer.metrics("variance", "count").summary(F.col(input_col)).alias("s")
    ).select("s.variance", "s.count").first()
    variance, n = stats["variance"].toArray(), stats["count"]
    shrink = (n - 1) / n if n > 1 else 1.0
    if center:
        scaler = StandardScaler(inputCol=input_col, outputCol="_scaled", withMean=True, withStd=True)
        correction = ElementwiseProduct(
            scalingVec=Vectors.dense([1 / math.sqrt(shrink)] * len(variance)),
            inputCol="_scaled", outputCol=output_col,
        )
        return PipelineModel([scaler.fit(df), correction])
    deviation = np.sqrt(variance * shrink)
    scale = np.where(deviation > 0, 1 / np.where(deviation > 0, deviation, 1.0), 1.0)
    return PipelineModel([
        ElementwiseProduct(scalingVec=Vectors.dense(scale), inputCol=input_col, outputCol=output_col)
    ])


def standardize_array(df: DataFrame, array_col: str, size: int, name: str = "scaled") -> DataFrame:
    """Standardise an array column of known size with one aggregation row, no explode."""
    stats = df.agg(
        F.array(*[F.avg(F.col(array_col)[i].cast("double")) for i in range(size)]).alias("mean"),
        F.array(*[F.stddev_pop(F.col(array_col)[i].cast("double")) for i in range(size)]).alias("std"),
    ).first()
    mean = F.array(*[F.lit(m) for m in stats["mean"]])
    scale = F.array(*[F.lit(s if s > 0 else 1.0) for s in stats["std"]])
    centred = F.zip_with(array_col, mean, lambda x, m: x.cast("double") - m)
    return df.withColumn(name, F.zip_with(centred, scale, lambda x, s: x / s))


def stack(df: DataFrame, parts: Mapping[str, int], name: str = "features") -> DataFrame:
    """Concatenate vector columns (name -> size) in the given order.

    The sizes are declared, so nothing has to peek at a first row; the same
    code serves batch and streaming frames.
    """
    for part, size in parts.items():
        df = VectorSizeHint(inputCol=part, size=size, handleInvalid="optimistic").transform(df)
    return VectorAssembler(inputCols=list(parts), outputCol=name).transform(df)


def take_columns(df: DataFrame, vector_col: str, indices: list[int], name: str) -> DataFrame:
    return VectorSlicer(inputCol=vector_col, outputCol=name, indices=indices).transform(df)


def vector_entries(df: DataFrame, vector_col: str, *keep: str) -> DataFrame:
    """Long form (keep…, idx, tf) of a sparse or dense vector column."""
    parts = df.select(*keep, F.unwrap_udt(vector_col).alias("_s"))
    dense_index = F.sequence(F.lit(0), F.size("_s.values") - 1)
    shaped = parts.select(
        *keep, F.coalesce("_s.indices", dense_index).alias("idx"), F.col("_s.values").alias("tf")
    )
    zipped = shaped.select(*keep, F.explode(F.arrays_zip("idx", "tf")).alias("e"))
    return zipped.select(*keep, "e.idx", "e.tf")


def embedding_vectors(df: DataFrame, array_col: str, name: str = "features") -> DataFrame:
    """An array<float> column as an ML vector."""
    return df.withColumn(name, array_to_vector(F.col(array_col).cast("array<double>")))


def random_fourier_features(
    df: DataFrame, vector_col: str, size: int, gamma: float, dims: int, seed: int = 42, name: str = "rff"
) -> DataFrame:
    """Random features whose inner products approximate the RBF kernel (Rahimi & Recht, 2007)."""
    generator = np.random.default_rng(seed)
    frequencies = generator.normal(scale=math.sqrt(2 * gamma), size=(dims, size))
    phases = generator.uniform(0, 2 * math.pi, size=size)
    shared = df.sparkSession.sparkContext.broadcast((frequencies, phases))

    @F.pandas_udf("array<double>")
    def lift(rows: pd.Series) -> pd.Series:
        w, b = shared.value
        lifted = math.sqrt(2 / len(b)) * np.cos(np.stack(rows.to_list()) @ w + b)
        return pd.Series(list(lifted))

    return df.withColumn(name, array_to_vector(lift(vector_to_array(vector_col))))


def tensor_sketch(
    df: DataFrame, vector_col: str, size: int, gamma: float, coef0: float, degree: int, dims: int, seed: int = 42, name: str = "sketch"
) -> DataFrame:
    """Features whose inner products approximate (gamma x'y + coef0)^degree (Pham & Pagh, 2013).

    Every column takes part, at any number of them: each factor of the power is a count sketch
    of the row, and the sketch of the product is their circular convolution. The error falls with
    the root of ``size``.
    """
    generator = np.random.default_rng(seed)
    buckets = generator.integers(0, size, (degree, dims + 1))
    signs = generator.choice([-1.0, 1.0], (degree, dims + 1))
    shared = df.sparkSession.sparkContext.broadcast((buckets, signs))

    @F.pandas_udf("array<double>")
    def lift(rows: pd.Series) -> pd.Series:
        x = np.stack(rows.to_list()) * math.sqrt(gamma)
        x = np.concatenate([x, np.full((len(x), 1), math.sqrt(coef0))], axis=1)
        product = 1.0
        for bucket, sign in zip(*shared.value):
            order = np.argsort(bucket, kind="stable")
            found, start = np.unique(bucket[order], return_index=True)
            sketch = np.zeros((len(x), size))
            sketch[:, found] = np.add.reduceat((x * sign)[:, order], start, axis=1)
            product = product * np.fft.rfft(sketch)
        return pd.Series(list(np.fft.irfft(product, size)))

    return df.withColumn(name, array_to_vector(lift(vector_to_array(vector_col))))


def scale_gamma(df: DataFrame, vector_col: str) -> float:
    """The 'scale' kernel width: 1 / (features x variance over all cells)."""
    arrays = df.select(vector_to_array(vector_col).alias("a"))
    plus = lambda acc, v: acc + v
    row = arrays.agg(
        F.first(F.size("a")).alias("d"), F.count(F.lit(1)).alias("n"),
        F.sum(F.aggregate("a", F.lit(0.0), plus)).alias("s"),
        F.sum(F.aggregate("a", F.lit(0.0), lambda acc, v: acc + v * v)).alias("q"),
    ).first()
    cells = row["d"] * row["n"]
    variance = row["q"] / cells - (row["s"] / cells) ** 2
    return 1.0 / (row["d"] * variance) if variance > 0 else 1.0
