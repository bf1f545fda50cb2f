"""Online variational LDA in steps that can be checked, stopped and taken up again.

Each step takes one of a constant number of shares of the documents (Hoffman, Blei & Bach, 2010).
Workers infer the topic mixes of the share's documents and add up topics x terms of statistics, by
blocks of terms, on executors. The topics themselves, topics x terms, are bounded by the settings and the
capped vocabulary. Every few steps the bound on held-out documents is computed, and
the state is written to the shared folder.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from newslens.session import materialize

#: Document-term cells that a worker holds at once, rounds of inference at most and the mean change that ends them.
CELLS, ROUNDS, SETTLED = 1 << 21, 100, 1e-3
TERM_BLOCK = 1024


def digamma(x: np.ndarray) -> np.ndarray:
    """By recurrence up to 6, then the asymptotic series."""
    x, shift = np.array(x, float), 0.0
    for _ in range(6):
        small = x < 6
        if not small.any():
            break
        shift = shift - np.where(small, 1 / np.where(small, x, 1), 0)
        x = x + small
    y = 1 / (x * x)
    return shift + np.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))


def lgamma(x: np.ndarray) -> np.ndarray:
    return np.vectorize(math.lgamma, otypes=[float])(x)


def _expected_log(x: np.ndarray) -> np.ndarray:
    """E[log p] of rows of Dirichlet parameters."""
    return digamma(x) - digamma(x.sum(axis=1, keepdims=True))


def infer(at: np.ndarray, counts: np.ndarray, sizes: np.ndarray, beta: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(topic parameters of each document, its exp E[log], topic weights of each cell) of documents with ``sizes`` cells each.

    ``beta`` has exp E[log p(term | topic)], terms x topics. A document without terms keeps the prior.
    """
    k, n = beta.shape[1], len(sizes)
    gamma = np.full((n, k), prior)
    live = np.flatnonzero(sizes)
    gamma[live] = 1.0
    left, own, cells, moving = sizes[live], beta[at], counts, np.ones(len(live), bool)
    # a document stops at its own last change, whatever the others need; cells of those that stopped are let go together
    for _ in range(ROUNDS):
        if not len(live):
            break
        before = gamma[live]
        theta = np.exp(_expected_log(before))
        share = cells / ((np.repeat(theta, left, axis=0) * own).sum(axis=1) + 1e-100)
        new = prior + theta * np.add.reduceat(share[:, None] * own, np.cumsum(left) - left)
        gamma[live[moving]] = new[moving]
        moving &= np.abs(new - before).mean(axis=1) >= SETTLED
        if moving.sum() < 0.75 * len(live):
            kept = np.repeat(moving, left)
            live, left, own, cells, moving = live[moving], left[moving], own[kept], cells[kept], moving[moving]
    theta = np.exp(_expected_log(gamma))
    spread = np.repeat(theta, sizes, axis=0)
    return gamma, theta, (counts / ((spread * beta[at]).sum(axis=1) + 1e-100))[:, None] * spread


def _cells(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(terms, counts, cells of each document) of stretches of sparse rows (indices, values)."""
    sizes = batch.column("indices").value_lengths().fill_null(0).to_numpy().astype(np.int64)
    at, counts = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("indices", "values"))
    ends, low = np.cumsum(sizes), 0
    while low < len(sizes):
        done = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + CELLS // 32, "right")))
        yield at[done:ends[high - 1]].astype(np.int64), counts[done:ends[high - 1]].astype(float), sizes[low:high]
        low = high


@dataclass
class OnlineTopics:
    """Topics after ``step`` steps: ``weights`` (topics x terms), and the perplexities found on the way."""

    weights: np.ndarray
    step: int = 0
    doc_prior: float = 0.1
    topic_prior: float = 0.01
    history: list[tuple[int, float]] = field(default_factory=list)

    @property
    def beta(self) -> np.ndarray:
        return np.ascontiguousarray(np.exp(_expected_log(self.weights)).T)

    def topic_mix(self, df: DataFrame, counts_col: str, name: str = "topics") -> DataFrame:
        """Add the topic distribution; a document without terms gets a uniform one."""
        sent, prior = df.sparkSession.sparkContext.broadcast(self.beta), self.doc_prior

        @F.pandas_udf("array<double>")
        def mix(parts: pd.DataFrame) -> pd.Series:
            batch = pa.RecordBatch.from_arrays([pa.array(parts["indices"], pa.list_(pa.int32())), pa.array(parts["values"], pa.list_(pa.float64()))], names=["indices", "values"])
            gamma = np.concatenate([infer(*cells, sent.value, prior)[0] for cells in _cells(batch)])
            return pd.Series(list(gamma / gamma.sum(axis=1, keepdims=True)))

        return df.withColumn(name, array_to_vector(mix(F.unwrap_udt(counts_col))))

    def describe(self, spark: SparkSession, terms: list[str], top: int = 10) -> DataFrame:
        """(topic, rank, term, weight): the heaviest terms of each topic."""
        shares = self.weights / self.weights.sum(axis=1, keepdims=True)
        rows = [(t, r, terms[i], float(shares[t, i])) for t in range(len(shares)) for r, i in enumerate(np.argsort(-shares[t], kind="stable")[:top].tolist(), 1)]
        return spark.createDataFrame(rows, "topic int, rank int, term string, weight double")

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the state; an earlier one at the path stays until this is complete."""
        blocks = [(low, self.weights[:, low:low + TERM_BLOCK].tobytes()) for low in range(0, self.weights.shape[1], TERM_BLOCK)]
        rows = [(self.step, len(self.weights), self.doc_prior, self.topic_prior, str(self.history), low, block) for low, block in blocks]
        schema = "step int, topics int, doc_prior double, topic_prior double, history string, first int, block binary"
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{path}/step={self.step}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> OnlineTopics | None:
        """The newest complete state at the path, if there is one."""
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = where.getFileSystem(spark._jsc.hadoopConfiguration())
        done = [f.getPath() for f in files.listStatus(where)] if files.exists(where) else []
        done = {int(f.getName()[5:]): f for f in done if f.getName().startswith("step=") and files.exists(spark._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))}
        if not done:
            return None
        rows = spark.read.parquet(done[max(done)].toString()).orderBy("first").collect()
        blocks = [np.frombuffer(r["block"]).reshape(r["topics"], -1) for r in rows]
        history = [(int(a), float(b)) for a, b in (x.split(",") for x in rows[0]["history"].strip("[]()").split("), (") if x)]
        return cls(np.concatenate(blocks, axis=1), max(done), rows[0]["doc_prior"], rows[0]["topic_prior"], history)


def _statistics(rows: DataFrame, model: OnlineTopics) -> np.ndarray:
    """Topics x terms: how often each term of the rows stands for each topic, before the topics' own weights."""
    k, n = model.weights.shape
    sent, prior = rows.sparkSession.sparkContext.broadcast(model.beta), model.doc_prior

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, k))
        for batch in batches:
            for at, counts, sizes in _cells(batch):
                _, _, cells = infer(at, counts, sizes, sent.value, prior)
                order = np.argsort(at, kind="stable")
                found, start = np.unique(at[order], return_index=True)
                if len(found):
                    total[found] += np.add.reduceat(cells[order], start)
        for low in range(0, n, TERM_BLOCK):
            part = total[low:low + TERM_BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([low], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["first", "part"])

    def add(table: pa.Table) -> pa.Table:
        return pa.table({"first": table["first"].slice(0, 1), "part": pa.array([sum(np.frombuffer(x.as_py()) for x in table["part"]).tobytes()], pa.binary())})

    summed = rows.mapInArrow(partial, "first int, part binary").groupBy("first").applyInArrow(add, "first int, part binary").toArrow()
    total = np.zeros((n, k))
    for first, part in zip(summed["first"].to_pylist(), summed["part"]):
        total[first:first + TERM_BLOCK] = np.frombuffer(part.as_buffer()).reshape(-1, k)
    sent.unpersist()
    return total.T


def perplexity(rows: DataFrame, model: OnlineTopics) -> tuple[float, int]:
    """(perplexity, words) of documents by the variational bound per word."""
    sent, prior, k = rows.sparkSession.sparkContext.broadcast(model.beta), model.doc_prior, len(model.weights)

    def bound(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, words = 0.0, 0.0
        for batch in batches:
            for at, counts, sizes in _cells(batch):
                gamma, theta, _ = infer(at, counts, sizes, sent.value, prior)
                doc = np.repeat(np.arange(len(sizes)), sizes)
                score += float((counts * np.log((theta[doc] * sent.value[at]).sum(axis=1) + 1e-100)).sum())
                score += float(((prior - gamma) * _expected_log(gamma)).sum() + (lgamma(gamma) - math.lgamma(prior)).sum())
                score += float((math.lgamma(prior * k) - lgamma(gamma.sum(axis=1))).sum())
                words += float(counts.sum())
        yield pa.RecordBatch.from_arrays([pa.array([score]), pa.array([words])], names=["score", "words"])

    score, words = rows.mapInArrow(bound, "score double, words double").agg(F.coalesce(F.sum("score"), F.lit(0.0)), F.coalesce(F.sum("words"), F.lit(0.0))).first()
    weights, eta = model.weights, model.topic_prior
    score += float(((eta - weights) * _expected_log(weights)).sum() + (lgamma(weights) - math.lgamma(eta)).sum())
    score += float((math.lgamma(eta * weights.shape[1]) - lgamma(weights.sum(axis=1))).sum())
    sent.unpersist()
    return math.exp(-score / max(words, 1.0)), int(words)


def fit_online(
    df: DataFrame, counts_col: str, id_col: str, topics: int, *, held_out: str | None = None, shares: int = 21, epochs: int = 25,
    offset: float = 25.0, decay: float = 0.7, doc_prior: float = 0.1, topic_prior: float = 0.01,
    check_every: int = 5, least_gain: float = 0.1, state: str | None = None, seed: int = 42,
) -> OnlineTopics:
    """Fit topics on the sparse counts of ``df``, checking the perplexity every ``check_every`` steps.

    Documents whose boolean column ``held_out`` is true are kept for the checks; without that column the checks
    use all. The fit ends after ``epochs`` passes, or once a check gains less than ``least_gain``.
    With a folder ``state`` every check is stored there, and a later call goes on from the newest;
    a document's share is set by its id, so the steps are the same then. No documents are an error.
    """
    spark = df.sparkSession
    sparse = F.unwrap_udt(counts_col)
    held = F.coalesce(F.col(held_out), F.lit(False)) if held_out else F.lit(False)
    rows = df.select(sparse["indices"].alias("indices"), sparse["values"].alias("values"), sparse["size"].alias("size"), held.alias("held"),
                     F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(shares)).cast("int").alias("share"))
    # a step reads its share only
    rows = materialize(rows, "shares", by=("held", "share"))
    learning = rows.where(~F.col("held"))
    sizes = {r["share"]: r["n"] for r in learning.groupBy("share").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        raise ValueError("no documents to fit on")
    documents = sum(sizes.values())
    model = OnlineTopics.load(spark, state) if state else None
    if model is None:
        terms = learning.select("size").first()["size"]
        model = OnlineTopics(np.random.default_rng(seed).gamma(100.0, 0.01, (topics, terms)), 0, doc_prior, topic_prior)
    checked = (rows.where("held") if held_out else rows).select("indices", "values")
    while model.step < epochs * shares:
        share = model.step % shares
        model.step += 1
        if share in sizes:
            found = _statistics(learning.where(F.col("share") == share).select("indices", "values"), model) * model.beta.T
            rate = (offset + model.step) ** -decay
            model.weights = (1 - rate) * model.weights + rate * (topic_prior + documents / sizes[share] * found)
        if model.step % check_every == 0 or model.step == epochs * shares:
            last = model.history[-1][1] if model.history else math.inf
            model.history.append((model.step, perplexity(checked, model)[0]))
            if state:
                model.save(spark, state)
            if last - model.history[-1][1] < least_gain:
                break
    return model
