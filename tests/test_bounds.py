"""The bound in Arrow batches against Spark's, documents that settle by themselves, steps that read their share."""

import numpy as np
import pytest
from pyspark.ml.linalg import SparseVector

from newslens.operators import online_topics as online, topics


@pytest.fixture(scope="module")
def counted(spark):
    rng, rows = np.random.default_rng(3), []
    for i in range(120):
        at, counts = np.unique(np.concatenate([rng.integers(10 * (i % 3), 10 * (i % 3) + 10, 25), rng.integers(30, 40, 5)]), return_counts=True)
        rows.append((i, SparseVector(40, at.tolist(), counts.astype(float).tolist())))
    return spark.createDataFrame([*rows, (120, SparseVector(40, [], []))], ["id", "counts"]).repartition(3).localCheckpoint()


def test_bound_is_that_of_spark(counted):
    model = topics.fit_topics(counted, "counts", 3, epochs=2)
    got = topics.perplexity(model, counted).first()
    assert got["log_perplexity"] == pytest.approx(model.logPerplexity(counted), rel=2e-3)


def test_a_document_is_inferred_alike_in_any_company():
    rng = np.random.default_rng(4)
    beta = rng.dirichlet(np.ones(50) * 0.1, 4).T.copy()
    sizes = np.array([3, 0, 40, 1, 17, 0])
    at, counts = rng.integers(0, 50, sizes.sum()), rng.integers(1, 9, sizes.sum()).astype(float)
    together, _, cells = online.infer(at, counts, sizes, beta, 0.1)
    ends = np.cumsum(sizes)
    for i, (end, n) in enumerate(zip(ends, sizes)):
        alone, _, own = online.infer(at[end - n:end], counts[end - n:end], sizes[i:i + 1], beta, 0.1)
        assert together[i] == pytest.approx(alone[0]) and cells[end - n:end] == pytest.approx(own)


def test_a_step_reads_its_share(counted, monkeypatch):
    filters = []
    found = online._statistics

    def seen(rows, model):
        filters.append(rows._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0])
        return found(rows, model)

    monkeypatch.setattr(online, "_statistics", seen)
    online.fit_online(counted, "counts", "id", 3, shares=4, epochs=1)
    assert len(filters) == 4 and all("share" in f for f in filters)


def test_the_gram_product_needs_arrays_of_one_number_a_cell(spark):
    """A piece of CELLS cells is multiplied a column at a time: no array has cells x columns numbers."""
    import tracemalloc
    from newslens.operators import features
    rng = np.random.default_rng(2)
    sizes = np.tile([0, 400, 1, 99], 400)
    at = np.concatenate([np.sort(rng.choice(600, n, replace=False)) for n in sizes])
    values, right = rng.random(len(at)), rng.normal(size=(600, 64))
    dense = np.zeros((len(sizes), 600))
    dense[np.repeat(np.arange(len(sizes)), sizes), at] = values
    tracemalloc.start()
    got = features._times(at, values, sizes, right)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(got, dense @ right) and peak < 10 * 8 * len(at)
    rows = spark.createDataFrame([(at[e - n:e].tolist(), values[e - n:e].tolist()) for n, e in zip(sizes, np.cumsum(sizes))], "indices array<int>, values array<double>")
    assert np.allclose(features._gram_product(rows, right), dense.T @ (dense @ right))
