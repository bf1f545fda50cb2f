"""Online topics against the formulas worked out document by document, checks, stops and resumption."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector

from newslens.operators import online_topics as online


def test_digamma():
    assert online.digamma(np.array([1.0, 0.5, 0.01, 7.3, 200.0])) == pytest.approx(
        [-0.5772156649, -1.9635100260, -100.5608854578, 1.9178203356, 5.2958152832], abs=1e-6)


def planted(spark, n=150, seed=2):
    """Documents of three groups of ten terms each, two empty ones, and terms that all share."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        terms = np.concatenate([rng.integers(10 * (i % 3), 10 * (i % 3) + 10, 30), rng.integers(30, 33, 5)])
        at, counts = np.unique(terms, return_counts=True)
        rows.append((i, SparseVector(33, at.tolist(), counts.astype(float).tolist()), i % 10 == 7))
    rows += [(n, SparseVector(33, [], []), False), (n + 7, SparseVector(33, [], []), True)]
    return spark.createDataFrame(rows, ["id", "counts", "held"]).repartition(4), rows


def dense(vector):
    return np.array(vector.toArray())


def test_statistics_are_those_of_each_document(spark):
    df, rows = planted(spark, 30)
    model = online.OnlineTopics(np.random.default_rng(1).gamma(100.0, 0.01, (3, 33)))
    sparse = df.selectExpr("id", "counts").select(online.F.unwrap_udt("counts").alias("s")).select("s.indices", "s.values")
    beta, want = model.beta, np.zeros((3, 33))
    for _, v, _ in rows:
        x = dense(v)
        theta = np.ones(3)
        gamma = np.ones(3)
        for _ in range(400):
            theta = np.exp(online.digamma(gamma) - online.digamma(gamma.sum(keepdims=True)))
            gamma = 0.1 + theta * ((x / (beta @ theta + 1e-100)) @ beta)
        want += np.outer(theta, x / (beta @ theta + 1e-100))
    assert online._statistics(sparse, model) == pytest.approx(want, rel=0.02, abs=0.05)


def test_planted_topics_are_found_and_checks_stop_the_fit(spark):
    df, rows = planted(spark)
    model = online.fit_online(df, "counts", "id", 3, held_out="held", shares=5, epochs=20, offset=5.0, least_gain=0.5)
    steps = [s for s, _ in model.history]
    assert steps == list(range(5, 5 * len(steps) + 1, 5)) and model.step < 100
    assert model.history[-1][1] < 25  # ten terms a group and three shared; drawn at random all 33 would be as likely
    groups = {tuple(sorted({r["term"] // 10 for r in model.describe(spark, list(map(str, range(33))), 8).withColumn("term", online.F.col("term").cast("int")).where(f"topic = {t}").collect()} - {3})) for t in range(3)}
    assert groups == {(0,), (1,), (2,)}
    mixes = {r["id"]: np.array(r["m"]) for r in model.topic_mix(df, "counts").select("id", vector_to_array("topics").alias("m")).collect()}
    assert all(m.sum() == pytest.approx(1) for m in mixes.values()) and mixes[150] == pytest.approx([1 / 3] * 3)
    best = [{int(mixes[i].argmax()) for i in range(g, 150, 3)} for g in range(3)]
    assert sorted(map(len, best)) == [1, 1, 1] and len(set.union(*best)) == 3


def test_a_stopped_fit_goes_on_as_if_it_had_not(spark, tmp_path):
    df, _ = planted(spark, 60)
    fit = lambda epochs, state=None: online.fit_online(df, "counts", "id", 3, held_out="held", shares=4, epochs=epochs, least_gain=-math.inf, state=state)
    path = str(tmp_path / "state")
    half = fit(2, path)
    assert online.OnlineTopics.load(spark, path).weights == pytest.approx(half.weights)
    resumed, whole = fit(4, path), fit(4)
    assert resumed.step == whole.step == 16 and resumed.weights == pytest.approx(whole.weights)
    assert [s for s, _ in resumed.history] == [5, 8, 10, 15, 16] and [s for s, _ in whole.history] == [5, 10, 15, 16]
    (tmp_path / "state" / "step=99").mkdir()
    assert online.OnlineTopics.load(spark, path).step == 16
    with pytest.raises(ValueError):
        online.fit_online(df.where("id < 0"), "counts", "id", 3)
