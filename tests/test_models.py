"""Invariants of features, topics and classifiers; persistence; evaluation arithmetic."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from newslens.operators import category_model, evaluate, features, models, sampling, topics
from newslens.operators.category_model import FeatureSteps, ModelParams, train
from newslens.operators.features import SvdProjection
from newslens.operators.models import NativeForest, OneVsRestForest, OneVsRestSvm
from newslens.operators.score import score
from newslens.operators.terms import TermSettings, Vocabulary
from newslens.plans.modelling import vectors
from newslens.sources.model_store import load_model, save_model


def array_of(df, column):
    return np.array([r[0] for r in df.select(vector_to_array(column)).collect()])


@pytest.fixture(scope="module")
def rows(spark, folder):
    return vectors(spark, folder).cache()


def test_scaler_uses_population_deviation_and_keeps_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (6.0, 5.0)], "a double, b double").select(F.array("a", "b").alias("x"))
    df = features.embedding_vectors(df, "x", "v")
    raw = array_of(df, "v")
    centred = array_of(features.fit_scaler(df, "v", "s", center=True).transform(df), "s")
    assert centred[:, 0] == pytest.approx((raw[:, 0] - raw[:, 0].mean()) / raw[:, 0].std())
    assert centred[:, 1] == pytest.approx([0, 0, 0])
    plain = array_of(features.fit_scaler(df, "v", "s").transform(df), "s")
    assert plain == pytest.approx(raw / np.array([raw[:, 0].std(), 1.0]))
    arrays = features.standardize_array(df, "x", 2).select("scaled").collect()
    assert np.array([r[0] for r in arrays]) == pytest.approx(centred)


def test_svd_matches_numpy(rows):
    matrix = array_of(rows, "features")
    fitted = SvdProjection.fit(rows, "features", 5, iterations=12)
    _, exact, right = np.linalg.svd(matrix, full_matrices=False)
    assert fitted.singular_values == pytest.approx(exact[:5], rel=1e-3)
    assert all(np.diff(fitted.singular_values) <= 0)
    assert abs(fitted.components.T @ fitted.components - np.eye(5)).max() < 1e-8
    full = SvdProjection.fit(rows, "features", 64)
    assert full.singular_values == pytest.approx(exact)
    assert array_of(full.transform(rows, "features"), "svd") @ full.components.T == pytest.approx(matrix)


def test_random_features_approximate_the_kernel(rows):
    few = rows.limit(20).cache()
    x = array_of(few, "features")
    z = array_of(features.random_fourier_features(few, "features", 4000, 0.01, 64), "rff")
    exact = np.exp(-0.01 * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert abs(z @ z.T - exact).max() < 0.12
    assert features.scale_gamma(few, "features") == pytest.approx(1 / (64 * x.var()))


def test_svd_of_sparse_rows_in_panels(spark, monkeypatch):
    """Mixed sparse, dense and empty rows; several panels, blocks of features and stretches of rows."""
    monkeypatch.setattr(features, "PANEL", 3)
    rng = np.random.default_rng(5)
    x = np.where(rng.random((60, 400)) < 0.05, rng.normal(size=(60, 400)), 0.0)
    x[7] = 0
    from pyspark.ml.linalg import SparseVector, Vectors

    rows = [(i, Vectors.dense(v) if i % 3 == 0 else SparseVector(400, np.flatnonzero(v).tolist(), v[v != 0].tolist())) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, ["id", "v"]).repartition(5)
    fitted = SvdProjection.fit(df, "v", 6, iterations=15)
    assert fitted.singular_values == pytest.approx(np.linalg.svd(x, compute_uv=False)[:6], rel=1e-3)
    got = {r["id"]: np.array(r["svd"]) for r in fitted.transform(df, "v").select("id", vector_to_array("svd").alias("svd")).collect()}
    assert np.stack([got[i] for i in range(60)]) == pytest.approx(x @ fitted.components)


def test_stretches_of_rows(monkeypatch):
    monkeypatch.setattr(features, "CELLS", 20)
    sizes = np.array([0, 3, 0, 9, 1, 1, 0])
    assert [(a, b) for a, b, *_ in features._pieces(sizes, 5)] == [(0, 3), (3, 4), (4, 7)]
    values, at = np.arange(14.0), np.arange(14) % 4
    right = np.arange(20.0).reshape(4, 5)
    want = np.zeros((7, 5))
    for k, row in enumerate(np.repeat(np.arange(7), sizes)):
        want[row] += values[k] * right[at[k]]
    assert features._times(at, values, sizes, right) == pytest.approx(want)


@pytest.mark.parametrize(("dims", "degree", "coef0"), [(64, 3, 1.0), (64, 2, 0.0), (650, 3, 1.0)])
def test_tensor_sketch_approximates_the_kernel(spark, dims, degree, coef0):
    x = np.random.default_rng(3).normal(size=(16, dims))
    df = features.embedding_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, a array<double>"), "a", "v").coalesce(1)
    z = array_of(features.tensor_sketch(df, "v", 8192, 1 / dims, coef0, degree, dims), "sketch")
    exact = (x @ x.T / dims + coef0) ** degree
    assert abs(z @ z.T - exact).max() < 0.1 * exact.max()


def test_poisson_draws(spark):
    df = spark.range(20_000)
    draws = np.array(df.select(*(models.poisson_draws(F.col("id"), t, 0.8, 42).alias(f"d{t}") for t in range(3))).collect())
    assert draws.mean(axis=0) == pytest.approx([0.8] * 3, abs=0.03) and draws.var(axis=0) == pytest.approx([0.8] * 3, abs=0.04)
    assert abs(np.corrcoef(draws.T) - np.eye(3)).max() < 0.03
    again = np.array(df.repartition(7).orderBy("id").select(models.poisson_draws(F.col("id"), 1, 0.8, 42)).collect())
    assert (again[:, 0] == draws[:, 1]).all()


def test_subsample_forest(rows):
    """A class of a fortieth of the rows is found, which needs weights within each draw."""
    x = vector_to_array("features")
    rare = rows.select("vec_id", "features", (x[0] > F.lit(1.9)).cast("int").alias("label")).cache()
    share = rare.agg(F.avg("label")).first()[0]
    assert 0.005 < share < 0.1
    fitted = models.SubsampleForest.fit(rare, "features", "label", models.forest(trees=4, max_depth=4), key="vec_id")
    assert fitted.classes == [0, 1] and [len(m) for m in fitted.models] == [4, 4]
    scored = fitted.transform(rare, "features").cache()
    decided(scored, 2)
    recall = scored.where("label = 1").agg(F.avg((F.col("pred") == 1).cast("int"))).first()[0]
    assert recall > 0.7
    plain = OneVsRestForest.fit(rare, "features", "label", models.forest(trees=4, max_depth=4), balanced=False).transform(rare, "features")
    assert plain.where("label = 1").agg(F.avg((F.col("pred") == 1).cast("int"))).first()[0] <= recall


def test_sigmoid_is_fitted_on_rows_left_out(spark):
    """Labels that have nothing to do with the columns: confidences must stay near the class share, though many columns fit the training rows."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(80, 60))
    df = spark.createDataFrame([(i, v.tolist(), int(i % 2)) for i, v in enumerate(x)], "id long, a array<double>, label int")
    df = features.embedding_vectors(df, "a", "features").coalesce(1)
    fitted = OneVsRestSvm.fit(df, "features", "label", kernel="linear", cost=100.0, max_iter=60)
    inside = fitted.transform(df, "features").agg(F.avg("confidence")).first()[0]
    assert inside < 0.75
    few = df.limit(2)
    assert OneVsRestSvm.fit(few, "features", "label", kernel="linear", max_iter=5).transform(few, "features").count() == 2


def decided(df, k):
    for r in df.collect():
        assert sum(r["probabilities"]) == pytest.approx(1.0) and len(r["probabilities"]) == k
        assert r["confidence"] == max(r["probabilities"]) == r["probabilities"][r["pred"]]


def test_forests(rows):
    x = vector_to_array("features")
    quadrant = ((x[0] > 0).cast("int") * 2 + (x[1] > 0).cast("int")).alias("label")
    split = sampling.stratified_split(rows.select("vec_id", "features", quadrant), "vec_id", "label").cache()
    train_rows, test_rows = split.where("split = 'train'"), split.where("split = 'test'")
    estimator = models.forest(trees=5, max_depth=4)
    one = OneVsRestForest.fit(train_rows, "features", "label", estimator).transform(test_rows, "features")
    native = NativeForest.fit(train_rows, "features", "label", estimator).transform(test_rows, "features")
    decided(one, 4)
    decided(native, 4)
    assert evaluate.headline_metrics(one, y="label").first()["accuracy"] > 0.4


@pytest.mark.parametrize("options", [{"kernel": "linear"}, {"kernel": "rbf", "size": 1024}, {"kernel": "poly", "coef0": 1.0, "size": 1024}])
def test_svm_learns_a_separable_class(rows, options):
    split = rows.withColumn("label", (vector_to_array("features")[0] > 0).cast("int"))
    fitted = OneVsRestSvm.fit(split, "features", "label", max_iter=30, **options)
    scored = fitted.transform(split, "features").cache()
    decided(scored, 2)
    assert evaluate.headline_metrics(scored, y="label").first()["accuracy"] > 0.8


def test_decision_ties_and_zero_scores(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([0.4, 0.4],), ([0.1, 0.3],)], "s array<double>")
    got = models.with_decision(df, F.col("s"), [0, 1]).collect()
    assert [r["pred"] for r in got] == [0, 0, 1]
    assert [r["confidence"] for r in got] == pytest.approx([0.5, 0.5, 0.75])


def test_unknown_kernel(rows):
    with pytest.raises(ValueError):
        OneVsRestSvm.fit(rows, "features", "label", kernel="cosine")


@pytest.fixture(scope="module")
def corpus(spark):
    words = {"sports": "match goal team player league", "food": "recipe sugar oven flour taste", "tech": "chip phone code cloud data"}
    rows = []
    for i in range(120):
        category, group = list(words.items())[i % 3]
        w = group.split()
        rows.append((i, " ".join(w[(i // 3 + j) % 5] for j in range(6)), category))
    return spark.createDataFrame([*rows, (500, None, "food")], "doc_id long, processed_text string, category string")


PARAMS = ModelParams(
    n_topics=3, n_estimators=5, svd_size=4, count_columns=10, best_features=9, min_samples=5, epochs=2, batch_size=50,
    max_depth=4, terms=TermSettings(min_df=2, max_features=100),
)


@pytest.mark.parametrize("strategy, fit_on, balanced", [("one-vs-rest", "train", True), ("native", "all", True), ("one-vs-rest", "train", "subsample")])
def test_training_scoring_and_persistence(spark, corpus, tmp_path, strategy, fit_on, balanced):
    model, results = train(corpus, ModelParams(**{**PARAMS.__dict__, "strategy": strategy, "fit_on": fit_on, "balanced": balanced}))
    assert results["predictions"].count() == 24
    assert results["metrics"].first()["accuracy"] == 1.0
    assert results["report"].where("row = 'food'").first()["support"] == 8
    assert results["class_distribution"].agg(F.sum("train"), F.sum("test")).first() == (96, 24)
    path = str(tmp_path / "model")
    save_model(model, path)
    again = load_model(spark, path)
    texts = corpus.na.drop()
    shaped = lambda m: {r["doc_id"]: (r["predicted"], round(r["confidence"], 9)) for r in m.predict(texts, "processed_text").collect()}
    assert shaped(model) == shaped(again)
    requests = spark.createDataFrame(
        [("Match goal team", "Player league match", "2020-01-01"), (None, "x", None), ("!!!", "??", None), ("a", " ", None)],
        "headline string, short_description string, date string",
    )
    answers = score(requests, again, today="2024-01-01").collect()
    assert [r["success"] for r in answers] == [True, False, False, False]
    assert answers[0]["category"]["predicted"] == "sports" and answers[0]["processed_data"]["date"] == "2020-01-01"
    assert answers[1]["error"].endswith("must be strings") and answers[3]["error"].endswith("cannot be empty")
    assert answers[2]["error"].startswith("Text processing failed") and answers[2]["category"] is None


def test_missing_stage_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="vocabulary"):
        load_model(spark, str(tmp_path))


def test_topics(spark, corpus):
    from newslens.operators.terms import Vocabulary

    texts = corpus.na.drop()
    fitted = Vocabulary.fit(texts, "processed_text", PARAMS.terms)
    counted = fitted.count(texts.unionByName(spark.createDataFrame([(900, "zzz", "food")], texts.schema)), "processed_text")
    model = topics.fit_topics(counted, "counts", 3, batch_size=50, epochs=3)
    mixes = array_of(topics.topic_mix(model, counted, "counts"), "topics")
    assert mixes.sum(axis=1) == pytest.approx(np.ones(len(mixes)))
    assert mixes[-1] == pytest.approx([1 / 3] * 3)
    terms = topics.topic_terms(model, fitted.table(spark), 4).collect()
    assert len(terms) == 12 and {r["rank"] for r in terms} == {1, 2, 3, 4}


def test_report_arithmetic(spark):
    pairs = [(0, 0)] * 5 + [(0, 1)] * 3 + [(1, 1)] * 2 + [(2, 0)]
    df = spark.createDataFrame([(i, y, p) for i, (y, p) in enumerate(pairs)], "doc_id long, y int, pred int")
    report = {r["row"]: r for r in evaluate.classification_report(df).collect()}
    assert report["0"]["precision"] == pytest.approx(5 / 6) and report["0"]["recall"] == pytest.approx(5 / 8)
    assert (report["2"]["precision"], report["2"]["f1"], report["2"]["support"]) == (0.0, 0.0, 1)
    assert report["accuracy"]["f1"] == pytest.approx(7 / 11)
    assert report["macro avg"]["recall"] == pytest.approx((5 / 8 + 1 + 0) / 3)
    assert report["weighted avg"]["recall"] == pytest.approx(7 / 11)
    matrix = {(r["y"], r["pred"]): r["n"] for r in evaluate.confusion_matrix(df, [0, 1, 2, 3]).collect()}
    assert len(matrix) == 16 and matrix[(0, 1)] == 3 and matrix[(3, 3)] == 0
    batches = evaluate.batch_mean_accuracy(df, "doc_id", batch=4).first()
    assert batches["mean_batch_accuracy"] == pytest.approx((1 + 0.25 + 2 / 3) / 3) and batches["batches"] == 3


@pytest.mark.parametrize(("variant", "strategy"), [("basic", "native"), ("tuned", "svm"), ("basic", "svm")])
def test_variants_train_save_load_and_log(spark, folder, tmp_path, variant, strategy):
    from newslens.plans.modelling import SMALL, processed
    from newslens.sources.runs import first_metric, read_runs
    from dataclasses import replace

    params = replace(SMALL, features=variant, strategy=strategy, kernel="rbf", gamma="auto", kernel_size=32, n_topics=3,
                     terms=TermSettings(max_features=200))
    rows = processed(spark, folder)
    model, results = train(rows, params, log=(str(tmp_path / "runs"), "variants", variant))
    assert results["predictions"].count() == round(0.2 * rows.count()) or results["predictions"].count() > 30
    save_model(model, str(tmp_path / "model"))
    loaded = load_model(spark, str(tmp_path / "model"))
    texts = rows.limit(30).select("doc_id", "processed_text")
    pick = lambda m: sorted(map(str, m.predict(texts, "processed_text").select("doc_id", "pred", F.round("confidence", 9)).collect()))
    assert pick(model) == pick(loaded)
    logged = read_runs(spark, str(tmp_path / "runs"))
    keys = {r["key"] for r in logged.where("kind = 'metric'").collect()}
    assert {"accuracy", "training_seconds", "confidence_mean", "confidence_lowest", "confidence_highest"} <= keys
    assert float(first_metric(logged, "variants", "training_seconds").first()[0]) > 0


def test_runs_share_the_steps_they_have_in_common(spark, corpus, tmp_path):
    from newslens.operators.category_model import Prefix, sweep
    from newslens.sources.runs import read_runs

    prefix = Prefix()
    settings = [{"criterion": "gini"}, {"criterion": "entropy"}, {"n_topics": 2}, {"strategy": "native", "n_topics": 2, "min_samples": 6}, {"svd_size": 3}]
    rows = sweep(corpus, PARAMS, settings, prefix=prefix, log=(str(tmp_path / "runs"), "sweep")).orderBy("run").collect()
    assert [r["params"] for r in rows] == [", ".join(f"{k}={v}" for k, v in s.items()) for s in settings]
    assert all(r["accuracy"] > 0.9 for r in rows)
    assert prefix.fitted == {"names": 1, "split": 1, "vocabulary": 1, "vectors": 1, "svd": 2, "topics": 2, "steps": 3, "features": 3, "balanced": 4}
    alone = train(corpus, ModelParams(**{**PARAMS.__dict__, "n_topics": 2}))[1]["metrics"].first()
    assert alone["accuracy"] == pytest.approx(rows[2]["accuracy"])
    assert {r["run_id"] for r in read_runs(spark, str(tmp_path / "runs")).collect()} == {f"run-{i}" for i in range(5)}


def test_scoring_counts_and_projects_in_one_worker(spark):
    """A task of the scoring stage keeps a Python worker for every node of Python functions."""
    texts = spark.createDataFrame([(i, f"cat dog bird{i % 3} fish{i % 5}" if i % 7 else "") for i in range(60)], "doc_id int, processed_text string")
    fitted = Vocabulary.fit(texts, "processed_text", TermSettings(max_features=30, min_df=1))
    weighted = fitted.count(texts, "processed_text", "_counts", False, ("_tfidf", "sublinear"))
    svd = SvdProjection.fit(weighted, "_tfidf", 3)
    apart = svd.transform(weighted, "_tfidf", "_svd").select("doc_id", "_counts", "_svd")
    once = fitted.count(texts, "processed_text", "_counts", False, ("_svd", "sublinear"), svd.projection(spark)).select("doc_id", "_counts", "_svd")
    assert sorted(map(tuple, apart.collect())) == sorted(map(tuple, once.collect()))
    lda = topics.fit_topics(weighted, "_counts", 2, epochs=1)
    steps = FeatureSteps(fitted, svd, lda, 5, [0, 1, 2], None)
    steps.scaler = features.fit_scaler(category_model._selected(steps, category_model._non_negative(steps, weighted)), "_stacked", "_features", center=True)
    plan = steps.transform(texts, "processed_text")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
