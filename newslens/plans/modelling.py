"""Projection, topics, classifiers, sweeps and parameter listings."""

import math
from dataclasses import asdict, replace

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window, functions as F

from newslens.operators import annotate as annotate_ops
from newslens.operators import evaluate, features, models, online_topics, sampling, topics
from newslens.operators.category_model import ModelParams, Prefix, sweep, train
from newslens.operators.features import SvdProjection
from newslens.operators.models import NativeForest, OneVsRestForest, OneVsRestSvm, SubsampleForest
from newslens.operators.terms import SUBLINEAR, TUNED, Vocabulary, store_parted
from newslens.plans.articles import text_articles
from newslens.plans.registry import query
from newslens.plans.terms import term_ctes, texts, weight_ctes
from newslens.session import materialize, scratch_path
from newslens.sources.files import read_table

# The held-out fifth of each class, by the order of the ids' md5.
HELD_OUT_SQL = """(SELECT * FROM (SELECT {id}, {y} AS y, row_number() OVER (PARTITION BY {y} ORDER BY md5(CAST({id} AS VARCHAR) || '|42'), {id}) AS r,
  count(*) OVER (PARTITION BY {y}) AS n FROM {table} WHERE {y} IS NOT NULL) WHERE r <= round(0.2 * n))"""
VECTORS_OUT = HELD_OUT_SQL.format(id="vec_id", y="label", table="embeddings")
REPORT_SQL = f"""SELECT CAST(y AS VARCHAR) AS row, count(*) AS support, TRUE AS ok FROM {VECTORS_OUT} GROUP BY y
UNION ALL SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), (SELECT count(*) FROM {VECTORS_OUT}), TRUE"""
DOCS_OUT = HELD_OUT_SQL.format(id="doc_id", y="lang", table="documents")
SVM_SQL = f"SELECT vec_id, y AS label, TRUE AS ok FROM {VECTORS_OUT}"


def share(*columns):
    """Whether all columns lie between 0 and 1."""
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.coalesce(F.col(c).between(0, 1), F.lit(False))
    return ok


# Small settings: the queries check behaviour, the defaults are for real runs.
SMALL = ModelParams(
    n_topics=4, n_estimators=5, svd_size=8, count_columns=100, best_features=80, min_samples=20,
    max_ratio=3, epochs=1, max_depth=5, learning_offset=25.0,
)
_trained: dict[tuple[str, str], tuple] = {}


def processed(spark, folder):
    """Annotated documents with their language as the category."""
    rows = text_articles(spark, folder, "doc_id", "headline", "short_description", "lang")
    done = annotate_ops.annotate(rows, purpose="topic")
    return done.select("doc_id", "processed_text", F.col("lang").alias("category"))


def trained(spark, folder):
    """(model, result tables) of the small training run, once per session and folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _trained:
        _trained[key] = train(materialize(processed(spark, folder), "processed"), SMALL)
    return _trained[key]


def vectors(spark, folder):
    """Embedding vectors with the label, standardised."""
    rows = features.embedding_vectors(
        read_table(spark, folder, "embeddings").select("vec_id", "embedding", "label"), "embedding", "raw"
    )
    scaled = features.fit_scaler(rows, "raw", "features", center=True).transform(rows)
    return scaled.select("vec_id", "label", "features")


def _split(spark, folder):
    rows = sampling.stratified_split(vectors(spark, folder), "vec_id", "label")
    stored = materialize(rows, "vectors")
    return stored.where("split = 'train'"), stored.where("split = 'test'")


@query("m5_svd_full_rank", """
SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))), 4) AS length FROM embeddings""")
def svd_full_rank(spark, folder):
    """Projecting on all components keeps every row's length."""
    rows = features.embedding_vectors(read_table(spark, folder, "embeddings").select("vec_id", "embedding"), "embedding", "v")
    projected = SvdProjection.fit(rows, "v", 64).transform(rows, "v")
    square = F.aggregate(vector_to_array("svd"), F.lit(0.0), lambda acc, x: acc + x * x)
    return projected.select("vec_id", F.round(F.sqrt(square), 4).alias("length"))


# The largest singular value by power iteration over the weights.
POWER_SQL = "WITH RECURSIVE " + ", ".join([*term_ctes(TUNED), *weight_ctes("(1 + ln(c.tf))")]).replace("normed AS (", "normed AS MATERIALIZED (") + """,
power AS (
  SELECT 0 AS step, idx, CAST(1 AS DOUBLE) AS x, CAST(0 AS DOUBLE) AS length FROM (SELECT DISTINCT idx FROM normed)
  UNION ALL
  SELECT step, idx, x / sqrt(sum(x * x) OVER ()), sqrt(sum(x * x) OVER ()) FROM (
    SELECT any_value(step) + 1 AS step, n.idx, sum(n.weight * y) AS x FROM normed n JOIN (
      SELECT m.doc_id, any_value(p.step) AS step, sum(m.weight * p.x) AS y FROM normed m JOIN power p ON p.idx = m.idx GROUP BY m.doc_id) USING (doc_id)
    GROUP BY n.idx) WHERE step <= 60)
SELECT CAST(component AS INTEGER) AS component, TRUE AS falls, TRUE AS within_norm,
  (SELECT round(sqrt(max(length)), 2) FROM power WHERE step = 60) AS largest FROM (SELECT unnest(range(20)) AS component)"""


@query("m5_svd_of_tfidf", POWER_SQL)
def svd_of_tfidf(spark, folder):
    """The largest singular value of the TF-IDF matrix; the leading ones fall, and their squares stay within its squared norm."""
    rows = store_parted(texts(spark, folder).select("doc_id", "text"), "text")
    fitted = Vocabulary.fit(rows, "text", TUNED, parted=True)
    weighted = fitted.tfidf(fitted.count(rows, "text", parted=True), "counts", "v", SUBLINEAR)
    values = SvdProjection.fit(weighted, "v", 20).singular_values
    # rows have length 1 or 0, so the squared norm is at most their number
    norm, squares = rows.count(), np.cumsum(np.square(values))
    facts = [(i, bool(i == 0 or values[i] <= values[i - 1] + 1e-9), bool(0 < squares[i] <= norm + 1e-6), round(float(values[0]), 2)) for i in range(len(values))]
    return spark.createDataFrame(facts, "component int, falls boolean, within_norm boolean, largest double")


def _topics(spark, folder):
    rows = store_parted(texts(spark, folder).select("doc_id", "text"), "text")
    fitted = Vocabulary.fit(rows, "text", TUNED, parted=True)
    counted = materialize(fitted.count(rows, "text", parted=True).select("doc_id", "counts"), "counts")
    return counted, topics.fit_topics(counted, "counts", 5, epochs=1), fitted


@query("m6_topics", """SELECT doc_id, CAST(topic AS INTEGER) AS topic, TRUE AS ok
FROM documents CROSS JOIN (SELECT unnest(range(5)) AS topic)""")
def topics_of_documents(spark, folder):
    """Five topic shares per document, each between 0 and 1."""
    return topic_distributions(spark, folder).select("doc_id", F.col("topic").cast("int").alias("topic"), share("weight").alias("ok"))


def topic_distributions(spark, folder):
    counted, model, _ = _topics(spark, folder)
    mixed = topics.topic_mix(model, counted, "counts")
    return features.vector_entries(mixed, "topics", "doc_id").select(
        "doc_id", F.col("idx").alias("topic"), F.col("tf").alias("weight")
    )


@query("m6_topic_mass", "SELECT doc_id, CAST(1 AS DOUBLE) AS mass FROM documents")
def topic_mass(spark, folder):
    """Every document's topic shares sum to one."""
    mixed = topic_distributions(spark, folder)
    return mixed.groupBy("doc_id").agg(F.round(F.sum("weight"), 6).alias("mass"))


@query("m7_perplexity", "SELECT TRUE AS follows_bound, (SELECT count(*) FROM documents) AS documents")
def perplexity(spark, folder):
    """The perplexity is the exponential of the bound."""
    counted, model, _ = _topics(spark, folder)
    follows = (F.abs(F.log("perplexity") - F.col("log_perplexity")) < 1e-6) & (F.col("perplexity") > 1)
    return topics.perplexity(model, counted).select(follows.alias("follows_bound"), F.lit(counted.count()).alias("documents"))


@query("m7_checked_fit", "WITH " + ", ".join(term_ctes(TUNED)) + """
SELECT CAST(unnest([5, 10, 15]) AS INTEGER) AS step, (SELECT CAST(sum(c.tf) AS BIGINT) FROM counted c JOIN vocab v USING (term) WHERE doc_id % 10 = 7) AS words,
  TRUE AS gains, TRUE AS follows""")
def checked_fit(spark, folder):
    """A fit that is checked every five steps on a tenth of the documents, stopped after ten and taken up again: each check's
    perplexity, whether it gains on topics drawn at random, and whether it is that of a fit without a stop."""
    rows = store_parted(texts(spark, folder).select("doc_id", "text"), "text")
    fitted = Vocabulary.fit(rows, "text", TUNED, parted=True)
    counted = materialize(fitted.count(rows, "text", parted=True).select("doc_id", "counts", (F.col("doc_id") % 10 == 7).alias("held")), "counts")
    state = scratch_path(spark, "topics")

    def fit(epochs, at=None):
        return online_topics.fit_online(counted, "counts", "doc_id", 5, held_out="held", shares=5, epochs=epochs, least_gain=-math.inf, state=at)

    fit(2, state)
    resumed, whole = fit(3, state), fit(3)
    held = counted.where("held").select(F.unwrap_udt("counts").alias("s")).select("s.indices", "s.values")
    drawn = online_topics.OnlineTopics(np.random.default_rng(42).gamma(100.0, 0.01, resumed.weights.shape))
    before, words = online_topics.perplexity(held, drawn)
    facts = [(s, words, bool(p < before), bool(abs(p - q) <= 1e-6 * q)) for (s, p), (_, q) in zip(resumed.history, whole.history)]
    return spark.createDataFrame(facts, "step int, words bigint, gains boolean, follows boolean")


@query("k3_topic_terms", "WITH " + ", ".join(term_ctes(TUNED)) + """
SELECT CAST(topic AS INTEGER) AS topic, CAST(rank AS INTEGER) AS rank, TRUE AS falls, (SELECT count(*) FROM vocab) AS known
FROM (SELECT unnest(range(5)) AS topic) CROSS JOIN (SELECT unnest(range(1, 11)) AS rank)""")
def topic_terms(spark, folder):
    """Ten terms of the vocabulary per topic, by falling weight, their weights shares of the topic."""
    _, model, fitted = _topics(spark, folder)
    by_rank = Window.partitionBy("topic").orderBy("rank")
    falls = (F.col("weight") <= F.coalesce(F.lag("weight").over(by_rank), F.col("weight"))) & F.col("weight").between(0, 1)
    return topics.topic_terms(model, fitted.table(spark)).select(
        "topic", "rank", falls.alias("falls"), F.lit(len(fitted)).cast("bigint").alias("known"))


def _facts(report, floor=0.0):
    """Rows and supports of a report, and whether its scores are shares, and those of the averages above the floor."""
    average = F.col("row").isin("accuracy", "macro avg", "weighted avg")
    return report.select("row", "support", (share("precision", "recall", "f1") & (~average | (F.col("f1") > floor))).alias("ok"))


#: Held-out scores that a fit must beat: languages are told apart by their words, and a constant answer has a macro F1 below 0.2.
LANGUAGE_FLOOR = 0.6


@query("m8_feature_stack", """
SELECT vec_id, dim, round(v, 6) AS v FROM (SELECT vec_id, unnest(range(2 * len(embedding))) AS dim,
  CAST(unnest(embedding || list_reverse(embedding)) AS DOUBLE) AS v FROM embeddings) WHERE v <> 0""")
def feature_stack(spark, folder):
    """Two vectors side by side, in the given order."""
    rows = read_table(spark, folder, "embeddings").withColumn("back", F.reverse("embedding"))
    both = features.embedding_vectors(features.embedding_vectors(rows, "embedding", "a"), "back", "b")
    stacked = features.stack(both, {"a": 64, "b": 64})
    return features.vector_entries(stacked, "features", "vec_id").where("tf <> 0").select(
        "vec_id", F.col("idx").alias("dim"), F.round("tf", 6).alias("v")
    )


@query("m8_model_features", "WITH " + ", ".join([*term_ctes(TUNED), *weight_ctes("(1 + ln(c.tf))")]) + """
SELECT doc_id, idx, round(weight, 6) AS v FROM normed UNION ALL SELECT doc_id, -1, CAST(1 AS DOUBLE) FROM documents""")
def model_features(spark, folder):
    """The parts of a model's features in one vector: SVD columns, topics, TF-IDF. The last are those of the SQL, the topics sum to one."""
    rows = store_parted(texts(spark, folder).select("doc_id", "text"), "text")
    fitted = Vocabulary.fit(rows, "text", TUNED, parted=True)
    weighted = materialize(fitted.tfidf(fitted.count(rows, "text", parted=True), "counts", "tfidf", SUBLINEAR).select("doc_id", "counts", "tfidf"), "weighted")
    svd = SvdProjection.fit(weighted, "tfidf", 4, iterations=2, stored=True)
    mixed = topics.topic_mix(topics.fit_topics(weighted, "counts", 3, epochs=1), svd.transform(weighted, "tfidf"), "counts")
    stacked = features.stack(mixed, {"svd": 4, "topics": 3, "tfidf": len(fitted)})
    cells = materialize(features.vector_entries(stacked, "features", "doc_id"), "cells")
    terms = cells.where("idx >= 7 AND tf <> 0").select("doc_id", (F.col("idx") - 7).alias("idx"), F.round("tf", 6).alias("v"))
    mass = cells.where("idx BETWEEN 4 AND 6").groupBy("doc_id").agg(F.round(F.sum("tf"), 6).alias("v"))
    return terms.unionByName(mass.withColumn("idx", F.lit(-1)))


@query("m18_forest", REPORT_SQL)
def forest(spark, folder):
    """Balanced one-vs-rest forests on the embeddings, evaluated on the held-out part."""
    train_rows, test_rows = _split(spark, folder)
    fitted = OneVsRestForest.fit(train_rows, "features", "label", models.forest(trees=5, max_depth=4))
    return _facts(evaluate.classification_report(fitted.transform(test_rows, "features"), y="label"))


@query("m18_native_forest", REPORT_SQL)
def native_forest(spark, folder):
    """One multi-class forest with balanced row weights."""
    train_rows, test_rows = _split(spark, folder)
    weighted = sampling.with_class_weight(train_rows, "label")
    fitted = NativeForest.fit(weighted, "features", "label", models.forest(trees=20, criterion="entropy", max_depth=8), "weight")
    return _facts(evaluate.classification_report(fitted.transform(test_rows, "features"), y="label"))


@query("m18_balanced_subsample", REPORT_SQL)
def balanced_subsample(spark, folder):
    """Trees on bootstraps of their own, with class weights taken within each draw."""
    train_rows, test_rows = _split(spark, folder)
    fitted = SubsampleForest.fit(train_rows, "features", "label", models.forest(trees=2, max_depth=4), key="vec_id")
    return _facts(evaluate.classification_report(fitted.transform(test_rows, "features"), y="label"))


def _svm(spark, folder, **options):
    train_rows, test_rows = _split(spark, folder)
    return _svm_facts(OneVsRestSvm.fit(train_rows, "features", "label", max_iter=10, **options), test_rows, "features")


def _svm_facts(fitted, test_rows, column):
    """Each held-out row, and whether it got a known class and a share as confidence."""
    ok = F.col("pred").isin(fitted.classes) & share("confidence")
    return fitted.transform(test_rows, column).select("vec_id", "label", ok.alias("ok"))


@query("m19_svm_rbf", SVM_SQL)
def svm_rbf(spark, folder):
    return _svm(spark, folder, kernel="rbf", cost=1.0, size=64)


@query("m19_svm_linear", SVM_SQL)
def svm_linear(spark, folder):
    return _svm(spark, folder, kernel="linear", cost=0.1)


@query("m19_svm_poly", SVM_SQL)
def svm_poly(spark, folder):
    """The polynomial kernel on all columns."""
    return _svm(spark, folder, kernel="poly", cost=10.0, coef0=1.0, size=128)


@query("m20_predictions", f"""SELECT doc_id, CAST(dense_rank() OVER (ORDER BY y) - 1 AS INTEGER) AS y, TRUE AS ok FROM {DOCS_OUT}""")
def predictions(spark, folder):
    """Held-out predictions of the trained category model: its classes, with a share as confidence."""
    model, results = trained(spark, folder)
    ok = F.col("pred").isin(model.classifier.classes) & share("confidence")
    return results["predictions"].select("doc_id", "y", ok.alias("ok"))


@query("m21_probability_mass", "SELECT doc_id, CAST(1 AS DOUBLE) AS mass, TRUE AS confidence_is_largest FROM documents")
def probability_mass(spark, folder):
    """Class probabilities sum to one and the confidence is the largest of them."""
    model, _ = trained(spark, folder)
    scored = model.predict(processed(spark, folder).select("doc_id", "processed_text"), "processed_text")
    mass = F.aggregate("probabilities", F.lit(0.0), lambda acc, p: acc + p)
    return scored.select(
        "doc_id", F.round(mass, 6).alias("mass"),
        (F.col("confidence") == F.array_max("probabilities")).alias("confidence_is_largest"),
    )


@query("m18_training_report", f"""SELECT y AS row, count(*) AS support, TRUE AS ok FROM {DOCS_OUT} GROUP BY y
UNION ALL SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), (SELECT count(*) FROM {DOCS_OUT}), TRUE""")
def training_report(spark, folder):
    """The report of the whole training run: terms, SVD, topics, selection, scaling, forests."""
    return _facts(trained(spark, folder)[1]["report"], LANGUAGE_FLOOR)


SWEEP = [
    {"n_topics": 3, "learning_offset": 25.0, "criterion": "gini", "max_samples": 0.8},
    {"n_topics": 3, "learning_offset": 50.0, "criterion": "entropy", "max_samples": 0.7},
    {"n_topics": 4, "learning_offset": 25.0, "criterion": "entropy", "max_samples": 0.9, "balanced": "subsample", "n_estimators": 2},
    {"n_topics": 4, "strategy": "svm", "kernel": "linear", "cost": 0.1},
    {"n_topics": 4, "strategy": "svm", "kernel": "rbf", "cost": 1.0, "gamma": "scale"},
    {"n_topics": 4, "strategy": "svm", "kernel": "rbf", "cost": 10.0, "gamma": "auto"},
]
#: What six runs fit, when they share what they can.
SHARED_FITS = {"split": 1, "vocabulary": 1, "vectors": 1, "svd": 1, "topics": 3, "steps": 3, "balanced": 3}
_swept_rows: dict[tuple[str, str], tuple] = {}


def _swept(spark, folder):
    """(metrics rows, fits) of training runs with three forest and three SVM settings, once per session and folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _swept_rows:
        prefix = Prefix()
        base = replace(SMALL, kernel_size=64, svm_iterations=5)
        rows = materialize(sweep(materialize(processed(spark, folder), "processed"), base, SWEEP, prefix=prefix), "sweep")
        _swept_rows[key] = rows, dict(prefix.fitted)
    return _swept_rows[key]


@query("m26_sweep", f"""SELECT CAST(run - 1 AS INTEGER) AS run, params, TRUE AS ok FROM (VALUES {", ".join(
    f"({i}, '{', '.join(f'{k}={v}' for k, v in s.items())}')" for i, s in enumerate(SWEEP, 1))}) AS t(run, params)
WHERE (SELECT count(*) FROM {DOCS_OUT}) > 0""")
def swept_runs(spark, folder):
    """Each run's parameters, and whether it tells the languages apart better than a constant answer could."""
    return _swept(spark, folder)[0].select("run", "params", (share("accuracy", "weighted_f1", "macro_f1") & (F.col("macro_f1") > 0.3)).alias("ok"))


@query("m26_shared_fits", f"SELECT * FROM (VALUES {', '.join(f"('{k}', {v})" for k, v in SHARED_FITS.items())}) AS t(step, fits) WHERE (SELECT count(*) FROM {DOCS_OUT}) > 0")
def shared_fits(spark, folder):
    """How often the six runs fitted each step."""
    fits = _swept(spark, folder)[1]
    return spark.createDataFrame([(k, fits.get(k, 0)) for k in SHARED_FITS], "step string, fits int")


@query("a19_best_sweep_run", f"SELECT TRUE AS largest, TRUE AS earliest WHERE (SELECT count(*) FROM {DOCS_OUT}) > 0")
def best_sweep_run(spark, folder):
    """The best run of the sweep: no run has a larger weighted F1, no earlier one the same."""
    rows = _swept(spark, folder)[0]
    best = evaluate.best_run(rows).select(F.col("run").alias("_run"), F.col("weighted_f1").alias("_f1"))
    run, f1 = best.select("_run").scalar(), best.select("_f1").scalar()
    return rows.agg(
        (F.max("weighted_f1") <= F.max(f1)).alias("largest"),
        (F.count(F.when((F.col("weighted_f1") == f1) & (F.col("run") < run), 1)) == 0).alias("earliest"))


@query("m28_parameters", f"""SELECT stage, key, value FROM (
  SELECT 'forest ' || CAST(dense_rank() OVER (ORDER BY lang) - 1 AS VARCHAR) AS stage,
         unnest(['numTrees', 'maxDepth', 'impurity', 'minInstancesPerNode']) AS key,
         unnest(['{SMALL.n_estimators}', '{SMALL.max_depth}', '{SMALL.criterion}', '{SMALL.min_leaf}']) AS value
  FROM (SELECT DISTINCT lang FROM documents))
UNION ALL VALUES ('topics', 'k', '{SMALL.n_topics}'), ('topics', 'learningOffset', '{SMALL.learning_offset}'),
  ('settings', 'svd_size', '{SMALL.svd_size}'), ('settings', 'best_features', '{SMALL.best_features}'), ('svd', 'columns', '{SMALL.svd_size}'),
  ('selection', 'columns', '{SMALL.best_features}'), ('vocabulary', 'ngrams', '{TUNED.ngrams}'), ('vocabulary', 'min_df', '{TUNED.min_df}')""")
def parameters(spark, folder):
    """The parameters of every fitted stage; these are the ones the settings fix."""
    model, results = trained(spark, folder)
    fitted = models.describe({"topics": model.steps.lda, **{
        f"forest {c}": m for c, m in zip(model.classifier.classes, model.classifier.models)}}, spark)
    own = [("settings", r["key"], r["value"]) for r in results["parameters"].collect()]
    own += [("vocabulary", k, str(v)) for k, v in asdict(model.steps.vocabulary.settings).items() if k != "stop_words"]
    own += [("svd", "columns", str(model.steps.svd_size)), ("selection", "columns", str(len(model.steps.selected)))]
    every = fitted.unionByName(spark.createDataFrame(own, fitted.schema))
    fixed = ["numTrees", "maxDepth", "impurity", "minInstancesPerNode", "k", "learningOffset", "svd_size", "best_features", "columns", "ngrams", "min_df"]
    return every.where(F.col("key").isin(fixed))


@query("j2_predicted_names", """
SELECT lang AS label, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS idx FROM (SELECT DISTINCT lang FROM documents)""")
def predicted_names(spark, folder):
    """The category names stored with the trained model."""
    return trained(spark, folder)[0].names.select("label", "idx")
