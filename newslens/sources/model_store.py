"""Saving and loading a category model as a folder of Spark datasets and ML models."""

from __future__ import annotations

import json
from dataclasses import asdict

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVCModel, RandomForestClassificationModel
from pyspark.ml.clustering import LocalLDAModel
from pyspark.sql import SparkSession

from newslens.operators.category_model import BasicSteps, CategoryModel, FeatureSteps, ModelParams
from newslens.operators.features import SvdProjection
from newslens.operators.models import NativeForest, OneVsRestForest, OneVsRestSvm, SubsampleForest
from newslens.operators.terms import VOCABULARY_SCHEMA, TermSettings, Vocabulary

STAGES = ["settings", "vocabulary", "svd", "topics", "scaler", "classifier", "names"]


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def save_model(model: CategoryModel, path: str) -> None:
    """Write all seven stages below ``path``."""
    spark = model.names.sparkSession
    steps, classifier = model.steps, model.classifier
    settings = {
        "params": asdict(model.params), "classes": classifier.classes,
        "strategy": {NativeForest: "native", OneVsRestSvm: "svm", SubsampleForest: "subsample"}.get(type(classifier), "one-vs-rest"),
    }
    basic = isinstance(steps, BasicSteps)
    if not basic:
        settings |= {"count_columns": steps.count_columns, "selected": steps.selected,
                     "singular_values": [float(s) for s in steps.svd.singular_values]}
    if isinstance(classifier, OneVsRestSvm):
        settings |= {"kernel": classifier.kernel, "sigmoids": classifier.sigmoids}
    if isinstance(classifier, SubsampleForest):
        settings |= {"trees": [len(m) for m in classifier.models]}
    spark.createDataFrame([(json.dumps(settings),)], "value string").write.mode("overwrite").text(f"{path}/settings")
    steps.vocabulary.table(spark).write.mode("overwrite").parquet(f"{path}/vocabulary")
    steps.lda.write().overwrite().save(f"{path}/topics")
    if basic:
        steps.term_scaler.write().overwrite().save(f"{path}/scaler")
        steps.topic_scaler.write().overwrite().save(f"{path}/topic_scaler")
    else:
        components = steps.svd.components
        rows = pa.table({"idx": pa.array(range(len(components)), pa.int32()), "weights": list(components)})
        spark.createDataFrame(rows).write.mode("overwrite").parquet(f"{path}/svd")
        steps.scaler.write().overwrite().save(f"{path}/scaler")
    if isinstance(classifier, NativeForest):
        classifier.model.write().overwrite().save(f"{path}/classifier/all")
    elif isinstance(classifier, SubsampleForest):
        for label, trees in zip(classifier.classes, classifier.models):
            for t, one in enumerate(trees):
                one.write().overwrite().save(f"{path}/classifier/{label}/{t}")
    else:
        fitted = classifier.margins if isinstance(classifier, OneVsRestSvm) else classifier.models
        for label, one in zip(classifier.classes, fitted):
            one.write().overwrite().save(f"{path}/classifier/{label}")
    model.names.write.mode("overwrite").parquet(f"{path}/names")


def load_model(spark: SparkSession, path: str) -> CategoryModel:
    """Load a saved model; a missing stage is an error that names it."""
    settings, stages = {"params": {}}, STAGES
    if exists(spark, f"{path}/settings"):
        settings = json.loads(spark.read.text(f"{path}/settings").first()["value"])
    stored = settings["params"]
    basic = stored.get("features") == "basic"
    if basic:
        stages = [{"svd": "topic_scaler"}.get(s, s) for s in STAGES]
    missing = [s for s in stages if not exists(spark, f"{path}/{s}")]
    if missing:
        raise FileNotFoundError(f"model at {path} lacks {', '.join(missing)}")
    stored["terms"] = TermSettings(**{
        k: tuple(v) if isinstance(v, list) else v for k, v in stored["terms"].items()
    })
    params = ModelParams(**stored)
    vocabulary = Vocabulary.from_table(
        spark.read.schema(VOCABULARY_SCHEMA).parquet(f"{path}/vocabulary"), params.terms
    )
    lda, scaler = LocalLDAModel.load(f"{path}/topics"), PipelineModel.load(f"{path}/scaler")
    if basic:
        steps = BasicSteps(vocabulary, lda, scaler, PipelineModel.load(f"{path}/topic_scaler"))
    else:
        weights = spark.read.parquet(f"{path}/svd").orderBy("idx").collect()
        svd = SvdProjection(np.array([r["weights"] for r in weights]), np.array(settings["singular_values"]))
        steps = FeatureSteps(vocabulary, svd, lda, settings["count_columns"], settings["selected"], scaler)
    load = RandomForestClassificationModel.load
    if settings["strategy"] == "native":
        classifier = NativeForest(settings["classes"], load(f"{path}/classifier/all"))
    elif settings["strategy"] == "svm":
        margins = [LinearSVCModel.load(f"{path}/classifier/{c}") for c in settings["classes"]]
        classifier = OneVsRestSvm(settings["classes"], settings["kernel"], margins, settings["sigmoids"])
    elif settings["strategy"] == "subsample":
        classifier = SubsampleForest(settings["classes"], [
            [load(f"{path}/classifier/{c}/{t}") for t in range(n)] for c, n in zip(settings["classes"], settings["trees"])])
    else:
        classifier = OneVsRestForest(settings["classes"], [load(f"{path}/classifier/{c}") for c in settings["classes"]])
    return CategoryModel(params, steps, classifier, spark.read.parquet(f"{path}/names"))
