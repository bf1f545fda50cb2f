"""The experiment-run store and the evaluation folders."""

from datetime import datetime

import pytest

from newslens.operators import evaluate
from newslens.sources import results, runs


def test_logged_runs_come_back_as_columns(spark, tmp_path):
    path, at = str(tmp_path / "runs"), datetime(2024, 11, 24)
    runs.log_run(spark, path, "forest", "r1", {"trees": 5}, {"accuracy": 0.5, "weighted_f1": 0.25}, at)
    runs.log_run(spark, path, "forest", "r2", {"trees": 9}, {"accuracy": 0.75}, at)
    runs.log_run(spark, path, "svm", "r3", {}, {"accuracy": 1.0}, at)
    stored = runs.read_runs(spark, path)
    assert stored.count() == 6
    wide = {r["run_id"]: (r["accuracy"], r["weighted_f1"]) for r in runs.runs_of(stored, "forest", ["accuracy", "weighted_f1"]).collect()}
    assert wide == {"r1": ("0.5", "0.25"), "r2": ("0.75", None)}
    assert runs.first_metric(stored, "forest", "accuracy").first()[0] == "0.5"
    assert runs.first_metric(stored, "forest", "macro_f1").first()[0] == "No data"
    runs.log_run(spark, path, "forest", "r0", {}, {"accuracy": 0.125}, datetime(2025, 1, 1))
    runs.log_run(spark, path, "forest", "r0", {}, {"accuracy": 0.25}, datetime(2025, 1, 2))
    stored = runs.read_runs(spark, path)
    # the newest run, and of a metric logged twice the newest value
    assert runs.first_metric(stored, "forest", "accuracy").first()[0] == "0.25"
    assert runs.first_metric(stored, "none", "accuracy").first()[0] == "No data"


def test_best_run_prefers_the_first_among_equals(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.9), (2, 0.9), (3, None)], "run int, weighted_f1 double")
    assert evaluate.best_run(df).first()["run"] == 1


def test_incomplete_evaluation_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="confusion_matrix"):
        results.save_evaluation({"report": spark.range(1)}, str(tmp_path), 20, 200)
    assert results.experiment_path("s3://b/", 20, 200) == "s3://b/20topics_200trees"
