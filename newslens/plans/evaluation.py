"""Evaluation reports, checked on a deterministic pseudo-prediction, and the run store."""

from datetime import datetime

from pyspark.sql import functions as F

from newslens.operators import evaluate, joins, reports
from newslens.plans.articles import articles, over_articles
from newslens.plans.registry import query
from newslens.session import materialize, scratch_path
from newslens.sources import results as result_store
from newslens.sources import runs as run_store
from newslens.sources.files import read_table

CLASSES = [0, 1, 2, 3, 4]  # the last one never occurs
PREDICTIONS_SQL = """names AS (SELECT CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS idx, lang AS label
    FROM (SELECT DISTINCT lang FROM documents)),
  predictions AS (SELECT doc_id, idx AS y, CAST(CASE WHEN md5(CAST(doc_id AS VARCHAR) || 'p') < 'b' THEN idx
    ELSE (idx + n_chars) % 3 END AS INTEGER) AS pred, (n_chars % 997) / 997.0 AS confidence
    FROM documents JOIN names ON lang = label)"""
SCORES_SQL = """cells AS (SELECT y, pred, count(*) AS n FROM predictions GROUP BY ALL),
  classes AS (SELECT y AS class FROM cells UNION SELECT pred FROM cells),
  sums AS (SELECT class, coalesce((SELECT sum(n) FROM cells WHERE y = class), 0) AS support,
    coalesce((SELECT sum(n) FROM cells WHERE pred = class), 0) AS predicted,
    coalesce((SELECT sum(n) FROM cells WHERE pred = class AND y = class), 0) AS tp FROM classes),
  ratios AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS p,
    CASE WHEN support > 0 THEN tp / support ELSE 0 END AS r FROM sums),
  scores AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM ratios)"""
WITH_SCORES = f"WITH {PREDICTIONS_SQL}, {SCORES_SQL}\n"


def predictions(spark, folder):
    rows = read_table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    numbered = joins.attach_index(rows, joins.label_index(rows, "lang"), "lang", "y")
    stays = F.md5(F.concat(F.col("doc_id").cast("string"), F.lit("p"))) < "b"
    return numbered.select(
        "doc_id", "y",
        F.when(stays, F.col("y")).otherwise((F.col("y") + F.col("n_chars")) % 3).cast("int").alias("pred"),
        ((F.col("n_chars") % 997) / 997.0).alias("confidence"),
    )


def _names(spark, folder):
    return joins.label_index(articles(spark, folder, "lang"), "lang")


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 9) for c in columns})


@query("m22_classification_report", WITH_SCORES + """
SELECT coalesce(label, CAST(class AS VARCHAR)) AS "row", round(p, 9) AS precision, round(r, 9) AS recall, round(f, 9) AS f1,
       CAST(support AS BIGINT) AS support FROM scores LEFT JOIN names ON idx = class
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 9), round(sum(tp) / sum(support), 9), round(sum(tp) / sum(support), 9),
       CAST(sum(support) AS BIGINT) FROM scores
UNION ALL SELECT 'macro avg', round(avg(p), 9), round(avg(r), 9), round(avg(f), 9), CAST(sum(support) AS BIGINT) FROM scores
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 9), round(sum(r * support) / sum(support), 9),
       round(sum(f * support) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM scores""")
def classification_report(spark, folder):
    report = evaluate.classification_report(predictions(spark, folder), _names(spark, folder))
    return _rounded(report, "precision", "recall", "f1")


@query("m23_confusion_matrix", f"""WITH {PREDICTIONS_SQL}
SELECT a.y, b.pred, count(p.doc_id) AS n FROM (SELECT unnest([0, 1, 2, 3, 4]) AS y) a CROSS JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS pred) b
LEFT JOIN predictions p ON p.y = a.y AND p.pred = b.pred GROUP BY ALL""")
def confusion_matrix(spark, folder):
    return evaluate.confusion_matrix(predictions(spark, folder), CLASSES)


@query("m24_errors", f"WITH {PREDICTIONS_SQL} SELECT doc_id, y, pred, round(confidence, 9) AS confidence FROM predictions WHERE y <> pred")
def errors(spark, folder):
    return _rounded(evaluate.errors(predictions(spark, folder)), "confidence")


@query("m25_headline_metrics", WITH_SCORES + """
SELECT round(sum(tp) / sum(support), 9) AS accuracy, round(sum(p * support) / sum(support), 9) AS weighted_precision,
       round(sum(r * support) / sum(support), 9) AS weighted_recall, round(sum(f * support) / sum(support), 9) AS weighted_f1,
       round(avg(f), 9) AS macro_f1 FROM scores""")
def headline_metrics(spark, folder):
    metrics = evaluate.headline_metrics(predictions(spark, folder))
    return _rounded(metrics, *metrics.columns)


@query("m25_batch_mean_accuracy", f"""WITH {PREDICTIONS_SQL}
SELECT round(avg(a), 9) AS mean_batch_accuracy, count(*) AS batches FROM (
  SELECT avg(CASE WHEN y = pred THEN 1.0 ELSE 0.0 END) AS a FROM (
    SELECT y, pred, (row_number() OVER (ORDER BY doc_id) - 1) // 16 AS b FROM predictions) GROUP BY b)""")
def batch_mean_accuracy(spark, folder):
    return _rounded(evaluate.batch_mean_accuracy(predictions(spark, folder), "doc_id"), "mean_batch_accuracy")


@query("m27_training_summary", WITH_SCORES + """
SELECT (SELECT count(*) FROM predictions WHERE y <> 1) AS train_size, (SELECT count(*) FROM predictions WHERE y = 1) AS test_size,
       (SELECT count(*) FROM classes) AS categories""")
def training_summary(spark, folder):
    rows = predictions(spark, folder)
    report = evaluate.classification_report(rows)
    return evaluate.training_summary(rows.where("y <> 1"), rows.where("y = 1"), report)


@query("a18_confidence_summary", f"""WITH {PREDICTIONS_SQL}
SELECT round(avg(confidence), 9) AS mean, round(min(confidence), 9) AS lowest, round(max(confidence), 9) AS highest FROM predictions""")
def confidence_summary(spark, folder):
    return _rounded(reports.summary(predictions(spark, folder), "confidence"), "mean", "lowest", "highest")


@query("a19_best_run", over_articles("""
SELECT run, n AS weighted_f1 FROM (SELECT category AS run, count(*) FILTER (length(text) > 1500) AS n FROM articles GROUP BY category)
ORDER BY n DESC, run LIMIT 1"""))
def best_run(spark, folder):
    """The highest metric wins, the first run among equals (here: long articles per source)."""
    long = F.sum((F.length("text") > 1500).cast("bigint"))
    runs = articles(spark, folder, "category", "text").groupBy(F.col("category").alias("run")).agg(long.alias("weighted_f1"))
    return evaluate.best_run(runs)


@query("s7_evaluation_sinks", WITH_SCORES + """
SELECT 'report' AS name, (SELECT count(*) FROM classes) + 3 AS n UNION ALL SELECT 'confusion_matrix', 25
UNION ALL SELECT 'confidences', (SELECT count(*) FROM predictions)
UNION ALL SELECT 'errors', (SELECT count(*) FROM predictions WHERE y <> pred)
UNION ALL SELECT 'parameters', 2 UNION ALL SELECT 'class_distribution', 5""")
def evaluation_sinks(spark, folder):
    """All six tables of an evaluation, written under the experiment's folder and read back."""
    rows = materialize(predictions(spark, folder), "predictions")
    base = scratch_path(spark, "results")
    tables = {
        "report": evaluate.classification_report(rows),
        "confusion_matrix": evaluate.confusion_matrix(rows, CLASSES),
        "confidences": rows.select("doc_id", "confidence"),
        "errors": evaluate.errors(rows),
        "parameters": spark.createDataFrame([("n_topics", "20"), ("n_estimators", "200")], "key string, value string"),
        "class_distribution": evaluate.class_distribution(rows, rows, rows, CLASSES),
    }
    path = result_store.save_evaluation(tables, base, 20, 200)
    loaded = result_store.load_evaluation(spark, path, {n: t.schema for n, t in tables.items()})
    counted = None
    for name, table in loaded.items():
        row = table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        counted = row if counted is None else counted.unionByName(row)
    return counted


RUNS_SQL = over_articles("SELECT * FROM runs", """runs AS (
  SELECT category AS run_id, lang AS experiment, 'metric' AS kind, 'articles' AS key, CAST(count(*) AS VARCHAR) AS value FROM articles GROUP BY ALL
  UNION ALL SELECT category, lang, 'metric', 'longest', CAST(max(length(text)) AS VARCHAR) FROM articles GROUP BY ALL
  UNION ALL SELECT category, lang, 'param', 'source', category FROM articles GROUP BY ALL)""")


def _write_runs(spark, folder):
    """Three appends to a fresh run store, one per key."""
    path = scratch_path(spark, "runs")
    rows = articles(spark, folder, "category", "lang", "text").groupBy(
        F.col("category").alias("run_id"), F.col("lang").alias("experiment")
    ).agg(F.count(F.lit(1)).cast("string").alias("articles"), F.max(F.length("text")).cast("string").alias("longest"))
    # the more articles, the later the run
    at = F.timestamp_add("MINUTE", F.col("articles").cast("int"), F.lit(datetime(2024, 11, 24))).alias("ts")
    for kind, key, value in (("metric", "articles", "articles"), ("metric", "longest", "longest"), ("param", "source", "run_id")):
        run_store.append_runs(rows.select(
            "run_id", "experiment", at, F.lit(kind).alias("kind"), F.lit(key).alias("key"), F.col(value).alias("value")
        ), path)
    return run_store.read_runs(spark, path)


@query("s10_run_log", RUNS_SQL)
def run_log(spark, folder):
    return _write_runs(spark, folder).select("run_id", "experiment", "kind", "key", "value")


@query("s11_runs_of_experiment", over_articles("""
SELECT category AS run_id, CAST(count(*) AS VARCHAR) AS articles, CAST(max(length(text)) AS VARCHAR) AS longest,
       CAST(NULL AS VARCHAR) AS accuracy FROM articles WHERE lang = 'en' GROUP BY category"""))
def runs_of_experiment(spark, folder):
    """One row per run; a metric that was never logged is null."""
    return run_store.runs_of(_write_runs(spark, folder), "en", ["articles", "longest", "accuracy"])


@query("s11_first_metric", over_articles("""
SELECT 'articles' AS metric, CAST(count(*) AS VARCHAR) AS value FROM articles
WHERE lang = 'en' AND category = (SELECT category FROM articles WHERE lang = 'en' GROUP BY category ORDER BY count(*) DESC, category LIMIT 1)
UNION ALL SELECT 'accuracy', 'No data'"""))
def first_metric(spark, folder):
    runs = _write_runs(spark, folder)
    parts = [
        run_store.first_metric(runs, "en", key).select(F.lit(key).alias("metric"), F.col(key).alias("value"))
        for key in ("articles", "accuracy")
    ]
    return parts[0].unionByName(parts[1])
