"""Evaluation of predictions. Only class-by-class counts leave the prediction table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newslens.operators.sampling import with_position


def n_rows() -> Column:
    return F.count(F.lit(1))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def class_scores(predictions: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """(class, precision, recall, f1, support, tp) for every class seen or predicted."""
    cells = predictions.groupBy(y, pred).agg(n_rows().alias("n"))
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col(y) == F.col(pred), F.col("n")).otherwise(zero)
    sides = F.explode(F.array(
        F.struct(F.col(y).alias("class"), F.col("n").alias("support"), zero.alias("predicted"), hit.alias("tp")),
        F.struct(F.col(pred).alias("class"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("tp")),
    ))
    sums = cells.select(sides.alias("s")).groupBy(F.col("s.class").alias("class")).agg(
        F.sum("s.support").alias("support"), F.sum("s.predicted").alias("predicted"), F.sum("s.tp").alias("tp")
    )
    precision = _ratio(F.col("tp"), F.col("predicted"))
    recall = _ratio(F.col("tp"), F.col("support"))
    scored = sums.select("class", precision.alias("precision"), recall.alias("recall"), "support", "tp")
    f1 = _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return scored.select("class", "precision", "recall", f1.alias("f1"), "support", "tp")


def classification_report(
    predictions: DataFrame, names: DataFrame | None = None, y: str = "y", pred: str = "pred"
) -> DataFrame:
    """(row, precision, recall, f1, support): classes, accuracy, macro and weighted averages.

    ``names`` (idx, label) supplies the row names, joined by class number.
    """
    scores = class_scores(predictions, y, pred)
    if names is not None:
        named = scores.join(names.select(F.col("idx").alias("class"), "label"), "class", "left")
        per_class = named.select(F.coalesce("label", F.col("class").cast("string")).alias("row"),
                                 "precision", "recall", "f1", "support")
    else:
        per_class = scores.select(F.col("class").cast("string").alias("row"), "precision", "recall", "f1", "support")
    return per_class.unionByName(_averages(scores))


def _averages(scores: DataFrame) -> DataFrame:
    total = F.sum("support")
    accuracy = F.sum("tp") / total

    def weighted(c: str) -> Column:
        return F.sum(F.col(c) * F.col("support")) / total

    def row(name: str, p: Column, r: Column, f: Column) -> Column:
        return F.struct(F.lit(name).alias("row"), p.alias("precision"), r.alias("recall"), f.alias("f1"))

    rows = scores.agg(
        F.array(
            row("accuracy", accuracy, accuracy, accuracy),
            row("macro avg", F.avg("precision"), F.avg("recall"), F.avg("f1")),
            row("weighted avg", weighted("precision"), weighted("recall"), weighted("f1")),
        ).alias("rows"),
        total.alias("support"),
    )
    return rows.select(F.explode("rows").alias("r"), "support").select(
        "r.row", "r.precision", "r.recall", "r.f1", "support"
    )


def headline_metrics(predictions: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """One row: accuracy, weighted precision / recall / F1 and macro F1."""
    total = F.sum("support")
    return class_scores(predictions, y, pred).agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("precision") * F.col("support")) / total).alias("weighted_precision"),
        (F.sum(F.col("recall") * F.col("support")) / total).alias("weighted_recall"),
        (F.sum(F.col("f1") * F.col("support")) / total).alias("weighted_f1"),
        F.avg("f1").alias("macro_f1"),
    )


def confusion_matrix(predictions: DataFrame, classes: list[int], y: str = "y", pred: str = "pred") -> DataFrame:
    """(y, pred, n) for all class pairs, zeros included."""
    spark = predictions.sparkSession
    rows = spark.createDataFrame([(c,) for c in classes], f"{y} int")
    wide = predictions.groupBy(y).pivot(pred, classes).agg(n_rows())
    full = rows.join(wide, y, "left").na.fill(0)
    long = full.unpivot([y], [str(c) for c in classes], pred, "n")
    return long.select(y, F.col(pred).cast("int").alias(pred), "n")


def errors(predictions: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    return predictions.where(F.col(y) != F.col(pred))


def class_distribution(train: DataFrame, resampled: DataFrame, test: DataFrame, classes: list[int],
                       label: str = "y") -> DataFrame:
    """(label, train, resampled, test): rows per class in each part, zeros included."""
    spark = train.sparkSession
    parts = {"train": train, "resampled": resampled, "test": test}
    tagged = None
    for name, part in parts.items():
        rows = part.groupBy(label).agg(n_rows().alias("n")).withColumn("part", F.lit(name))
        tagged = rows if tagged is None else tagged.unionByName(rows)
    wide = tagged.groupBy(label).pivot("part", list(parts)).agg(F.sum("n"))
    dims = spark.createDataFrame([(c,) for c in classes], f"{label} int")
    return dims.join(wide, label, "left").na.fill(0)


def reduction_ratios(distribution: DataFrame, label: str = "y") -> DataFrame:
    return distribution.select(label, _ratio(F.col("resampled"), F.col("train")).alias("ratio"))


def batch_mean_accuracy(predictions: DataFrame, id_col: str, batch: int = 16, y: str = "y", pred: str = "pred") -> DataFrame:
    """Mean of the accuracies of consecutive batches in id order.

    Differs from the overall accuracy when the last batch is short.
    """
    placed = with_position(predictions.select(id_col, y, pred), id_col)
    per_batch = placed.groupBy(F.floor(F.col("position") / batch).alias("batch")).agg(
        F.avg((F.col(y) == F.col(pred)).cast("double")).alias("accuracy")
    )
    return per_batch.agg(F.avg("accuracy").alias("mean_batch_accuracy"), n_rows().alias("batches"))


def training_summary(train: DataFrame, test: DataFrame, report: DataFrame) -> DataFrame:
    """True data sizes and the number of categories (report rows minus the three averages)."""
    return report.agg((n_rows() - 3).alias("categories")).select(
        train.agg(n_rows()).scalar().alias("train_size"), test.agg(n_rows()).scalar().alias("test_size"), "categories"
    )


def best_run(results: DataFrame, metric: str = "weighted_f1") -> DataFrame:
    """The run with the highest metric, the earliest among equals."""
    return results.orderBy(F.desc_nulls_last(metric), "run").limit(1)
