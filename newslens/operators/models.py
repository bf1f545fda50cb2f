"""Category classifiers: one-vs-rest forests and SVMs with probabilities, and parameter sweeps."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import (
    LinearSVC, LogisticRegression, RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from newslens.operators.features import random_fourier_features, scale_gamma, tensor_sketch

MAX_DEPTH = 30  # Spark's limit stands in for unlimited depth


def forest(
    trees: int = 200, criterion: str = "gini", max_samples: float = 0.8, min_leaf: int = 1,
    max_features: str = "sqrt", max_depth: int = MAX_DEPTH, seed: int = 42,
) -> RandomForestClassifier:
    return RandomForestClassifier(
        numTrees=trees, impurity=criterion, maxDepth=max_depth, minInstancesPerNode=min_leaf,
        featureSubsetStrategy=max_features, subsamplingRate=max_samples, seed=seed,
    )


def _balanced(df: DataFrame, positive: Column) -> Callable[[int, int], DataFrame]:
    """Binary label and balanced weight for one class against the rest."""

    def build(n: int, n_positive: int) -> DataFrame:
        rest = max(n - n_positive, 1)
        weight = F.when(positive, n / (2.0 * max(n_positive, 1))).otherwise(n / (2.0 * rest))
        return df.withColumns({"_y": positive.cast("double"), "_w": weight})

    return build


def _fit_each(spark: SparkSession, classes: Sequence[int], fit: Callable[[int], object], parallelism: int) -> list:
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(inheritable_thread_target(spark)(fit), classes))


def with_decision(df: DataFrame, scores: Column, classes: Sequence[int]) -> DataFrame:
    """Add ``probabilities`` (summing to 1), ``pred`` and ``confidence`` from class scores.

    Ties go to the lower class; all-zero scores give equal probabilities.
    """
    staged = df.withColumn("_scores", scores)
    total = F.aggregate("_scores", F.lit(0.0), lambda acc, s: acc + s)
    staged = staged.withColumn("_total", total)
    shares = F.zip_with(
        "_scores", F.array_repeat(F.col("_total"), len(classes)),
        lambda s, t: F.when(t > 0, s / t).otherwise(1.0 / len(classes)),
    )
    staged = staged.withColumn("probabilities", shares)
    best = F.array_position("probabilities", F.array_max("probabilities"))
    labels = F.array(*[F.lit(c) for c in classes])
    return staged.withColumns({
        "pred": F.element_at(labels, best.cast("int")).cast("int"),
        "confidence": F.array_max("probabilities"),
    }).drop("_scores", "_total")


class OneVsRestForest:
    """One balanced binary forest per class; probabilities are normalised over classes."""

    def __init__(self, classes: Sequence[int], models: Sequence[RandomForestClassificationModel]):
        self.classes = list(classes)
        self.models = list(models)

    @classmethod
    def fit(
        cls, train: DataFrame, features: str, label: str, estimator: RandomForestClassifier,
        balanced: bool = True, parallelism: int = 4,
    ) -> OneVsRestForest:
        train = train.select(features, label).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sizes = {r[label]: r["n"] for r in train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
            classes, n = sorted(sizes), sum(sizes.values())

            def fit_one(c: int) -> RandomForestClassificationModel:
                binary = _balanced(train, F.col(label) == c)(n, sizes[c])
                one = estimator.copy().setFeaturesCol(features).setLabelCol("_y")
                return (one.setWeightCol("_w") if balanced else one).fit(binary)

            return cls(classes, _fit_each(train.sparkSession, classes, fit_one, parallelism))
        finally:
            train.unpersist()

    def transform(self, df: DataFrame, features: str) -> DataFrame:
        scored = df
        names = [f"_p{c}" for c in self.classes]
        for name, model in zip(names, self.models):
            # a copy, as the fitted model is shared
            own = model.copy().setFeaturesCol(features).setPredictionCol("").setRawPredictionCol("").setProbabilityCol(name)
            scored = own.transform(scored)
        scores = F.array(*[vector_to_array(n)[1] for n in names])
        return with_decision(scored, scores, self.classes).drop(*names)


def poisson_draws(key: Column, tree: int, rate: float, seed: int) -> Column:
    """How often a row is drawn into a tree's bootstrap: Poisson(``rate``) by the hash of (row, tree, seed).

    The draw depends on nothing else, so it is the same however the rows are dealt out, or read again.
    """
    bits = F.pmod(F.xxhash64(key, F.lit(tree), F.lit(seed)), F.lit(1 << 52)).cast("double")
    uniform, draws, term, below = bits / float(1 << 52), F.lit(0), math.exp(-rate), 0.0
    for n in range(1, 64):
        below += term
        draws = draws + (uniform >= below).cast("int")
        term *= rate / n
        if 1 - below < 1e-12:
            break
    return draws


class SubsampleForest:
    """One-vs-rest trees, each on a bootstrap of its own with class weights taken within the draw.

    With plain balanced weights a tree whose draw holds few rows of a class gives them too little
    weight. Here tree t sees row r as often as ``poisson_draws`` says, and its two classes weigh the
    same within that draw. A tree is a forest of one, so columns are sampled at every split.
    """

    def __init__(self, classes: Sequence[int], models: Sequence[Sequence[RandomForestClassificationModel]]):
        self.classes = list(classes)
        self.models = [list(m) for m in models]

    @classmethod
    def fit(
        cls, train: DataFrame, features: str, label: str, estimator: RandomForestClassifier, *, key: str, parallelism: int = 8,
    ) -> SubsampleForest:
        """``key`` names a column that tells rows apart; equal keys are drawn together."""
        trees, rate, seed = estimator.getNumTrees(), estimator.getSubsamplingRate(), estimator.getSeed()
        train = train.select(features, label, key).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # all draws' class sizes in one pass
            drawn = [F.sum(poisson_draws(F.col(key), t, rate, seed)).alias(f"d{t}") for t in range(trees)]
            rows = train.groupBy(label).agg(*drawn).collect()
            classes = sorted(r[label] for r in rows)
            sizes = {r[label]: [r[f"d{t}"] for t in range(trees)] for r in rows}

            def fit_tree(at: tuple[int, int]) -> RandomForestClassificationModel:
                c, t = at
                mine, every = sizes[c][t], sum(sizes[k][t] for k in classes)
                times = poisson_draws(F.col(key), t, rate, seed)
                share = F.when(F.col(label) == c, every / (2.0 * max(mine, 1))).otherwise(every / (2.0 * max(every - mine, 1)))
                rows = train.withColumn("_n", times).where("_n > 0").withColumns({"_y": (F.col(label) == c).cast("double"), "_w": F.col("_n") * share})
                one = estimator.copy().setFeaturesCol(features).setLabelCol("_y").setWeightCol("_w").setNumTrees(1).setBootstrap(False)
                return one.setSubsamplingRate(1.0).setSeed(seed + t).fit(rows)

            tasks = [(c, t) for c in classes for t in range(trees)]
            fitted = _fit_each(train.sparkSession, tasks, fit_tree, parallelism)
            return cls(classes, [fitted[i * trees:(i + 1) * trees] for i in range(len(classes))])
        finally:
            train.unpersist()

    def transform(self, df: DataFrame, features: str) -> DataFrame:
        """A class's score is the mean of its trees' probabilities."""
        scored, scores, names = df, [], []
        for c, trees in zip(self.classes, self.models):
            own = [f"_p{c}_{t}" for t in range(len(trees))]
            for name, model in zip(own, trees):
                scored = model.copy().setFeaturesCol(features).setPredictionCol("").setRawPredictionCol("").setProbabilityCol(name).transform(scored)
            scores.append(sum((vector_to_array(n)[1] for n in own), F.lit(0.0)) / len(trees))
            names += own
        return with_decision(scored, F.array(*scores), self.classes).drop(*names)


class NativeForest:
    """A single multi-class forest: one fit instead of one per class."""

    def __init__(self, classes: Sequence[int], model: RandomForestClassificationModel):
        self.classes = list(classes)
        self.model = model

    @classmethod
    def fit(
        cls, train: DataFrame, features: str, label: str, estimator: RandomForestClassifier,
        weight: str | None = None,
    ) -> NativeForest:
        classes = [r[label] for r in train.select(label).distinct().orderBy(label).collect()]
        if classes != list(range(len(classes))):
            raise ValueError("labels must be 0..k-1 for the multi-class forest")
        chosen = estimator.copy().setFeaturesCol(features).setLabelCol(label)
        return cls(classes, (chosen.setWeightCol(weight) if weight else chosen).fit(train))

    def transform(self, df: DataFrame, features: str) -> DataFrame:
        own = self.model.copy().setFeaturesCol(features).setPredictionCol("").setRawPredictionCol("").setProbabilityCol("_p")
        return with_decision(own.transform(df), vector_to_array("_p"), self.classes).drop("_p")


class OneVsRestSvm:
    """One linear SVM per class over kernel features, with sigmoid-calibrated confidence.

    ``rbf`` uses random Fourier features, ``poly`` a tensor sketch, each over all columns. The
    sigmoid is fitted on margins of rows that the SVM giving them was not trained on: ``folds``
    more SVMs per class, each trained without one fold. Equal rows share a fold.
    """

    def __init__(self, classes, kernel: Mapping, margins: Sequence[Model], sigmoids: Sequence[tuple[float, float]]):
        self.classes = list(classes)
        self.kernel = dict(kernel)
        self.margins = list(margins)
        self.sigmoids = list(sigmoids)

    @classmethod
    def fit(
        cls, train: DataFrame, features: str, label: str, *, kernel: str = "rbf", cost: float = 1.0,
        gamma: float | str = "scale", degree: int = 3, coef0: float = 0.0, size: int = 256, balanced: bool = True,
        max_iter: int = 50, folds: int = 3, seed: int = 42, parallelism: int = 4,
    ) -> OneVsRestSvm:
        setup = {"kernel": kernel, "degree": degree, "coef0": coef0, "size": size, "seed": seed}
        if kernel != "linear":
            setup["dims"] = len(train.select(features).first()[0])
            if gamma == "scale":
                gamma = scale_gamma(train, features)
            setup["gamma"] = 1.0 / setup["dims"] if gamma == "auto" else float(gamma)
        lifted = _apply_kernel(train, features, setup).select("_k", label)
        lifted = lifted.withColumn("_fold", F.pmod(F.xxhash64(vector_to_array("_k")), F.lit(folds))).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            cells = {(r[label], r["_fold"]): r["n"] for r in lifted.groupBy(label, "_fold").agg(F.count(F.lit(1)).alias("n")).collect()}
            classes, n = sorted({c for c, _ in cells}), sum(cells.values())
            sizes = {c: sum(k for (own, _), k in cells.items() if own == c) for c in classes}

            def trainable(c: int, fold: int) -> bool:
                """Whether rows of the class and others are left without the fold."""
                return any(own == c and f != fold for own, f in cells) and any(own != c and f != fold for own, f in cells)

            def fit_one(c: int):
                binary = _balanced(lifted, F.col(label) == c)(n, sizes[c])
                svm = LinearSVC(
                    featuresCol="_k", labelCol="_y", predictionCol="", regParam=1.0 / (cost * n), maxIter=max_iter
                )
                svm = svm.setWeightCol("_w") if balanced else svm
                model, margins = svm.fit(binary), None
                for fold in range(folds):
                    apart = F.col("_fold") == fold
                    # too few rows to leave a fold out: its margins are the model's own
                    own = svm.fit(binary.where(~apart)) if trainable(c, fold) else model
                    part = own.transform(binary.where(apart)).select(
                        "_y", array_to_vector(F.array(vector_to_array("rawPrediction")[1])).alias("_m"))
                    margins = part if margins is None else margins.unionAll(part)
                platt = LogisticRegression(featuresCol="_m", labelCol="_y", maxIter=max_iter).fit(margins)
                return model, (float(platt.coefficients[0]), float(platt.intercept))

            fitted = _fit_each(train.sparkSession, classes, fit_one, parallelism)
            return cls(classes, setup, [m for m, _ in fitted], [s for _, s in fitted])
        finally:
            lifted.unpersist()

    def transform(self, df: DataFrame, features: str) -> DataFrame:
        scored = _apply_kernel(df, features, self.kernel)
        names = [f"_m{c}" for c in self.classes]
        for name, model in zip(names, self.margins):
            scored = model.copy().setPredictionCol("").setRawPredictionCol(name).transform(scored)
        scores = F.array(*[
            1 / (1 + F.exp(-(F.lit(a) * vector_to_array(n)[1] + b)))
            for n, (a, b) in zip(names, self.sigmoids)
        ])
        return with_decision(scored, scores, self.classes).drop("_k", *names)


def _apply_kernel(df: DataFrame, features: str, setup: Mapping) -> DataFrame:
    kind = setup["kernel"]
    if kind == "linear":
        return df.withColumn("_k", F.col(features))
    if kind == "rbf":
        return random_fourier_features(
            df, features, setup["size"], setup["gamma"], setup["dims"], setup["seed"], "_k"
        )
    if kind == "poly":
        return tensor_sketch(
            df, features, setup["size"], setup["gamma"], setup["coef0"], setup["degree"], setup["dims"], setup["seed"], "_k")
    raise ValueError("kernel must be 'linear', 'rbf' or 'poly'")


def describe(stages: Mapping[str, object], spark: SparkSession) -> DataFrame:
    """(stage, key, value) of every parameter of the given estimators or models."""
    rows = [
        (stage, param.name, str(value))
        for stage, model in stages.items()
        for param, value in model.extractParamMap().items()
    ]
    return spark.createDataFrame(rows, "stage string, key string, value string")


def sweep(
    combinations: Iterable[Mapping[str, object]],
    run: Callable[[Mapping[str, object]], DataFrame],
) -> DataFrame:
    """Evaluate each parameter set with ``run`` (params -> one row of metrics).

    Fits happen one after the other; their inputs are meant to be persisted.
    """
    results = None
    for number, params in enumerate(combinations):
        described = ", ".join(f"{k}={v}" for k, v in params.items())
        row = run(params).select(F.lit(number).alias("run"), F.lit(described).alias("params"), "*")
        results = row if results is None else results.unionByName(row)
    if results is None:
        raise ValueError("no parameter combinations given")
    return results
