"""Online LDA topics."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.clustering import LDA, DistributedLDAModel, LDAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from newslens.functions.fence import fenced
from newslens.operators.online_topics import OnlineTopics, perplexity as online_perplexity

BATCH_SHARE = 1 / 21


def fit_topics(
    df: DataFrame,
    counts_col: str,
    topics: int,
    *,
    offset: float = 25.0,
    batch_size: int | None = None,
    epochs: int = 25,
    doc_prior: float = 0.1,
    topic_prior: float = 0.01,
    seed: int = 42,
    output_col: str = "topics",
) -> LDAModel:
    """Online variational LDA; one Spark iteration is one mini-batch.

    By default an iteration takes a constant share of the data, so their number
    does not grow; a fixed ``batch_size`` makes it grow with the data.
    """
    share = min(1.0, batch_size / max(df.count(), 1)) if batch_size else BATCH_SHARE
    return LDA(
        k=topics, featuresCol=counts_col, topicDistributionCol=output_col, optimizer="online",
        docConcentration=[doc_prior], topicConcentration=topic_prior, optimizeDocConcentration=False,
        learningOffset=offset, learningDecay=0.7, subsamplingRate=share,
        maxIter=epochs * math.ceil(1 / share), seed=seed,
    ).fit(df)


def topic_mix(model: LDAModel, df: DataFrame, counts_col: str, name: str = "topics") -> DataFrame:
    """Add the topic distribution; a document without vocabulary terms gets a uniform one."""
    k = model.getK()
    model = model.copy()  # the fitted model is shared
    model.setFeaturesCol(counts_col).setTopicDistributionCol("_mix")
    mixed = fenced(model.transform(df), _parts=vector_to_array("_mix"))
    known = F.exists("_parts", lambda p: p > 0)
    uniform = F.array_repeat(F.lit(1.0 / k), k)
    return mixed.withColumn(name, array_to_vector(F.when(known, F.col("_parts")).otherwise(uniform))).drop("_mix", "_parts")


def topic_terms(model: LDAModel | DistributedLDAModel, vocabulary: DataFrame, top: int = 10) -> DataFrame:
    """(topic, rank, term, weight): the heaviest terms of each topic."""
    described = model.describeTopics(top).select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("pos", "t")
    )
    weights = described.select(
        "topic", F.col("t.termIndices").alias("idx"), F.col("t.termWeights").alias("weight")
    )
    rank = F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("weight"), "idx"))
    ranked = weights.withColumn("rank", rank)
    return ranked.join(vocabulary.select("idx", "term"), "idx").select("topic", "rank", "term", "weight")


def perplexity(model: LDAModel, df: DataFrame) -> DataFrame:
    """Upper bound on log perplexity and the perplexity itself.

    The bound of an online model with one document prior is computed in Arrow batches, at a cost per document that
    depends on its terms and not on the vocabulary.
    """
    prior = model.estimatedDocConcentration().toArray()
    if isinstance(model, DistributedLDAModel) or np.ptp(prior) > 0:
        bound = model.logPerplexity(df)
    else:
        fitted = OnlineTopics(model.topicsMatrix().toArray().T, doc_prior=float(prior[0]), topic_prior=model.getTopicConcentration())
        sparse = F.unwrap_udt(model.getFeaturesCol())
        bound = math.log(online_perplexity(df.select(sparse["indices"].alias("indices"), sparse["values"].alias("values")), fitted)[0])
    return df.sparkSession.createDataFrame([(bound, math.exp(bound))], "log_perplexity double, perplexity double")
