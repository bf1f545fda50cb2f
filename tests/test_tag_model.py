"""The tag model against all sequences worked out one by one, and against a lexicon where context decides."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from newslens.operators.tag_model import TagModel, agreement


def test_likeliest_sequences():
    rng = np.random.default_rng(3)
    tags, words = ["A", "B", "C"], ["u", "v", "w", "x"]
    model = TagModel(tags, np.log(rng.dirichlet(np.ones(3))), np.log(rng.dirichlet(np.ones(3), 3)), {w: np.log(rng.random(3)) for w in words}, {"": np.zeros(3)})
    articles = [[], ["u"], *(rng.choice([*words, "unknown"], n).tolist() for n in (2, 3, 5, 6, 6, 4))]

    def score(article, sequence):
        total = model.start[sequence[0]] + model._of(article[0])[sequence[0]]
        for a, b, w in zip(sequence, sequence[1:], article[1:]):
            total += model.step[a, b] + model._of(w)[b]
        return total

    want = [[tags[t] for t in max(itertools.product(range(3), repeat=len(a)), key=lambda s: score(a, s))] if a else [] for a in articles]
    assert model.sequences(articles) == want


def sentences(n, seed):
    """'run' and 'play' are verbs after a noun, and nouns after an article; words in -ly are adverbs."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        noun, word = rng.choice(["dog", "team", "child"]), rng.choice(["run", "play", "walk"])
        tail = [("".join(rng.choices("abcdefg", k=5)) + "ly", "RB")] * rng.randint(0, 1)
        pairs = [("the", "DT"), (noun, "NN"), (word, "VB"), *tail] if rng.random() < 0.5 else [("the", "DT"), (word, "NN"), ("was", "VB"), *tail]
        rows.append((i, [w for w, _ in pairs], [t for _, t in pairs]))
    return rows


def test_context_and_endings_beat_the_commonest_tag(spark):
    schema = "id int, words array<string>, tags array<string>"
    train = spark.createDataFrame([*sentences(400, 1), (900, [], []), (901, None, None)], schema)
    test = spark.createDataFrame([*sentences(100, 2), (900, [], []), (901, None, None)], schema).repartition(3)
    model = TagModel.fit(train, "words", "tags")
    scored = model.tag(test, "words", "found").cache()
    total, right = scored.agg(F.sum(F.size("tags")), F.sum(agreement(F.col("tags"), F.col("found")))).first()
    assert right / total > 0.99
    odd = {r["id"]: r["found"] for r in scored.where("id >= 900").collect()}
    assert odd == {900: [], 901: None}
    commonest = {w: max(model.tags, key=lambda t: v[model.tags.index(t)]) for w, v in model.words.items()}
    alone = sum(commonest.get(w) == t for _, ws, ts in sentences(100, 2) for w, t in zip(ws, ts))
    assert alone < right
    with pytest.raises(ValueError):
        TagModel.fit(train.where("id > 5000"), "words", "tags")
