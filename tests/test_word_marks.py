"""Marks of distinct words against the column rules, and the texts kept of plain words against those of annotated ones."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newslens.functions import tagging
from newslens.functions.tagging import Tagger

STEMS = ["", "b", "st", "runn", "stopp", "agree", "bo", "bos", "gla", "cla", "wat", "fo", "tr", "x9", "a-b", "é", "9", "?", "!", ",", "-", "'", "A", "Zed", "u.s"]
ENDINGS = ["", "s", "es", "ss", "us", "is", "ies", "ied", "ing", "ed", "ly", "ous", "less", "ful", "able", "ible", "ive", "ches", "xes", "sses", "zes", "ings", "'s"]
WORDS = sorted({a + b for a in STEMS for b in ENDINGS})


def test_marks_follow_the_column_rules(spark):
    got = spark.createDataFrame([(w,) for w in WORDS], "w string").select("w", tagging.fallback_mark(F.col("w")).alias("m")).collect()
    assert {r["w"]: tuple(r["m"]) for r in got} == {w: tagging.word_mark(w) for w in WORDS}


@pytest.mark.parametrize("cased", [False, True])
def test_texts_of_plain_words(spark, cased):
    lists = [WORDS, [], None, ["good", "Very", "The", "not", "."], WORDS[::-3], ["the"], [""]]
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(lists)], "id int, w array<string>").coalesce(1)
    tagger, stops, keeps = Tagger({"good": ("JJ", "good"), "sting": ("VB", "sting"), "ss": ("NN", "")}, cased), ["the", "bs", "agrees"], ["not", "the"]
    staged = rows.withColumn("k", tagger.annotate(F.col("w")))
    got = staged.select(
        "id", tagging.topic_text(F.col("k"), stops, cased).alias("topic"), tagger.topic_text(F.col("w"), stops).alias("topic2"),
        tagging.sentiment_text(F.col("k"), stops, keeps, "batch", cased).alias("batch"), tagger.sentiment_text(F.col("w"), stops, keeps).alias("batch2"),
        tagging.sentiment_text(F.col("k"), stops, keeps, "serving", cased).alias("serving"),
        tagger.sentiment_text(F.col("w"), stops, keeps, "serving").alias("serving2")).collect()
    assert len(got) == len(lists)
    for r in got:
        assert (r["topic"], r["batch"], r["serving"]) == (r["topic2"], r["batch2"], r["serving2"])
    assert got[0]["topic"] and got[3]["batch"]


def test_words_pass_no_interpreted_lambda(spark):
    from newslens.operators.annotate import annotate
    rows = spark.createDataFrame([("Good news", "They ran")], "headline string, short_description string")
    plan = annotate(rows).select("processed_text", "sentiment_text")._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and plan.count("annotated(") == 0


def test_lemmas_are_gathered_by_stretches(spark, monkeypatch):
    lists = [["the", "dogs", "ran"], [], None, ["parties"] * 7, ["a"], ["walked", "cities", "dogs"]]
    rows = spark.createDataFrame(list(enumerate(lists)), "id int, words array<string>").coalesce(1).orderBy("id")
    got = [r[0] for r in rows.select(Tagger().topic_text(F.col("words"), [])).collect()]
    functions = []
    monkeypatch.setattr(tagging, "TOKENS", 3)
    monkeypatch.setattr(F, "arrow_udf", lambda kind: lambda f: functions.append(f) or SimpleNamespace(asNondeterministic=lambda: lambda c: None))
    Tagger().topic_text(None, [])
    assert list(tagging._stretches(np.array([0, 3, 3, 3, 10, 11, 14]))) == [(0, 3), (3, 4), (4, 5), (5, 6)]
    assert functions[0](pa.array(lists)).to_pylist() == got and got[2] is None and got[3] == " ".join(["party"] * 7)


def test_one_worker_annotates(spark):
    """A node of Python functions for tags and both texts; each task keeps a worker for every node."""
    from newslens.operators.annotate import annotate
    rows = spark.createDataFrame([("Good news", "They ran")], "headline string, short_description string")
    plan = annotate(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "annotated(" not in plan


def test_lines_give_what_lists_give(spark, monkeypatch):
    lists = [["the", "dogs", "ran"], [], None, ["parties"] * 7, ["a"], ["walked", "cities", "."]] * 3
    rows = spark.createDataFrame(list(enumerate(lists)), "id int, words array<string>").coalesce(1).orderBy("id")
    functions = []
    monkeypatch.setattr(tagging, "TOKENS", 3)
    monkeypatch.setattr(F, "arrow_udf", lambda kind: lambda f: functions.append(f) or SimpleNamespace(asNondeterministic=lambda: lambda c: None))
    tagger = Tagger()
    tagger.tags(None), tagger.topic_text(None, ["a"]), tagger.sentiment_text(None, ["the"], [])
    lines = pa.array([None, "x y", *(None if w is None else " ".join(w) for w in lists)])[2:]  # a slice, as batches may be
    monkeypatch.undo()
    tags, topic, mood = (f(lines).to_pylist() for f in functions)
    got = rows.select(
        F.array_join(F.transform(tagger.annotate(F.col("words")), tagging.tag_of), " "), tagger.topic_text(F.col("words"), ["a"]),
        tagger.sentiment_text(F.col("words"), ["the"], [])).collect()
    assert [tuple(r) for r in got] == list(zip(tags, topic, mood)) and tags[1] == "" and tags[2] is None
    with pytest.raises(ValueError):
        Tagger({"new": ("A B", "new")})
