"""N-grams counted in Arrow batches: the stretches' sums, and no interpreted lambda over the words of a text."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from newslens.operators import grams, terms
from newslens.operators.terms import TermSettings, Vocabulary


def by_hand(docs, stops, lo, hi, known=None):
    tf, df = Counter(), Counter()
    for words in docs:
        words = [w for w in words or [] if w not in stops]
        own = [words[i:i + n] for n in range(lo, hi + 1) for i in range(len(words) - n + 1)]
        own = [" ".join(g) for g in own if known is None or all(w in known for w in g)]
        tf.update(own)
        df.update(set(own))
    return {t: (tf[t], df[t]) for t in tf}


def test_statistics_over_stretches(monkeypatch):
    rng = np.random.default_rng(5)
    docs = [[f"w{i}" for i in rng.integers(0, 12, n)] for n in (0, 1, 2, 40, 3, 90, 0, 7)] + [None, ["w1"] * 6]
    for most in (1, 20, 1000):
        monkeypatch.setattr(grams.list_stretches, "__defaults__", (most,))
        for lo, hi in ((1, 1), (1, 3), (2, 3)):
            got = {}
            for batch in grams.statistics(pa.array(docs, pa.list_(pa.string())), ["w3"], lo, hi):
                for t, tf, df in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    a, b = got.get(t, (0, 0))
                    got[t] = a + tf, b + df
            assert got == by_hand(docs, {"w3"}, lo, hi)
    index = grams.TermIndex(["w1", "w1 w1", "w2 w5", "w1 w1 w1", "not here"], 1, 3, ["w3"])
    at, counts, sizes = index.count(pa.array(docs, pa.list_(pa.string())))
    assert sizes.sum() == len(at) and sizes[-1] == 3 and at[-3:].tolist() == [0, 1, 3] and counts[-3:].tolist() == [6, 5, 4]


def test_masked_words_leave_no_grams(spark):
    mask = terms._word_mask(spark.createDataFrame([("a1",), ("été",)], "term string"))
    docs = [["a1", "été", "a1", "zz", "a1"]]
    got = {t: n for b in grams.statistics(pa.array(docs), [], 2, 3, mask) for t, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
    assert got == {"a1 été": 1, "été a1": 1, "a1 été a1": 1}


def test_words_of_a_text_pass_no_interpreted_lambda(spark):
    docs = spark.createDataFrame([(1, "one two one two"), (2, "one two")], "id int, text string")
    settings = TermSettings(max_features=5, min_df=1, max_df=1.0)
    fitted = Vocabulary.fit(docs, "text", settings)
    counted = fitted.tfidf(fitted.count(docs, "text"), "counts", "v")
    for df in (counted, terms.term_statistics(docs, "text", settings)):
        assert "lambda" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_a_training_run_counts_each_text_once(spark, folder, monkeypatch):
    from newslens.operators.category_model import Prefix, train
    from newslens.plans.modelling import SMALL, processed
    from dataclasses import replace
    counted = []
    count = Vocabulary.count
    monkeypatch.setattr(Vocabulary, "count", lambda self, df, *a: counted.append(df.count()) or count(self, df, *a))
    rows = processed(spark, folder).limit(150).localCheckpoint()
    prefix = Prefix()
    model, results = train(rows, SMALL, prefix=prefix)
    train(rows, replace(SMALL, n_topics=3), prefix=prefix)
    assert sum(counted) == 150
    scored = model.predict(rows, "processed_text").select("doc_id", "pred", "confidence")
    kept = results["predictions"].select("doc_id", "pred", "confidence").collect()
    again = {r["doc_id"]: (r["pred"], r["confidence"]) for r in scored.collect()}
    assert kept and all(again[r["doc_id"]] == (r["pred"], r["confidence"]) for r in kept)


def test_texts_count_like_lists(monkeypatch):
    docs = ["one two  one zz a two", "", None, " two one ", "one"]
    lists = [[w for w in (d or "").split(" ") if len(w) > 1] for d in docs]
    for most in (1, 20, 1 << 20):
        monkeypatch.setattr(grams.text_stretches, "__defaults__", (most,))
        got = {}
        for batch in grams.statistics(pa.array(docs), ["zz"], 1, 3):
            for t, tf, df in zip(*(batch.column(i).to_pylist() for i in range(3))):
                a, b = got.get(t, (0, 0))
                got[t] = a + tf, b + df
        assert got == by_hand(lists, {"zz"}, 1, 3)


def test_rare_grams_of_frequent_words_are_not_formed(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 60, 50)) + " new york" for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    settings = TermSettings(max_features=30, min_df=1, max_df=1.0)
    pruned = terms.pruned_statistics(docs, "text", settings, 80)
    every = {r["term"]: (r["tf"], r["df"]) for r in terms.term_statistics(docs, "text", settings).collect()}
    got = {r["term"]: (r["tf"], r["df"]) for r in pruned.collect()}
    assert got["new york"] == (80, 80) and all(every[t] == n for t, n in got.items())
    assert sum(" " in t for t in got) < 100 < 5000 < len(every)
    tables = [sorted(terms.vocabulary_table(docs, "text", settings, p).collect()) for p in (True, False)]
    assert tables[0] == tables[1]


def test_grams_of_words_in_too_many_documents_stay(spark):
    """Fewer single words than asked for: n-grams rarer than all of them are kept."""
    docs = spark.createDataFrame([(i, ("xx yy" if i < 3 else "yy xx") + " dd" * 9 * (i < 16)) for i in range(20)], "id int, text string")
    settings = TermSettings(max_features=50, min_df=2, max_df=0.95)
    tables = [sorted(terms.vocabulary_table(docs, "text", settings, p).collect()) for p in (True, False)]
    assert tables[0] == tables[1] and "xx yy" in {r["term"] for r in tables[0]}


def test_distinct_numbers_are_sorted_not_hashed(monkeypatch):
    rng = np.random.default_rng(6)
    for numbers in (rng.integers(0, 500, 3000), rng.integers(0, 1 << 64, 100, np.uint64, endpoint=False), np.zeros(0, np.int64)):
        assert (grams.distinct(numbers) == sorted(set(numbers.tolist()))).all()
    plain = np.unique
    monkeypatch.setattr(grams.np, "unique", lambda x, **asked: plain(x, **asked) if asked else pytest.fail("hashed"))
    list(grams.statistics(pa.array(["one two one two", "two"]), [], 1, 3))
    assert len(grams.distinct_keys(pa.array(["one two one"]), [], 1, 2)) == 4


def test_both_vectors_come_from_one_worker(spark):
    from newslens.operators.category_model import _weighted
    docs = spark.createDataFrame([(1, "one two one two"), (2, "One, two"), (3, None), (4, "two three")], "id int, text string")
    fitted = Vocabulary.fit(docs, "text", TermSettings(max_features=5, min_df=1, max_df=1.0))
    got = _weighted(fitted, docs, "text")
    assert got._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    apart = fitted.tfidf(fitted.count(docs, "text", "_counts"), "_counts", "_tfidf", terms.SUBLINEAR)
    assert got.columns == apart.columns and sorted(map(str, got.collect())) == sorted(map(str, apart.collect()))
