"""Vocabulary, TF-IDF, chi-square and token ids against brute force in plain Python."""

import math
import re
from collections import Counter

import pytest
from newslens.operators import terms as ops
from newslens.operators.terms import PLAIN, SUBLINEAR, TermSettings, Vocabulary

TEXTS = [
    "The cat sat on the mat and the cat slept", "A dog sat on a cat", "Dogs and cats sat, sat, sat", "", None,
    "été à la plage, la plage", "cat sat cat sat cat sat", "I x 42 under_score",
]
SETTINGS = TermSettings(ngrams=(1, 3), max_features=12, max_df=0.9, min_df=2, stop_words=("the", "on", "and"))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(TEXTS)], "id int, text string, y int")


def grams(text):
    tokens = [t for t in re.findall(r"\w\w+", (text or "").lower()) if t not in SETTINGS.stop_words]
    return [" ".join(tokens[i:i + n]) for n in (1, 2, 3) for i in range(len(tokens) - n + 1)]


def expected_vocabulary(settings=SETTINGS):
    tf, df = Counter(), Counter()
    for t in TEXTS:
        tf.update(grams(t))
        df.update(set(grams(t)))
    kept = [w for w in tf if settings.min_df <= df[w] <= settings.max_df * len(TEXTS)]
    kept = sorted(sorted(kept, key=lambda w: (-tf[w], w))[:settings.max_features])
    return [(i, w, tf[w], df[w], math.log((1 + len(TEXTS)) / (1 + df[w])) + 1) for i, w in enumerate(kept)]


@pytest.mark.parametrize("prune", [False, True])
def test_vocabulary(docs, prune):
    got = [tuple(r) for r in ops.vocabulary_table(docs, "text", SETTINGS, prune=prune).orderBy("idx").collect()]
    want = expected_vocabulary()
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want])


@pytest.mark.parametrize("limit", [3, 50, 400, 5000])
def test_pruned_vocabulary_equals_full(spark, folder, limit):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("text")
    settings = TermSettings(max_features=limit, min_df=2)
    full = ops.vocabulary_table(docs, "text", settings)
    pruned = ops.vocabulary_table(docs, "text", settings, prune=True)
    assert full.count() == pruned.count()
    assert full.exceptAll(pruned).count() == 0


@pytest.mark.parametrize("weighting", [PLAIN, SUBLINEAR])
def test_tfidf(docs, weighting):
    fitted = Vocabulary.fit(docs, "text", SETTINGS)
    vocabulary = {w: (i, idf) for i, w, _, _, idf in expected_vocabulary()}
    got = {r["id"]: r["v"] for r in fitted.tfidf(fitted.count(docs, "text"), "counts", "v", weighting).collect()}
    for i, t in enumerate(TEXTS):
        tf = Counter(g for g in grams(t) if g in vocabulary)
        raw = {vocabulary[g][0]: (n if weighting == PLAIN else 1 + math.log(n)) * vocabulary[g][1] for g, n in tf.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        assert dict(zip(got[i].indices.tolist(), got[i].values.tolist())) == pytest.approx({k: v / norm for k, v in raw.items()})
        assert got[i].size == len(vocabulary)


def test_join_form_equals_row_local_form(docs):
    fitted = Vocabulary.fit(docs, "text", SETTINGS)
    local = ops.tfidf_long(fitted.weigh(fitted.count(docs, "text"), "counts"), "entries", "id")
    table = ops.vocabulary_table(docs, "text", SETTINGS)
    joined = ops.tfidf_by_join(docs, "id", "text", table, SETTINGS).join(table.select("term", "idx"), "term")
    shaped = lambda df: {(r["id"], r["idx"]): round(r["weight"], 9) for r in df.collect()}
    assert shaped(local) == shaped(joined) != {}


def test_chi_square(docs):
    fitted = Vocabulary.fit(docs, "text", SETTINGS)
    scores = ops.chi_square(ops.count_entries(fitted.count(docs, "text"), "counts", "y"), "y", docs.select("y"))
    got = {r["idx"]: r["score"] for r in scores.collect()}
    for i, w, _, _, _ in expected_vocabulary():
        observed = [sum(grams(t).count(w) for j, t in enumerate(TEXTS) if j % 2 == y) for y in (0, 1)]
        share = [sum(1 for j in range(len(TEXTS)) if j % 2 == y) / len(TEXTS) for y in (0, 1)]
        expected = [s * sum(observed) for s in share]
        assert got[i] == pytest.approx(sum((o - e) ** 2 / e for o, e in zip(observed, expected)))


def test_best_features_order(spark):
    scores = spark.createDataFrame([(0, 1.0), (1, None), (2, 5.0), (3, 5.0)], "idx int, score double")
    assert [r["idx"] for r in ops.best_features(scores, 3).collect()] == [2, 3, 0]


def test_token_ids(docs):
    ids = ops.Dictionary({"cat": 7, "sat": 8}, "int")
    got = {r["id"]: r for r in ops.token_ids(docs, "text", ids, 6, (0, 100, 101, 102)).collect()}
    assert got[3]["input_ids"] == [101, 102, 0, 0, 0, 0] and got[3]["attention_mask"] == [1, 1, 0, 0, 0, 0]
    assert got[6]["input_ids"] == [101, 7, 8, 7, 8, 102] and got[6]["attention_mask"] == [1] * 6
    assert got[1]["input_ids"] == [101, 100, 8, 100, 7, 102]


def greedy(word, ids, longest):
    out, at = [], 0
    while at < len(word):
        n = next((n for n in range(min(longest, len(word) - at), 0, -1) if ("##" if at else "") + word[at:at + n] in ids), None)
        if n is None:
            return [100]
        out.append(ids[("##" if at else "") + word[at:at + n]])
        at += n
    return out if len(word) <= 100 else [100]


def test_word_pieces(spark):
    import random
    import re

    rng = random.Random(3)
    pieces = ["a", "b", "é", "ab", "aba", "##a", "##b", "##ba", "##abb", "##é", "##bab", "!", "🙂", "##🙂"]
    ids = {p: i for i, p in enumerate(pieces)}
    texts = [None, "", " ", "ab" * 49 + "ab!", "ab" * 51, "abc", "Ab, é"] + ["".join(rng.choices("aabbé!c 🙂", k=rng.randint(1, 60))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = ops.word_piece_ids(df, "text", ops.Dictionary(ids, "int"), 5, 12, (0, 100, 101, 102)).collect()
    for r in got:
        words = re.findall(r"\w+|[^\s\w]", (r["text"] or "").lower())
        want = [101, *[i for w in words for i in greedy(w, ids, 5)][:10], 102]
        assert r["input_ids"] == want + [0] * (12 - len(want)), r["text"]
        assert r["attention_mask"] == [1] * len(want) + [0] * (12 - len(want))


def test_piece_table(spark):
    words = spark.createDataFrame([("abc",), ("abcd",), ("x" * 30,), ("z",)], "term string")
    got = [r["piece"] for r in ops.piece_table(words).orderBy("idx").collect()]
    assert got == sorted({"abc", "abcd", "z", *"abcdz", *(f"##{c}" for c in "abcdz"), "##bc", "##cd", "##bcd"})


def test_limits():
    with pytest.raises(ValueError):
        TermSettings(max_features=0)
    with pytest.raises(ValueError):
        TermSettings(ngrams=(0, 4))


def test_no_predicate_is_copied_to_the_scan(docs):
    entries = ops.term_statistics(docs, "text", SETTINGS)
    fitted = Vocabulary.fit(docs, "text", SETTINGS)
    long = ops.tfidf_long(fitted.weigh(fitted.count(docs, "text"), "counts"), "entries", "id")
    for df in (entries, long):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert not [line for line in plan.splitlines() if "Filter (" in line and "regexp" in line]


def test_stored_words_are_cut_once(spark, monkeypatch):
    """A fit on stored words writes no texts again, and counting them runs no pattern over them."""
    texts = ["One two, one two!", None, "two three; ÉTÉ été", "", "x one-two three"] * 4
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    settings, labels, write = TermSettings(max_features=6, min_df=1, max_df=1.0), [], ops.materialize
    plain = ops.Vocabulary.fit(docs, "text", settings)
    expected = plain.count(docs, "text").collect()
    stored = ops.store_parted(docs, "text")
    monkeypatch.setattr(ops, "materialize", lambda df, label, *a: labels.append(label) or write(df, label, *a))
    fitted = ops.Vocabulary.fit(stored, "text", settings, parted=True)
    counted = fitted.count(stored, "text", parted=True)
    assert labels and "texts" not in labels and fitted.rows == plain.rows
    assert "regexp" not in counted._jdf.queryExecution().executedPlan().toString()
    assert [r["counts"] for r in counted.orderBy("id").collect()] == [r["counts"] for r in sorted(expected)]


def test_packed_terms_are_dealt_without_strong_hashes(monkeypatch):
    from newslens.operators import grams
    import pyarrow as pa
    monkeypatch.setattr(grams, "blake2b", lambda *a, **k: pytest.fail("hashed"))
    found = [grams.packed_terms(b, 3) for b in grams.statistics(pa.array(["one two three one"]), [], 1, 3)]
    assert sum(sum(b.column("terms").to_pylist()) for b in found) == 8
