"""Terms meet a vocabulary table, and each other, by segments of their hash."""

import re

import numpy as np
import pyarrow as pa
import pytest

from newslens.operators import grams as arrow, terms as ops
from newslens.operators.terms import SUBLINEAR, TermSettings, Vocabulary

SETTINGS = TermSettings(min_df=1, max_df=1.0, stop_words=("the",))


@pytest.fixture(scope="module")
def texts(spark):
    words = np.random.default_rng(5).integers(0, 60, (90, 30))
    rows = [(i, " ".join(f"w{w} the" if w % 7 else f"Über{w}" for w in own)) for i, own in enumerate(words)]
    return spark.createDataFrame([*rows, (90, ""), (91, None), (None, "w1 w2 w1")], "id int, text string").repartition(3).localCheckpoint()


def test_pieces_weigh_like_rows(texts, monkeypatch):
    table = ops.vocabulary_table(texts, "text", SETTINGS).localCheckpoint()
    fitted = Vocabulary.from_table(table, SETTINGS)
    entries = fitted.weigh(fitted.count(texts, "text"), "counts", weighting=SUBLINEAR)
    want = {(r["id"], fitted.terms[r["idx"]]): r["weight"] for r in ops.tfidf_long(entries, "entries", "id").collect()}
    for most in (1 << 22, 2500):  # one piece, and many
        monkeypatch.setattr(ops, "PIECE_BYTES", most)
        got = ops.tfidf_by_join(texts, "id", "text", table, SETTINGS, SUBLINEAR).collect()
        assert len(got) == len(want) and {(r["id"], r["term"]): pytest.approx(r["weight"]) for r in got} == want


def test_no_term_of_a_document_is_shuffled(texts):
    """Exchanges carry texts once, keys and answers, but no row per document and term."""
    plan = ops.tfidf_by_join(texts, "id", "text", ops.vocabulary_table(texts, "text", SETTINGS).localCheckpoint(), SETTINGS)
    lines = plan._jdf.queryExecution().executedPlan().toString().splitlines()
    keyed = [re.search(r"hashpartitioning\((\w+)#", line)[1] for line in lines if "hashpartitioning" in line]
    assert keyed and set(keyed) == {"piece", "segment"}


def test_terms_of_one_key_raise(texts, monkeypatch):
    table = ops.vocabulary_table(texts, "text", SETTINGS).localCheckpoint()
    with pytest.raises(Exception, match="the same key"):
        ops.tfidf_by_join(texts, "id", "text", table.unionAll(table.limit(1)), SETTINGS).collect()


def test_keys_travel_as_steps():
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << 64, 5000, np.uint64, endpoint=False))
    assert (arrow.unpacked(arrow.packed(keys)) == keys).all() and len(arrow.unpacked(arrow.packed(keys[:0]))) == 0
    runs = arrow.segments(keys, 4)
    assert [s for s, _, _ in runs] == list(range(16)) and all((keys[a:b] >> np.uint64(60) == s).all() for s, a, b in runs)
    values = np.arange(1000) % 7 / 2
    known, got = arrow.answered(5000, *arrow.looked_up(keys, keys[::5], values))
    assert (np.flatnonzero(known) == np.arange(0, 5000, 5)).all() and (got[::5] == values).all()
    assert not arrow.answered(5000, *arrow.looked_up(keys, keys[:0], values[:0]))[0].any()


def test_keys_of_terms_are_those_in_texts():
    words = pa.array(["alpha beta gamma beta", "beta gamma"])
    found = arrow.distinct_keys(words, ["alpha"], 1, 3)
    keys, possible = arrow.term_keys(pa.array(["beta", "gamma", "beta gamma", "gamma beta", "beta gamma beta", "a b c d"]), 3)
    assert possible.tolist() == [True] * 5 + [False] and set(keys[:5]) == set(found)


def test_terms_meet_compressed(texts):
    """No row per term and task is shuffled, only blocks of terms by segment."""
    found = ops.term_statistics(texts, "text", SETTINGS)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(segment#" in plan and "hashpartitioning(term#" not in plan
    rows = {r["term"]: (r["tf"], r["df"]) for r in found.collect()}
    assert len(rows) == found.count() and rows["w1 w2"][0] >= rows["w1 w2"][1] > 0


def test_packed_terms_add_up():
    texts = pa.array(["alpha beta alpha", "beta über beta", "alpha"])
    whole = {t: (n, d) for b in arrow.statistics(texts, [], 1, 3) for t, n, d in zip(*(c.to_pylist() for c in b.columns))}
    parts = [arrow.packed_terms(b, 2) for x in (texts[:1], texts[1:]) for b in arrow.statistics(x, [], 1, 3)]
    table, got = pa.Table.from_batches(parts), {}
    for s in set(table["segment"].to_pylist()):
        rows = arrow.summed_terms(table.filter(pa.compute.equal(table["segment"], s))).to_pylist()
        assert not got.keys() & {r["term"] for r in rows}
        got |= {r["term"]: (r["tf"], r["df"]) for r in rows}
    assert got == whole and got["beta über"] == (1, 1) and got["alpha"] == (3, 2)


def test_a_piece_is_keyed_once_when_weighed(texts, monkeypatch):
    """The keys asked for and the known terms come from one pass over a piece's n-grams."""
    called, keyed = [], arrow.keyed_grams
    monkeypatch.setattr(arrow, "keyed_grams", lambda *a: called.append(1) or keyed(*a))
    lines = pa.array(["alpha beta alpha", "beta gamma beta", None])
    grams = list(arrow.keyed_grams(lines, [], 1, 2))
    keys = arrow.keys_of(grams)
    terms, term, doc, tf, at = arrow.known_terms(grams, keys, np.arange(len(keys)) >= 0)
    got = {(d, terms[t].as_py()): n for t, d, n in zip(term.tolist(), doc.tolist(), tf.tolist())}
    assert len(called) == 1 and got[0, "alpha"] == 2 and got[1, "beta gamma"] == 1 and len(got) == 4 + 4


def test_keys_of_terms_are_made_of_words(monkeypatch):
    """The same term has the same key in every stretch, and no code is made of a whole term."""
    hashed, codes = [], arrow._word_codes
    monkeypatch.setattr(arrow, "_word_codes", lambda w: hashed.extend(w.to_pylist()) or codes(w))
    lines, of = ["one two three one", "zero one two three"], {}
    for line in lines:
        for found, keys in arrow.keyed_statistics(pa.array([line]), [], 1, 3):
            arrow.packed_terms(found, 2, keys)
            for t, k in zip(found["term"].to_pylist(), keys.tolist()):
                assert of.setdefault(t, k) == k
    assert len(set(of.values())) == len(of) == 11 and not any(" " in w for w in hashed)
