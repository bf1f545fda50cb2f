"""The pipeline on a small corpus, against what each stage must do to it, and on odd tables."""

import re

import pytest

import __spark_entry__ as contract
import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def write(spark, folder, docs, labels=()):
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), LABELS).write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def staged(spark, folder):
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, folder), name)
        out.append(docs)
    return out


def corpus():
    import random

    rng = random.Random(11)
    vocabulary = [f"word{i}" for i in range(500)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    docs = [(i, prose(80) + ".\n" + prose(40), "en", f"s{i % 3}", None) for i in range(120)]
    docs += [(120 + i, (prose(10).upper() + "!! $$$ ") * 6, "en", "s0", None) for i in range(60)]
    first = docs[0][1].split("\n")
    docs.append((180, first[0] + "\n" + prose(60), "en", "s1", None))  # shares a line with 0
    near = docs[1][1].replace("\n", " ").split()
    docs.append((181, " ".join([*near[:-1], "other"]), "en", "s1", None))
    docs.append((182, " ".join(near), "en", "s1", None))  # near copies of 1, in one line
    docs.append((183, docs[2][1], "en", "s2", None))  # a copy
    return docs, [(i, 1, 0) for i in range(0, 120, 2)] + [(i, 0, 0) for i in range(120, 180, 2)], first[0]


def test_stages(spark, tmp_path):
    docs, labels, shared = corpus()
    folder = write(spark, tmp_path, docs, labels)
    graded, lines, near, mixed, encoded = staged(spark, folder)
    columns = [n.split()[0] for n in SCHEMA.split(", ")]
    assert all(d.columns == columns for d in (graded, lines, near, mixed))
    assert {r.doc_id for r in graded.collect()} == {d[0] for d in docs} - set(range(120, 180))
    by_id = {r.doc_id: r.text for r in lines.collect()}
    assert 183 not in by_id and shared in by_id[0] and shared not in by_id[180] and len(by_id) == 123
    kept = {r.doc_id for r in near.collect()}
    assert kept == set(by_id) - {181, 182}  # both hold the words of 1, without its line break
    words = {r.doc_id: len(r.text.split()) for r in near.collect()}
    for r in mixed.collect():
        assert 0 < len(r.text.split()) <= 3 * words[r.doc_id] and r.n_chars == len(r.text)
        assert set(r.text.split()) <= set(by_id[r.doc_id].split())
    assert {r.doc_id for r in encoded.collect()} == {r.doc_id for r in mixed.collect()}
    assert sorted(map(str, corpus_pipeline.run(spark, folder).collect())) == sorted(map(str, encoded.collect()))


def test_odd_rows(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "en", None, 0), (3, "one", None, "a", 3), (3, "one", None, "a", 3),
            (4, "x" * 200_000, "en", "b", None), (5, "word " * 30_000, "en", "b", None)]
    folder = write(spark, tmp_path, rows)
    graded, lines, near, mixed, encoded = staged(spark, folder)
    assert graded.count() == lines.count() == near.count() == 7
    assert encoded.count() == mixed.count() and {r.doc_id for r in mixed.collect()} <= {3, 4, 5}


def test_empty_tables(spark, tmp_path):
    folder = write(spark, tmp_path, [])
    assert [d.count() for d in staged(spark, folder)] == [0] * 5


def test_registered():
    assert "pipeline" in contract.queries()
    assert {int(m[1]) for n in contract.queries() if (m := re.match(r"op(\d+)_", n))} == set(range(1, 11))
    with pytest.raises(KeyError):
        contract.oracle_sql()["pipeline"]
