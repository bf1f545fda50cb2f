"""Operators on rows by themselves: word hashes, personal data, secrets, byte-pair encoding, quality grades."""

import base64
import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from newslens.llm import bpe, pii, quality, secret_scan, text
from newslens.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, pii string, secrets int, ids string, tail string, _text string"
LONG = "word " * 60_000 + "a@b.cc"


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "own", 1, "own", "own", "own") for i, t in enumerate(texts)], SCHEMA)


def test_word_hashes(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice("aAbB \t\n\x0b\x0c\r\x1c é") for _ in range(rng.randint(0, 300))) for _ in range(200)] + [None, "", " ", "x" * 5000]
    for window in (1 << 20, 64):
        monkeypatch.setattr(text, "WINDOW", window)
        hashes, at = text.word_hashes(pa.array(texts))
        lower = [[w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for t in texts]
        assert np.diff(at).tolist() == [len(w) for w in lower]
        names = {}
        for w, h in zip((w for ws in lower for w in ws), hashes.tolist()):
            assert names.setdefault(w, h) == h
        assert len(set(names.values())) == len(names)


def brute_pii(t):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if max(map(int, m[0].split("."))) <= 255:
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(digits[::2]) + sum(d * 2 - 9 * (d > 4) for d in digits[1::2])
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append(("phone", *m.span()))
    return found


def test_pii_finds_the_base_spans():
    rng = random.Random(2)
    pieces = ["a@b.c", "x.y@", "@", "..", "1.2.3.4", "256.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112", "0" * 16,
              "+1 (555) 123-4567", "+", "+12", "é", " ", "-", ".", "7", "word", "😀"]
    for _ in range(3000):
        t = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        assert [s[:3] for s in pii.find_pii(t) if s[0] in pii.BASE] == brute_pii(t), t


def test_pii_checks_and_context():
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765431")
    t = "IBAN GB82 WEST 1234 5698 7654 32 NOW, ssn 123-45-6789 and 123-45-6789"
    assert [(s[0], t[s[1] : s[2]]) for s in pii.find_pii(t)] == [
        ("iban", "GB82 WEST 1234 5698 7654 32"), ("national", "123-45-6789"), ("national", "123-45-6789")]
    assert pii.find_pii("number 123-45-6789") == []
    near, far = pii.find_pii("call +1 555 123 4567"), pii.find_pii("x +1 555 123 4567")
    assert near[0][3] > far[0][3]


def test_pii_rows(spark):
    out = pii.with_pii(rows(spark, [None, "", LONG, "a@b.cc 😀 c@d.ee"])).orderBy("doc_id")
    assert out.columns == ["doc_id", "text", "secrets", "ids", "tail", "_text", "pii"]
    got = [[s.start for s in r.pii] for r in out.collect()]
    assert got == [[], [], [300_000], [0, 9]]
    clean = out.select(pii.redact(F.col("text"), F.col("pii")).alias("t")).collect()
    assert clean[3].t == "[email] 😀 [email]" and clean[0].t is None


def brute_secrets(t):
    found = [(m.start(), 0, "assign", m.end()) for m in re.finditer(
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.ASCII) if len(m[1]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return [(k, s, e) for s, _, k, e in sorted(found)]


def test_secrets(spark):
    rng = random.Random(3)
    pieces = ["password", "Token", "API_KEY", "apikey", "=", ":", " ", '"', "'", "short", "longenough1", "AKIA", "ABCDEFGH1234", "0123456789abcdef", "é", "😀", "\n", "x"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 25))) for _ in range(1500)] + [None, "", LONG]
    out = secret_scan.with_secrets(rows(spark, texts))
    assert "secrets" in out.columns and len(out.columns) == 7
    for r in out.collect():
        assert [(s.kind, s.start, s.end) for s in r.secrets if s.kind in secret_scan.BASE] == brute_secrets(r.text or ""), r.text


def test_entropy(spark):
    rng = random.Random(4)
    values = ["".join(rng.choice("abcdef0123456789XYZ") for _ in range(rng.randint(16, 60))) for _ in range(60)] + ["a" * 40, "ab" * 20]

    def brute(v, w=secret_scan.WINDOW):
        return max(-sum(p * math.log2(p) for c in set(v[i : i + w]) for p in [v[i : i + w].count(c) / w]) for i in range(len(v) - w + 1))

    got = spark.createDataFrame([(v,) for v in values], "v string").select("v", secret_scan.window_entropy(F.col("v")).alias("h")).collect()
    assert all(abs(r.h - brute(r.v)) < 1e-9 for r in got)
    texts = ["key Zx9Qw3Er7Ty1Ui5Op2 end", "550e8400-e29b-41d4-a716-446655440000", "aaaaaaaaaaaaaaaaaaaaaaaa", "your_key_Zx9Qw3Er7Ty1Ui5Op2", "antidisestablishmentarianism"]
    kinds = [[s.kind for s in r.secrets] for r in secret_scan.with_secrets(rows(spark, texts)).orderBy("doc_id").collect()]
    assert kinds == [["entropy"], [], [], [], []]


PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(PATH, public_tokenizers.PATTERN)


def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.ranks, special_tokens={})


def test_bpe_encodes_as_the_library(ranks, monkeypatch):
    rng = random.Random(5)
    texts = ["", " ", "\n", "don't 's 'stop we'll ''s x's", "a" * 300, "<|endoftext|>", "日本語 123½Ⅷ²", "é \x1c\x85　 x", "x" * 3000, LONG]
    texts += ["".join(rng.choice("ab'st re.,  \n\té½1²日😀 ") for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    want = reference(ranks)
    for corpus, window in ((1 << 24, 1 << 20), (200, 256)):
        monkeypatch.setattr(bpe, "CORPUS_BYTES", corpus)
        monkeypatch.setattr(bpe, "WINDOW", window)
        for t, (ids, decoded) in zip(texts, bpe.encode(pa.array(texts), ranks)):
            assert ids.tolist() == want.encode_ordinary(t) and decoded == t.encode(), t[:80]


def test_bpe_words_set_aside(tmp_path):
    # "abcd" ranks below "cd": the pair (ab, cd) appears at a rank that has passed
    tokens = [bytes([b]) for b in range(256)] + [b"ab", b"abcd", b"cd"]
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)))
    own = bpe.Ranks(str(path))
    (ids, _), = bpe.encode(pa.array(["abcd"]), own)
    want = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=own.ranks, special_tokens={}).encode_ordinary("abcd")
    assert ids.tolist() == want == [257]


def test_bpe_other_pattern(ranks):
    pattern = r"\S+|\s+"
    want = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks.ranks, special_tokens={})
    (ids, _), = bpe.encode(pa.array(["it's über 12 "]), bpe.Ranks(PATH, pattern))
    assert ids.tolist() == want.encode_ordinary("it's über 12 ")


def test_bpe_rows(spark, ranks):
    texts = [None, "", "hello world", LONG, "hello world"]
    got = bpe.encode_documents(rows(spark, texts), PATH).orderBy("doc_id").collect()
    want = reference(ranks)
    assert [r.ids for r in got] == [want.encode_ordinary(t or "") for t in texts]
    assert [bytes(r.decoded).decode() for r in got] == [t or "" for t in texts]
    digests = bpe.encode_digests(rows(spark, texts), PATH).orderBy("doc_id").collect()
    for r, d in zip(got, digests):
        assert d.n_tokens == len(r.ids)
        assert d.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
        assert d.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe.encode_documents(rows(spark, []), PATH).count() == 0


def test_quality_on_held_out_rows(spark, folder):
    folder = folder.replace("sf0.001", "sf0.1")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    graded = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", quality.grade(F.col("quality"), F.col("toxic")).alias("grade"))
    held = F.col("doc_id") % 4 == 0
    model = quality.train(docs, graded.where(~held))
    assert (np.diff(model.thresholds) > 0).all()
    scored = quality.grade_documents(docs.join(graded.where(held), "doc_id"), model)
    by = {r.grade: r for r in scored.groupBy("grade").agg(
        F.avg((F.col("tail") >= quality.SELECT).cast("int")).alias("kept"), F.avg("expected_grade").alias("mean")).collect()}
    assert by[0].kept < 0.02 and by[1].kept < 0.6 and by[2].kept > 0.98
    assert by[0].mean < by[1].mean < by[2].mean


def test_quality_query_by_brute_force(spark, folder):
    """Every document of the query's table, scored one by one from the fitted weights and thresholds."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    ratings = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", quality.grade(F.col("quality"), F.col("toxic")).alias("grade"))
    model = quality.train(docs, ratings)
    got = {r.doc_id: r for r in QUERIES["op5_quality"](spark, folder).collect()}
    assert len(got) == docs.count()
    for d in docs.collect():
        number, value, _ = quality.features(pa.array([d.text]))
        score = sum(model.weights[n] * v for n, v in zip(number.tolist(), value.tolist()))
        below = [1 / (1 + math.exp(score - t)) for t in model.thresholds]
        chances = [b - a for a, b in zip([0, *below], [*below, 1])]
        assert sum(chances) == pytest.approx(1) and min(chances) >= 0
        r = got[d.doc_id]
        assert r.expected_grade == pytest.approx(sum(k * c for k, c in enumerate(chances)), abs=1e-9)
        assert r.tail == pytest.approx(chances[-1], abs=1e-9) and r.selected == (chances[-1] >= quality.SELECT)


def test_ordinal_fit_finds_planted_weights():
    """Grades drawn from known weights and thresholds: the fit is likelier than the shares of the grades, nearly as likely as the truth."""
    rng = np.random.default_rng(4)
    true = np.array([-3.0, -1.0, 0.0, 1.0, 3.0])
    picks = [rng.choice(5, 2, replace=False) for _ in range(4000)]
    score = np.array([true[p].sum() for p in picks])
    grades = (score[:, None] + rng.logistic(size=(4000, 1)) > np.array([-1.0, 1.0])).sum(axis=1)
    model = quality.fit([(p.astype(np.int32), np.ones(2)) for p in picks], grades)

    def likelihood(scores, thresholds):
        edge = np.concatenate([[-np.inf], thresholds, [np.inf]])
        cut = lambda t: 1 / (1 + np.exp(-np.clip(t - scores, -60, 60)))
        return np.log(cut(edge[grades + 1]) - cut(edge[grades])).mean()

    fitted = likelihood(np.array([model.weights[p].sum() for p in picks]), model.thresholds)
    shares = np.bincount(grades) / len(grades)
    assert fitted > (shares * np.log(shares)).sum() + 0.2
    assert fitted > likelihood(score, np.array([-1.0, 1.0])) - 0.02
    assert (np.diff(model.weights[:5]) > 0).all() and (np.diff(model.thresholds) > 0).all()


def test_quality_rows(spark):
    ratings = spark.createDataFrame([(0, 2), (0, 2), (1, None), (None, 1), (2, 0), (3, 1)], "doc_id long, grade int")
    docs = rows(spark, [None, "", "fine words here", LONG, "fine words here"])
    out = quality.grade_documents(docs, quality.train(docs, ratings))
    got = out.orderBy("doc_id").collect()
    assert len(got) == 5 and all(0 <= r.expected_grade <= 2 and 0 <= r.tail <= 1 for r in got)
    assert got[2].tail == got[4].tail and out.columns.count("tail") == 1
    assert quality.train(docs, ratings.limit(0)) is None
    assert quality.grade_documents(docs, None).where("tail is null").count() == 5
    assert quality.grade_documents(rows(spark, []), quality.train(docs, ratings)).count() == 0
