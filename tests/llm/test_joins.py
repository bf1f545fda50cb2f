"""Operators over many rows: components, near-duplicates, lines, vectors, top-k, language model, mixing."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from newslens.llm import graph, line_dedup, lm, minhash, mixing, topk, vectors
from newslens.llm.queries import QUERIES, SQL
from newslens.plans.registry import Query
from tests.compare import compare, connect

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Sets:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, n):
        while self.up[n] != n:
            n = self.up[n]
        return n

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def documents(spark, texts, extra="node string, key long, size string, digest int"):
    rows = [(i, t, f"s{i % 3}" if i and i % 4 else None, "x", 1, "y", 2) for i, t in texts]
    return spark.createDataFrame(rows, f"doc_id long, text string, source string, {extra}")


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 500)] + [(7, 7)]
    own = Sets(range(600))
    for a, b in links:
        own.join(a, b)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links + [(None, 3)], "a long, b long")).collect()}
    assert got == {n: own.find(n) for n in {x for a, b in links if a != b for x in (a, b)}}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_texts():
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = [None, "", " \n", "one", "One", "one two", "ONE two"]
    for _ in range(25):
        base = rng.choices(vocabulary, k=rng.choice([8, 30, 120]))
        for _ in range(rng.randint(1, 12)):
            own = list(base)
            for _ in range(rng.randint(0, len(base) // 12)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own))
    texts.append(" ".join(rng.choices(vocabulary, k=20_000)))
    return list(enumerate(texts)) + [(9, texts[9]), (None, "one two")]


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, width, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_X", 2)
    monkeypatch.setattr(minhash, "BLOCK_Y", 3)
    texts = near_texts()
    sets = {}
    for i, t in texts:
        w = words(t)
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    own = Sets([i for i in sets if i is not None])
    for a in own.up:
        for b in own.up:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                own.join(a, b)
    got = minhash.near_duplicates(documents(spark, texts), width=width).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.n_shingles == len(sets[r.doc_id])
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == own.find(r.doc_id) and r.kept == (own.find(r.doc_id) == r.doc_id)


def test_near_duplicates_of_nothing(spark):
    assert minhash.near_duplicates(documents(spark, [])).count() == 0


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(3)
    a, b = (rng.integers(0, 2**63, 900, dtype=np.uint64) for _ in range(2))
    b[:600] = a[:600]
    sets = [np.unique(a), np.unique(b), np.union1d(a, b)]
    one, two, both = minhash.sketch(sets)
    assert (np.maximum(one, two) == both).all()
    true = 600 / 1200
    got = minhash.estimate(one[None], two[None], np.array([len(sets[0])]), np.array([len(sets[1])]))[0]
    assert abs(got - true) < 0.15


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def word_distance(a, b):
    return edit_distance(a.split(" "), b.split(" "))


def linked(a, b, edits):
    most = min(15, min(len(a), len(b)) // 20)
    if abs(len(a) - len(b)) > max(edits, most):
        return False
    near = word_distance(a, b) <= 1
    return (near or abs(len(a) - len(b)) <= edits) and edit_distance(a, b) <= (max(edits, most) if near else edits)


def test_lines_that_differ_in_a_word(spark):
    """Every length class up to 15 edits: a word changed, put in, or taken out, at any place; and the same edits spread over two words."""
    rng = random.Random(14)
    lines = []
    for size in (18, 24, 45, 70, 110, 160, 230, 330):
        for _ in range(6):
            words_ = []
            while len(" ".join(words_)) < size:
                words_.append("".join(rng.choices("abcdefgh", k=rng.randint(1, 18))))
            lines.append(" ".join(words_))
            for _ in range(4):
                own, k = list(words_), rng.randrange(len(words_))
                change = rng.choice(["swap", "in", "out", "two", "gap"])
                if change == "in":
                    own.insert(k, "".join(rng.choices("xyz", k=rng.randint(1, 16))))
                elif change == "out":
                    own.pop(k)
                elif change == "gap":
                    own[k] += " "
                else:
                    own[k] = "".join(rng.choices("xyz", k=max(1, len(own[k]) + rng.randint(-2, 2))))
                    if change == "two":
                        own[(k + 2) % len(own)] += "q"
                lines.append(" ".join(own))
    lines = list(dict.fromkeys(lines))
    want = {(i, j) for i, a in enumerate(lines) for j, b in enumerate(lines) if i < j and min(len(a), len(b)) >= 20 and linked(a, b, 1)}
    own, degree = Sets(range(len(lines))), Counter()
    for a, b in want:
        own.join(a, b)
        degree.update([a, b])
    assert {min(15, min(len(lines[a]), len(lines[b])) // 20) for a, b in want} >= {1, 3, 5, 8, 11, 15}
    _, found = line_dedup.line_classes(documents(spark, list(enumerate(lines))))
    got = {r.doc_id: (r.n_links, r.component.doc_id) for r in found.collect()}
    assert got == {i: (degree[i], own.find(i)) for i in degree}


def test_banded_edit_distance():
    rng = random.Random(4)
    pairs = []
    for _ in range(1500):
        a = [rng.choice("abc😀") for _ in range(rng.randint(0, 40))]
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            k = rng.randint(0, len(b))
            b[k : k + rng.randint(0, 1)] = [rng.choice("abc")] * rng.randint(0, 1)
        pairs.append((a, b))
    code = lambda s: np.array([ord(c) for c in s], np.uint32)
    distances = [edit_distance(a, b) for a, b in pairs]
    for t in range(5):
        assert line_dedup.within([code(a) for a, _ in pairs], [code(b) for _, b in pairs], t).tolist() == [d <= t for d in distances]


@pytest.mark.parametrize(("edits", "crowded"), [(1, 64), (2, 1), (3, 1)])
def test_line_classes(spark, edits, crowded, monkeypatch):
    monkeypatch.setattr(line_dedup, "CROWDED", crowded)
    monkeypatch.setattr(line_dedup, "BLOCK", 4)
    rng = random.Random(5)
    lines = ["", "short"]
    for _ in range(12):
        base = [rng.choice("abcdé ") for _ in range(rng.randint(8, 30))]
        for _ in range(rng.randint(1, 5)):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                k = rng.randint(0, len(own))
                own[k : k + rng.randint(0, 1)] = [rng.choice("abc")] * rng.randint(0, 1)
            lines.append("".join(own))
    texts = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 6)))) for i in range(60)]
    texts += [(60, None), (61, ""), (None, texts[0][1]), (62, "x" * 30_000 + "\n" + "x" * 29_999)]
    first, places = {}, {}
    for i, t in texts:
        if i is not None:
            for n, line in enumerate((t or "").split("\n")):
                if line:
                    first.setdefault(line, (i, n))
                    places[i, n] = line
    own, degree, short = Sets(first.values()), Counter(), [x for x in first if 8 <= len(x) < 1000]
    pairs = [(a, b) for k, a in enumerate(short) for b in short[:k] if linked(a, b, edits)]
    pairs += [(a, b) for a in first for b in first if len(a) > len(b) > 1000]
    for a, b in pairs:
        own.join(first[a], first[b])
        degree.update([a, b])
    seen = Counter(places.values())
    want = {p: (first[x], degree[x], own.find(first[x])) for p, x in places.items() if seen[x] > 1 or degree[x]}
    docs, found = line_dedup.line_classes(documents(spark, texts), edits=edits, least_chars=8)
    got = {(r.doc_id, r.line): (tuple(r.first), r.n_links, tuple(r.component)) for r in found.collect()}
    assert got == want
    assert {r.doc_id: r.n_lines for r in docs.collect() if r.doc_id is not None} == {i: (t or "").count("\n") + 1 for i, t in texts if i is not None}
    kept = line_dedup.without_repeats(documents(spark, texts), edits=edits, least_chars=8)
    assert kept.columns == ["doc_id", "text", "source", "node", "key", "size", "digest"]
    left = {}
    for i, t in texts:
        lines_ = (t or "").split("\n")
        keep = [x for n, x in enumerate(lines_) if i is None or (i, n) not in want or want[i, n][2] == (i, n) or len(x) < 8]
        if len(keep) == len(lines_):
            left[i] = t
        elif "\n".join(keep).strip(" "):
            left[i] = "\n".join(keep)
    assert {r.doc_id: r.text for r in kept.collect()} == left
    assert line_dedup.without_repeats(documents(spark, [])).count() == 0


def embedded(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, "y") for i, v in rows], "vec_id long, embedding array<double>, node string, key long, digest string")


def vector_rows(n=400, dims=16, seed=6):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 4, dims))
    x = base[rng.integers(0, len(base), n)] + rng.normal(size=(n, dims)) * rng.choice([0, 0.05, 0.3], (n, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(n, None), (n + 1, [0.0] * dims), (n + 2, [math.nan] + [1.0] * (dims - 1)), (n + 3, [None] + [1.0] * (dims - 1)),
             (n + 4, [math.inf] * dims), (None, x[0].tolist()), (5000, [1e6] * dims), (5050, [1e6] * dims)]
    return rows


def finite(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def test_top_inner_products(spark, monkeypatch):
    monkeypatch.setattr(topk, "BUCKET", 40)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rows = vector_rows()
    good = {i: np.floor(256 * np.array(v)).astype(int) for i, v in rows if i is not None and finite(v)}
    want = set()
    for q in (i for i in good if i % 50 == 0):
        best = sorted(((-int(good[q] @ v), i) for i, v in good.items() if i != q))[:5]
        want |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    got = [tuple(r) for r in topk.top_inner_products(embedded(spark, rows)).collect()]
    assert set(got) == want and len(got) == len(want)
    assert topk.top_inner_products(embedded(spark, [])).count() == 0
    few = topk.top_inner_products(embedded(spark, [(0, [1.0, 2.0]), (1, [0.0, 0.0]), (50, [-1.0, 0.0])])).collect()
    assert {tuple(r) for r in few} == {(0, 1, 1, 0), (0, 2, 50, -65536), (50, 1, 1, 0), (50, 2, 0, -65536)}


def test_vector_near_duplicates(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD", 60)
    rows = vector_rows()
    good = {i: np.array(v, float) for i, v in rows if i is not None and finite(v) and any(v)}
    own, degree = Sets([i for i, _ in rows if i is not None]), Counter()
    for a in good:
        for b in good:
            cos = good[a] @ good[b] / np.sqrt((good[a] @ good[a]) * (good[b] @ good[b]))
            if a < b and (cos >= 0.95 or (good[a] == good[b]).all()):
                own.join(a, b)
                degree.update([a, b])
    got = vectors.near_duplicates(embedded(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.n_links, r.component_id, r.kept) == (degree[r.vec_id], own.find(r.vec_id), own.find(r.vec_id) == r.vec_id)
    assert vectors.recall(embedded(spark, rows)) >= 0.99
    assert vectors.near_duplicates(embedded(spark, [])).count() == 0


def test_language_model(spark):
    rng = random.Random(7)
    phrases = [" ".join(rng.choices([f"w{i}" for i in range(60)], k=4)) for _ in range(30)]
    texts = [(i, " ".join(rng.choices(phrases, k=rng.randint(0, 12)))) for i in range(150)] + [(150, None), (151, "Unseen WORDS"), (3, "w1 w2"), (None, "w1 w2")]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    count = Counter(w for i, t in texts if not held(i) for w in [*words(t), None])
    total, types = sum(count.values()), len(count)
    want = sorted((-1 if i is None else i, held(i), len(w), sum(count[x] > 0 for x in w), total,
                   round(sum(math.log10((count[x] + 0.5) / (total + 0.5 * (types + 1))) for x in w), 6))
                  for i, t in texts for w in [[*words(t), None]])
    out = lm.score_documents(documents(spark, texts))
    got = out.collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    # words that follow each other in training are likelier together
    unseen = [r for r in got if r.held_out and r.n_tokens > 9]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)
    assert lm.score_documents(documents(spark, [])).count() == 0


def test_very_small_and_large_components_link(spark):
    rng = np.random.default_rng(21)
    base = rng.normal(size=(4, 16))
    near = base + 1e-4 * rng.normal(size=base.shape)
    rows = [(2 * i + k, (v[i] * scale).tolist()) for i, scale in enumerate((1e-200, 1e200, 1.0, 1e-160)) for k, v in enumerate((base, near))]
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(embedded(spark, rows)).collect()}
    assert got == {i: (1, i - i % 2) for i in range(8)}


@pytest.mark.parametrize(("groups", "size"), [(10, 60), (3, 300)])
def test_large_groups_of_near_copies_are_all_searched(groups, size):
    rng = np.random.default_rng(13)
    base = rng.normal(size=(groups, 64))
    x = vectors._unit(np.concatenate([b + 0.02 * rng.normal(size=(size, 64)) for b in base] + [rng.normal(size=(3, 64))]))
    rows = vectors.build(x)
    table = np.full((len(x), max(map(len, rows))), -1)
    for i, row in enumerate(rows):
        table[i, : len(row)] = row
    found = vectors.search(x, table, 0.95)
    want = int((np.triu(x @ x.T >= 0.95, 1)).sum()) * 2
    assert sum(len(hit) for hit, _ in found) == want


def pair_scores(spark, texts):
    """((id, score) by the operator, by brute force)."""
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    tokens = {i: [*words(t), None] for i, t in texts}
    count, pairs = Counter(), Counter()
    for i, w in tokens.items():
        if not held(i):
            count.update(w)
            pairs.update(zip([None, *w], w))
    total, types = sum(count.values()), len(count)
    alone = lambda w: (count[w] + 0.5) / (total + 0.5 * (types + 1))
    share = lambda b, w: min(1, float(lm.value(lm.level(pairs[b, w]))) / count[b]) if pairs[b, w] else 0
    want = {i: sum(math.log10(0.5 * share(b, w) + 0.5 * alone(w)) for b, w in zip([None, *ws], ws)) for i, ws in tokens.items()}
    got = {r.doc_id: (r.score, r.base_score) for r in lm.score_documents(documents(spark, texts)).collect()}
    base = {i: sum(math.log10(alone(w)) for w in ws) for i, ws in tokens.items()}
    return got, {i: (want[i], base[i]) for i in want}


def close(got, want):
    """Bases are exact; scores but for pairs that the filter holds without having been filled with them."""
    assert got.keys() == want.keys()
    off = 0
    for i in want:
        assert got[i][1] == pytest.approx(want[i][1], rel=1e-12), i
        assert got[i][0] >= want[i][0] - 1e-9, i
        off += got[i][0] > want[i][0] + 1e-9
    return off


@pytest.mark.parametrize("segment_tokens", [50, 1 << 21])
def test_every_pair_counts_whatever_the_share(spark, segment_tokens, monkeypatch):
    # one common word holds nearly all tokens: a cut at a share of them loses the others
    rng = random.Random(11)
    texts = [(i, " ".join([*(["common"] * 200), f"a{i % 40}", f"b{i % 40}", *rng.choices([f"w{k}" for k in range(90)], k=5)])) for i in range(120)] + [(120, None)]
    monkeypatch.setattr(lm.score_documents, "__defaults__", ("doc_id", "text", segment_tokens))
    assert close(*pair_scores(spark, texts)) <= 15


def test_pairs_of_rare_words_count(spark):
    rng = random.Random(12)
    # fixed pairs of rare words, frequent words before rare ones, and the other way round
    parts = [f"x{k} y{k}" for k in range(80)] + [f"the z{k}" for k in range(40)] + [f"z{k} of" for k in range(40)] + ["of the"] * 30
    texts = [(i, " ".join(rng.choices(parts, k=rng.randint(0, 30)))) for i in range(150)]
    assert close(*pair_scores(spark, texts)) <= 15


def test_filter_levels():
    rng = np.random.default_rng(8)
    keys = rng.integers(0, 2**63, 20_000, dtype=np.uint64)
    counts = np.where(rng.random(len(keys)) < 0.7, 1, rng.integers(1, 3000, len(keys)))
    levels = lm.level(counts)
    assert (levels[counts <= 4] == counts[counts <= 4]).all() and (np.diff(lm.level(np.arange(10_000))) >= 0).all()
    assert np.abs(lm.value(levels) / counts - 1).max() < 0.12
    bits = lm.fill(keys, counts)
    found = lm.probe(bits, keys)
    assert (found >= levels).all() and (found == levels).mean() > 0.99
    assert (lm.probe(bits, rng.integers(0, 2**63, 20_000, dtype=np.uint64)) > 0).mean() < 0.01
    assert (lm.probe(lm.fill(keys[:0], counts[:0]), keys) == 0).all()


def test_apportionment_is_sainte_lague(spark):
    rng = random.Random(9)
    for seats in (0, 1, 7, 100, 1013):
        shares = [(k, rng.choice([0.0, 0.3, 1.0, 2.5, 40.0, 700.0]) * rng.random()) for k in range(12)] + [(12, None), (13, 1.0), (14, 1.0)]
        df = spark.createDataFrame([(1, k, s, seats) for k, s in shares], "g int, k int, s double, seats long")
        got = {r.k: r.n for r in mixing.apportion(df, ["g"], "k", "s", "seats", "n").collect()}
        want = Counter()
        for _ in range(seats):
            want[max((k for k, s in shares if s), key=lambda k: (shares[k][1] / (2 * want[k] + 1), -k))] += 1
        assert got == {k: want[k] for k, _ in shares}


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left, capped = dict.fromkeys(names, 0.0), float(sum(sizes.values())), set()
    while True:
        open_ = [s for s in names if s not in capped]
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] = left * weight[s] / total
        over = [s for s in open_ if target[s] > most * sizes[s]]
        if not over:
            return target
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
            capped.add(s)


def test_mixing(spark):
    rng = random.Random(10)
    texts = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 200, 900]))) for i in range(300)] + [(300, None), (301, ""), (3, "a b"), (None, "a b c")]
    docs = documents(spark, texts).withColumn("source", F.when(F.col("doc_id") < 150, "hot").when(F.col("doc_id") < 160, "small").otherwise(F.col("source")))
    mixed = mixing.mix_sources(docs, shards=8, block_words=16)
    got = mixed.collect()
    assert len(got) == len(texts)
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source] += len(words(r.text))
    targets = brute_targets(sizes)
    assert {(r.source_size, round(r.target, 6)) for r in got} == {(sizes[s], round(t, 6)) for s, t in targets.items()}
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source_size] += r.taken
    for s, target in targets.items():
        assert abs(taken[sizes[s]] - target) <= 0.02 * target + 64
    again = mixing.mix_sources(docs.repartition(3), shards=8, block_words=16).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    joined = mixed.join(docs.select("doc_id", "text"), "doc_id").where("doc_id <> 3")
    assert joined.where(mixing.word_count(mixing.mixed_text(F.col("text"))) != F.col("taken")).count() == 0
    assert mixing.mix_sources(documents(spark, [])).count() == 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, folder, name):
    ok, message = compare(spark, connect(folder), Query(name, QUERIES[name], SQL[name]), folder)
    assert ok, message


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_a_row_per_document(spark, folder, name):
    out = QUERIES[name](spark, folder)
    assert out.count() == spark.read.parquet(f"{folder}/documents.parquet").count() and "doc_id" in out.columns
