"""The conversation trie, ranked search and chunked BPE against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newslens.llm import chunk_bpe, ranked, trie
from newslens.llm.queries import QUERIES, SQL, WORD_VOCABULARY
from newslens.plans.registry import Query
from tests.compare import compare, connect


def conversations(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(230), n):
        length = rng.choice([1, 1, 2, 3, 5, 8, 13])
        for t in range(length):
            rows.append((c, t if t else None, rng.choice(["user", "user", None]), rng.choice(["a", "bé", "", None])))
    long = [(500 + k, t, "user", "x" if t < 30 + 2 * k else f"y{k}") for k in range(3) for t in range(40)]
    return rows + long + [(None, 1, "user", "lost")]


def brute_trie(rows):
    original = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            original[c].append(((t is not None, t or 0), role or "", text or ""))
    turns = {c: [x[1:] for x in sorted(own, key=lambda x: x[0])] for c, own in original.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = turns.get(c - c % 100, [])[:h] + turns[c][h:]
    members = defaultdict(list)
    for c, own in sorted(built.items()):
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    out = []
    for p, own in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = ",".join(str(c) for c in own if len(built[c]) == len(p))
        out.append((own[0], len(p), members[p[:-1]][0] if p else None, len(own), kids[p], sum(not kids[q] for q in below),
                    sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("width", "shard_rows"), [(3, 5), (64, 40), (2, 10_000)])
def test_prefix_trie(spark, width, shard_rows):
    rows = conversations(90)
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, pos string, n long").repartition(7)
    got = trie.prefix_trie(*trie.rebuild(trie.number_turns(turns)), width=width, shard_rows=shard_rows)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_trie(rows)


def test_trie_of_copies_and_of_nothing(spark):
    """One conversation many times: every node spans all shards."""
    rows = [(c * 7, t, "user", f"t{t}") for c in range(300) for t in range(6)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = trie.prefix_trie(*trie.rebuild(trie.number_turns(turns)), width=4, shard_rows=20)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_trie(rows)
    assert trie.prefix_trie(*trie.rebuild(trie.number_turns(turns.where("conv_id < 0")))).count() == 0


def test_numbers_over_ranges(spark):
    """A conversation that is cut into several ranges, with equal turns."""
    rows = [(c, t // 2, "user", str(t)) for c, n in ((1, 400), (2, 3), (3, 900)) for t in range(n)]
    got = defaultdict(list)
    for r in trie.number_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect():
        got[r.conv_id].append(r.pos)
    assert {c: sorted(p) for c, p in got.items()} == {1: list(range(1, 401)), 2: [1, 2, 3], 3: list(range(1, 901))}


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_ranked(docs, items, best):
    own = [(d, terms(t)) for d, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in own), sum(len(t) for _, t in own)
    df = Counter(x for _, t in own for x in set(t))
    out = []
    for item in {i for i, _ in items}:
        wanted = {x for i, t in items if i == item for x in terms(t)}
        scores = []
        for d, t in own:
            m = 50 + (50 * len(t) * n_docs) // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((10**9 * c) // (1000 * c + 20 * m)) for x, c in Counter(t).items() if x in wanted)
            if score > 0:
                scores.append((-score, d is None, d))
        out += [(item, k, d, -s) for k, (s, _, d) in enumerate(sorted(scores, key=str if False else lambda x: (x[0], x[1], x[2] or 0))[:best], 1)]
    return sorted(out, key=str)


def ranked_documents(seed=2):
    rng = random.Random(seed)
    words = ["the", "Of", "é1", "Straße", *(f"w{i}" for i in range(300))]
    weights = [300, 200, 50, 20, *(100 / (i + 1) for i in range(300))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.choice([1, 5, 40, 200])))) for i in range(500)]
    docs += [(1000 + i, docs[7][1]) for i in range(60)] + [(2000, None), (2001, ""), (2002, "-- !"), (3, "the w1"), (None, docs[7][1]), (2003, "of " * 30_000)]
    items = [(i, ", ".join(rng.choices(words, k=12))) for i in range(12)] + [(20, docs[7][1]), (21, None), (22, "nowhere"), (23, "the THE of"), (0, "straße")]
    return docs, items


@pytest.mark.parametrize("passes", [False, True])
def test_ranked_search(spark, passes, monkeypatch):
    if passes:
        monkeypatch.setattr(ranked, "MOST_PAIRS", 40)
    docs, items = ranked_documents()
    table = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], "doc_id long, text string, score string, rank long, item long").repartition(5)
    got = ranked.best_documents(table, spark.createDataFrame([(*i, 1.0) for i in items], "item_id long, text string, ids double"), best=9)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_ranked(docs, items, 9)


def test_ranked_search_of_nothing(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert ranked.best_documents(docs, spark.createDataFrame([(1, "a")], items.schema)).count() == 0
    assert ranked.best_documents(spark.createDataFrame([(1, "a")], docs.schema), items).count() == 0


def test_search_of_a_block(monkeypatch):
    """Any stride, share of short lists and starting threshold give the best documents, ties included."""
    rng = np.random.default_rng(3)
    for k in range(200):
        monkeypatch.setattr(ranked, "STRIDE", int(rng.integers(3, 60)))
        monkeypatch.setattr(ranked, "SHORT", int(rng.choice([1, 3, 16, 1000])))
        size, lists, slots, times = int(rng.integers(1, 200)), [], [], []
        norm = rng.integers(50, 60, size)
        full = np.zeros(size, np.int64)
        for _ in range(int(rng.integers(1, 9))):
            own = np.flatnonzero(rng.random(size) < rng.random() ** 2)
            if len(own):
                w, n = int(rng.integers(1, 4000)), rng.integers(1, 4, len(own))
                lists.append((w, sum(map(len, slots)), sum(map(len, slots)) + len(own)))
                slots.append(own)
                times.append(n)
                full[own] += ranked.gains(w, n, norm[own])
        least, best = int(rng.choice([1, np.median(full) + 1])), int(rng.integers(1, 12))
        at, scores = ranked.search_block(lists, np.concatenate([np.zeros(0, np.int64), *slots]), np.concatenate([np.zeros(0, np.int64), *times]), norm, least, best)
        assert (full[at] == scores).all()
        rank = lambda rows: sorted((-full[i], i) for i in rows if full[i] >= least)[:best]
        assert rank(at.tolist()) == rank(range(size))


def chunked_texts(seed=4):
    rng = random.Random(seed)
    odd = ["don't", "we'LL", "İstanbul", "café", "Σας", "<|endoftext|>", "x<|startoftext|>y", "<|ENDOFTEXT|>", "12345", "…!?", "漢字", "한국어", "😀", " ", "ﬁ", "́"]
    word = lambda: rng.choice(odd) if rng.random() < 0.2 else "".join(rng.choices("abcdefghijABCD", k=rng.randint(1, 9)))
    passages = [rng.choice([" ", "\n", "  ", "\t"]).join(word() for _ in range(400)) for _ in range(5)]
    texts = [None, "", " ", "a", "<|endoftext|>", "漢" * 9000, "ab" * 20_000]
    for _ in range(120):
        texts.append(" ".join(rng.choice([rng.choice(passages), word(), " ".join(word() for _ in range(rng.randint(1, 200)))]) for _ in range(rng.randint(1, 5))))
    return texts + texts[20:30] * 3


def test_chunked_bpe(spark):
    path, texts = public_tokenizers.path(WORD_VOCABULARY), chunked_texts()
    docs = spark.createDataFrame([(i if i % 7 else 7, t, "x", 1, "y") for i, t in enumerate(texts)], "doc_id long, text string, ids string, key long, _fetched string").repartition(3)
    library = Tokenizer.from_file(path)
    want = []
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i if i % 7 else 7, t, 1, "y", ids, library.decode(ids, skip_special_tokens=False)))
    got = chunk_bpe.encode_documents(docs, path)
    assert got.columns == ["doc_id", "text", "key", "_fetched", "ids", "decoded"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    digests = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in chunk_bpe.encode_digests(docs, path).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert digests == {(i, len(ids), sha(" ".join(map(str, ids))), sha(out)) for i, _, _, _, ids, out in want}
    assert chunk_bpe.encode_documents(docs.where("doc_id < 0"), path).count() == 0


def test_chunks_are_cut_by_content():
    rng = random.Random(5)
    passage = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(2000)).encode()
    cuts = []
    for before in (b"", b"some other words before " * 9):
        data = np.frombuffer(before + passage, np.uint8)
        cuts.append(set((chunk_bpe.cut_places(data, np.array([0, len(data)])) - len(before)).tolist()))
    inside = {c for c in cuts[0] if c > 2000}
    assert len(inside) > 5 and inside <= cuts[1]


class Pairs:
    """Joins equal neighbouring bytes two by two from the left of a run: where a run of them begins decides the ids."""

    kind = np.dtype("<u2")

    def encode(self, data, starts, sizes):
        out = []
        for a, n in zip(starts.tolist(), sizes.tolist()):
            out.append(np.array([ord(m[0][0]) * len(m[0]) for m in re.finditer(r"(.)\1|.", bytes(data[a : a + n]).decode(), re.S)], np.uint16))
        return np.concatenate([np.zeros(0, np.uint16), *out]), np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int64)


def test_windows_grow_until_they_agree():
    """Ids that depend on far neighbours: cuts move their windows out, or go."""
    rng = random.Random(6)
    text = "".join(rng.choice(["ab ", "a a ", " " * 7, "bbb ", "c ", " " * 60, "dddd "]) for _ in range(3000)).encode()
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, 5000, 5000, len(text)])
    want, at = Pairs().encode(data, offsets[:-1], np.diff(offsets))
    got = chunk_bpe.encode_texts(data, offsets, Pairs(), {})
    assert [x.tolist() for x in got] == [want[a:b].tolist() for a, b in zip(at, at[1:])]


@pytest.mark.parametrize("name", ["op11_trie", "op12_ranked"])
def test_sql(spark, folder, name):
    ok, message = compare(spark, connect(folder), Query(name, QUERIES[name], SQL[name]), folder)
    assert ok, message


def test_op13_over_the_table(spark, folder):
    library = Tokenizer.from_file(public_tokenizers.path(WORD_VOCABULARY))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()}
    rows = QUERIES["op13_chunks"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
