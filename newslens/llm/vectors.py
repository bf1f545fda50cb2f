"""Embedding near-duplicates by a robust-pruned flat graph.

Equal vectors are one node. Nodes are dealt to the shards of their nearest cluster centers
(overlapping), crowded shards into parts of bounded size. Each part builds its graph:
a node's nearest neighbours, robustly pruned so that edges point in different directions,
with reverse edges. The adjacency lists of all parts are united per node. Searches start at a
medoid of each piece of a part and follow united edges greedily; once inside the range they expand through
every neighbour in range. What they find is verified in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from newslens.llm.graph import components, store
from newslens.session import materialize

#: Vectors (expected) that the cluster centers are fitted on, aimed-at nodes of a shard, shards of a node.
SAMPLE, SHARD, OVERLAP = 20_000, 400, 3
#: Most centers; beyond it shards are cut into more parts.
MOST_CENTERS = 2048
#: Neighbours before and after pruning, slack of the pruning rule, beam of the search.
NEAREST, DEGREE, ALPHA, BEAM = 48, 16, 1.2, 24
#: Nodes of a beam that are opened at once.
OPEN = 4
#: Neighbours this far below the range are still followed.
SLACK = 0.05


def usable(vector: Column) -> Column:
    """Not null, no null, infinite or missing number in it, and not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def centers(sample: np.ndarray, k: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Spherical k-means on unit vectors."""
    found = sample[np.random.default_rng(seed).choice(len(sample), k, replace=False)].copy()
    for _ in range(rounds):
        nearest = np.concatenate([np.argmax(p @ found.T, axis=1) for p in np.array_split(sample, len(sample) // 4096 + 1)])
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, sample)
        norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        found = np.where(norm > 0, sums / np.maximum(norm, 1e-12), found)
    return found


def build(x: np.ndarray) -> list[np.ndarray]:
    """Adjacency of a part: nearest neighbours, robustly pruned, and their reverse edges pruned again."""
    n = len(x)
    if n == 1:
        return [np.zeros(0, np.int64)]
    near = min(NEAREST, n - 1)
    lists = np.empty((n, near), np.int64)
    for rows in np.array_split(np.arange(n), n // 512 + 1):
        cos = x[rows] @ x.T
        cos[np.arange(len(rows)), rows] = -2
        top = np.argpartition(-cos, near - 1, axis=1)[:, :near]
        order = np.argsort(-np.take_along_axis(cos, top, axis=1), axis=1, kind="stable")
        lists[rows] = np.take_along_axis(top, order, axis=1)
    forward = _prune(x, [row for row in lists])
    back: list[list[int]] = [[] for _ in range(n)]
    for i, row in enumerate(forward):
        for j in row:
            back[j].append(i)
    both = []
    for i in range(n):
        merged = np.unique(np.concatenate([forward[i], np.array(back[i], np.int64)]))
        both.append(merged[np.argsort(-(x[merged] @ x[i]), kind="stable")])
    return _prune(x, both, most=2 * DEGREE)


def _prune(x: np.ndarray, lists: list[np.ndarray], most: int = DEGREE) -> list[np.ndarray]:
    """Keep the nearest candidate, drop those it is ``ALPHA`` times closer to than the node is, and so on."""
    out = []
    for i, row in enumerate(lists):
        angle = np.arccos(np.clip(x[row] @ x[i], -1, 1))
        between = ALPHA * np.arccos(np.clip(x[row] @ x[row].T, -1, 1))
        left, kept = np.ones(len(row), bool), []
        for j in range(len(row)):
            if left[j]:
                kept.append(j)
                if len(kept) == most:
                    break
                left &= between[j] > angle
        out.append(row[kept])
    return out


def pieces(x: np.ndarray, table: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """(members, start) of what edges reach from a medoid, then from a medoid of the rest, and so on.

    Every node is in one piece, and is reached from its start within it.
    """
    left, out = np.ones(len(x), bool), []
    while left.any():
        at = np.flatnonzero(left)
        start = int(at[np.argmax(x[at] @ x[at].mean(axis=0))])
        members, edge = [], np.array([start])
        while len(edge):
            left[edge] = False
            members.append(edge)
            next_ = np.unique(table[edge])
            next_ = next_[next_ >= 0]
            edge = next_[left[next_]]
        out.append((np.sort(np.concatenate(members)), start))
    return out


def search(x: np.ndarray, table: np.ndarray, range_: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every node, those found in range: (places, cosines). ``table`` holds neighbours, -1 for none.

    A part of large groups of near copies falls into pieces that no edge joins; each is searched.
    """
    n, parts = len(x), []
    for members, start in pieces(x, table):
        number = np.full(n + 1, -1)  # the last stands for no neighbour
        number[members] = np.arange(len(members))
        parts.append((members, x[members], number[table[members]], int(number[start])))
    found = []
    for rows in np.array_split(np.arange(n), n // 256 + 1):
        cos = np.full((len(rows), n), -2.0)
        for members, own, edges, start in parts:
            cos[:, members] = _looked(x[rows], own, edges, start, range_)
        for i, row in enumerate(rows):
            hit = np.flatnonzero(cos[i] >= range_)
            hit = hit[hit != row]
            found.append((hit, cos[i, hit]))
    return found


def _looked(q: np.ndarray, x: np.ndarray, table: np.ndarray, start: int, range_: float) -> np.ndarray:
    """Cosines (queries x nodes) of the nodes that the search from ``start`` meets, -2 of others."""
    m, n, beam = len(q), len(x), min(BEAM, len(x))
    seen = np.zeros((m, n), bool)
    cos = np.full((m, n), -2.0, np.float64)
    seen[:, start] = True
    cos[:, start] = q @ x[start]
    opened = np.zeros((m, n), bool)
    best = np.full((m, beam), -1)
    best[:, 0] = start
    while True:
        # the best nodes of each beam that were not opened yet, and all that lie in range
        at = np.where(best >= 0, best, 0)
        value = np.where((best >= 0) & ~np.take_along_axis(opened, at, axis=1), np.take_along_axis(cos, at, axis=1), -3)
        pick = np.argpartition(-value, OPEN - 1, axis=1)[:, :OPEN] if beam > OPEN else np.broadcast_to(np.arange(beam), (m, beam))
        who, place = np.nonzero(np.take_along_axis(value, pick, axis=1) > -3)
        node = best[who, pick[who, place]]
        inside, wide = np.nonzero((cos >= range_ - SLACK) & ~opened)
        who, node = np.concatenate([who, inside]), np.concatenate([node, wide])
        if not len(who):
            break
        opened[who, node] = True
        next_ = table[node]
        who, next_ = np.repeat(who, next_.shape[1]), next_.reshape(-1)
        fresh = (next_ >= 0) & ~seen[who, next_]
        who, next_ = who[fresh], next_[fresh]
        if len(who):
            pair = np.unique(who * n + next_)
            who, next_ = pair // n, pair % n
            seen[who, next_] = True
            cos[who, next_] = (q[who] * x[next_]).sum(axis=1)
            touched = np.unique(who)
            if beam < n:
                best[touched] = np.argpartition(-cos[touched], beam - 1, axis=1)[:, :beam]
            else:
                best[touched] = np.arange(n)
            best[touched] = np.where(np.take_along_axis(seen[touched], best[touched], axis=1), best[touched], -1)
    return cos


def _nodes(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows: vec_id, digest; nodes: node, copies, vector as bytes). Rows without a usable vector have no digest."""
    source = vectors.select(F.col(id_col).alias("vec_id"), F.when(usable(F.col(vector_col)), F.col(vector_col).cast("array<double>")).alias("v"))
    id_type = dict(source.dtypes)["vec_id"]

    def run(batches):
        for b in batches:
            packed = [None if v is None else np.array(v, "<f8").tobytes() for v in b.column(1).to_pylist()]
            digests = [None if p is None else xxhash.xxh3_128_digest(p) for p in packed]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(digests, pa.binary()), pa.array(packed, pa.binary())],
                                             names=["vec_id", "digest", "vector"])

    rows = materialize(source.mapInArrow(run, f"vec_id {id_type}, digest binary, vector binary"), "vectors")
    whole = rows.where("digest is not null and vec_id is not null")
    classes = materialize(whole.groupBy("digest").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")), "classes")
    nodes = whole.join(classes, "digest").where("vec_id = node").select("node", "copies", "digest", "vector").dropDuplicates(["node"])
    return rows, materialize(nodes, "nodes")


def _parts(nodes: DataFrame) -> DataFrame:
    """(part, shard, node, vector): every node in the parts of its nearest shards.

    A shard of more than twice the aimed-at size is cut by a hash of the node. Each of its
    parts meets every other, in pairs, so that no two of its nodes are kept apart.
    """
    n = nodes.count()
    sample = nodes.where(F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1 << 30)) < int(min(1.0, SAMPLE / max(n, 1)) * (1 << 30)))
    sample = sample.select("node", "vector").toArrow().sort_by("node")
    k = int(min(max(1, n // SHARD), MOST_CENTERS, max(1, sample.num_rows // 8)))
    fitted = centers(_unit(_matrix(sample["vector"])), k) if sample.num_rows else None
    shared = nodes.sparkSession.sparkContext.broadcast(fitted)
    near = min(OVERLAP, k)

    def run(batches):
        for b in batches:
            x = _unit(_matrix(b.column(1)))
            cos = x @ shared.value.T if shared.value is not None else np.zeros((len(x), 1))
            top = np.argsort(-cos, axis=1, kind="stable")[:, :near]
            take = np.repeat(np.arange(len(x)), near)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(take)), pa.array(top.reshape(-1)), b.column(1).take(pa.array(take))],
                                             names=["node", "shard", "vector"])

    id_type = dict(nodes.dtypes)["node"]
    dealt = materialize(nodes.select("node", "vector").mapInArrow(run, f"node {id_type}, shard bigint, vector binary"), "dealt")
    sizes = store(dealt.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / (2 * SHARD)).cast("int").alias("cuts")), "cuts")
    cut = F.pmod(F.xxhash64("node", F.lit(4)), F.col("cuts")).cast("int")
    dealt = dealt.join(sizes, "shard").withColumn("cut", cut)
    other = F.sequence(F.lit(0), F.col("cuts") - 1)
    dealt = dealt.withColumn("other", F.explode(other))
    # one part for each pair of cuts; a shard that is not cut has the part (0, 0) alone
    dealt = dealt.where((F.col("other") != F.col("cut")) | (F.col("cuts") == 1))
    return dealt.select("shard", F.least("cut", "other").alias("low"), F.greatest("cut", "other").alias("high"), "node", "vector")


def links(nodes: DataFrame, cosine: float) -> DataFrame:
    """(a, b): pairs of nodes found with at least that cosine, each once, a < b."""
    parts = store(_parts(nodes), "parts")
    keys = ["shard", "low", "high"]
    id_type = dict(nodes.dtypes)["node"]

    def graph(table: pa.Table) -> pa.Table:
        table = table.sort_by("node").combine_chunks()
        ids, rows = table["node"].to_numpy(), build(_unit(_matrix(table["vector"])))
        at = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        near = ids[np.concatenate(rows)] if at[-1] else ids[:0]
        return pa.table({"node": table["node"], "near": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(near))})

    lists = parts.groupBy(*keys).applyInArrow(graph, f"node {id_type}, near array<{id_type}>")
    # a node is in a bounded number of parts unless its shard is crowded
    united = store(lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "united")

    def look(table: pa.Table) -> pa.Table:
        table = table.sort_by("node").combine_chunks()
        ids, x = table["node"].to_numpy(), _unit(_matrix(table["vector"]))
        near = [np.array(row, np.int64) for row in table["near"].to_pylist()]
        place = [np.searchsorted(ids, row) for row in near]
        place = [p[(p < len(ids)) & (ids[np.minimum(p, len(ids) - 1)] == row)] for p, row in zip(place, near)]
        edges = np.full((len(ids), max(1, max(map(len, place)))), -1)
        for i, p in enumerate(place):
            edges[i, : len(p)] = p
        found = search(x, edges, cosine - 1e-9)
        a = np.repeat(np.arange(len(ids)), [len(f[0]) for f in found])
        b = np.concatenate([f[0] for f in found]) if found else a
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
        # on vectors of length 1, as products of very small or large components leave the range
        pairs = pairs[(x[pairs[:, 0]] * x[pairs[:, 1]]).sum(axis=1) >= cosine]
        return pa.table({"a": pa.array(ids[pairs[:, 0]]), "b": pa.array(ids[pairs[:, 1]])})

    found = parts.join(united, "node").groupBy(*keys).applyInArrow(look, f"a {id_type}, b {id_type}")
    return store(found.distinct(), "links")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors linked directly), component_id, kept.

    Two vectors link if the search finds them and their cosine is at least ``cosine``; equal
    vectors always do. Vectors that are null, zero, or hold null or non-finite numbers link with
    nothing: they are their own component, and kept. Copies are counted, not expanded. Null
    ids take no part. Vectors must have one length. Other columns are left out; an empty
    table gives no rows.
    """
    rows, nodes = _nodes(vectors, id_col, vector_col)
    found = links(nodes, cosine)
    copies = nodes.select("node", "copies")
    ends = found.union(found.select("b", "a")).toDF("node", "other")
    beside = ends.join(copies.withColumnsRenamed({"node": "other", "copies": "n"}), "other").groupBy("node").agg(F.sum("n").alias("near"))
    joined = components(found)
    of = nodes.join(beside, "node", "left").join(joined, "node", "left").select(
        F.col("digest").alias("_digest"), (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"),
        F.coalesce("component", "node").alias("component"))
    whole = rows.join(of, (F.col("digest") == F.col("_digest")) & F.col("vec_id").isNotNull(), "left")
    component = F.coalesce("component", "vec_id")
    return whole.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def recall(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95, sample: int = 500) -> float:
    """Audit: the share of the links of about ``sample`` nodes, by brute force, that ``links`` finds.

    The sampled nodes are compared with all others, in the batches in which these are read.
    """
    _, nodes = _nodes(vectors, id_col, vector_col)
    n = nodes.count()
    rows = nodes.where(F.pmod(F.xxhash64("node", F.lit(9)), F.lit(1 << 30)) < int(min(1.0, sample / max(n, 1)) * (1 << 30))).toArrow()
    shared = nodes.sparkSession.sparkContext.broadcast((rows["node"].to_numpy(), _unit(_matrix(rows["vector"]))))
    id_type = dict(nodes.dtypes)["node"]

    def run(batches):
        for b in batches:
            ids, x = shared.value
            i, j = np.nonzero(_unit(_matrix(b.column(1))) @ x.T >= cosine)
            one, two = b.column(0).to_numpy()[i], ids[j]
            keep = one != two
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(one, two)[keep]), pa.array(np.maximum(one, two)[keep])], names=["a", "b"])

    true = nodes.select("node", "vector").mapInArrow(run, f"a {id_type}, b {id_type}").distinct()
    total, hit = true.join(links(nodes, cosine).withColumn("hit", F.lit(1)), ["a", "b"], "left").agg(F.count(F.lit(1)), F.count("hit")).first()
    return hit / total if total else 1.0
