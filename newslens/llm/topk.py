"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped into buckets of similar length. A query's k-th best score so far, over its
own length and the bucket's greatest, is the least cosine a vector of the bucket must have:
above 1 the bucket is skipped; near it, few vectors are long enough and a scan by length
stops early; below it, bounds on the query's largest coordinate leave out vectors that point
elsewhere. What remains is multiplied out in integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from newslens.llm.graph import store
from newslens.session import materialize

#: Vectors of a bucket (expected) and queries of a block.
BUCKET, QUERIES = 4096, 256
#: Buckets of the greatest lengths that give each query its first bound.
FIRST = 1
#: From this local cosine on a bucket is pruned by length, below it by coordinate.
BY_LENGTH = 0.9


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v: floor(scale * x) as int32 bytes, length) of the usable vectors; zero vectors take part."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    source = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~bad)

    def run(batches):
        for b in batches:
            rows = [np.floor(scale * np.array(x, np.float64)).astype("<i8") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([r.tobytes() for r in rows], pa.binary()),
                pa.array([float(np.sqrt((r.astype(np.float64) ** 2).sum())) for r in rows])], names=["vec_id", "v", "length"])

    return source.mapInArrow(run, "vec_id bigint, v binary, length double")


def _rows(column) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<i8").reshape(len(rows), -1)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= cut)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def search_bucket(q_ids, q, q_length, bound, ids, v, length, k):
    """Per query (place, places of hits, scores): every vector that may be among the k best, at most k of them.

    ``bound`` is a score that k other vectors are known to reach; -inf if none is.
    """
    order = np.argsort(-length, kind="stable")
    ids, v, length = ids[order], v[order], length[order]
    unit = v / np.maximum(length, 1e-12)[:, None]
    longest = length[0]
    exact = np.abs(v).max(initial=0) * np.abs(q).max(initial=0) * max(1, v.shape[1]) < 2**53
    floats = v.astype(np.float64) if exact else None
    # vectors by their value of each coordinate, sorted when a query first asks for it
    by_coordinate: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for i in range(len(q)):
        reach = q_length[i] * longest
        cosine = bound[i] / reach if reach > 0 else (-np.inf if bound[i] <= 0 else np.inf)
        cosine -= 1e-9 if np.isfinite(cosine) else 0
        if cosine > 1:
            continue
        if cosine <= 0 or q_length[i] == 0:
            places = np.arange(len(ids))
        elif cosine >= BY_LENGTH:
            # longest first: shorter ones cannot reach the bound even in the query's direction
            places = np.arange(np.searchsorted(-length, -(bound[i] / q_length[i]) * (1 - 1e-9), "right"))
        else:
            # with the focus coordinate f of the unit query, cos <= f * x + sqrt(1 - f^2) * sqrt(1 - x^2)
            focus = int(np.argmax(np.abs(q[i])))
            f = q[i, focus] / q_length[i]
            if focus not in by_coordinate:
                by = np.argsort(unit[:, focus], kind="stable")
                by_coordinate[focus] = by, unit[by, focus]
            by, values = by_coordinate[focus]
            spread = np.sqrt(max(0.0, (1 - f * f) * (1 - cosine * cosine)))
            low = f * cosine - spread if f * f < 1 else cosine
            high = f * cosine + spread
            # the allowed range reaches to the end if the query itself points there
            low = -1.0 if -f >= cosine else low
            high = 1.0 if f >= cosine else high
            places = by[np.searchsorted(values, low - 1e-9) : np.searchsorted(values, high + 1e-9, "right")]
        places = places[ids[places] != q_ids[i]]
        if not len(places):
            continue
        scores = floats[places] @ q[i].astype(np.float64) if exact else v[places] @ q[i]
        scores = scores.astype(np.int64)
        keep = scores >= bound[i]
        places, scores = places[keep], scores[keep]
        top = _best(scores, ids[places], k)
        yield i, ids[places[top]], scores[top]


def _search(blocks: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score) from rows (block, bucket, is_query, vec_id, v, length, bound)."""

    def run(table: pa.Table) -> pa.Table:
        asks = table["is_query"].to_numpy()
        pick = lambda flag: table.filter(pa.array(flag))
        q, x = pick(asks), pick(~asks)
        out: list[list] = [[], [], []]
        if q.num_rows and x.num_rows:
            q_ids = q["vec_id"].to_numpy()
            bound = q["bound"].to_numpy(zero_copy_only=False).astype(np.float64)
            bound = np.where(np.isnan(bound), -np.inf, bound)
            for i, ids, scores in search_bucket(q_ids, _rows(q["v"]), q["length"].to_numpy(), bound,
                                                x["vec_id"].to_numpy(), _rows(x["v"]), x["length"].to_numpy(), k):
                out[0] += [int(q_ids[i])] * len(ids)
                out[1] += ids.tolist()
                out[2] += scores.tolist()
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), out)})

    return blocks.groupBy("block", "bucket").applyInArrow(run, "query_id bigint, vec_id bigint, score bigint")


def _blocks(queries: DataFrame, rows: DataFrame, buckets: DataFrame, n_blocks: int) -> DataFrame:
    """Every block of queries with every bucket that one of them has still to search."""
    block = F.pmod(F.xxhash64("vec_id", F.lit(6)), F.lit(n_blocks))
    asked = queries.withColumn("block", block).withColumn("is_query", F.lit(True))
    met = asked.select("block", "vec_id", "v", "length", "bound", "is_query", F.explode("buckets").alias("bucket"))
    pairs = met.select("block", "bucket").distinct()
    held = rows.join(pairs, "bucket").select(
        "block", "vec_id", "v", "length", F.lit(None).cast("bigint").alias("bound"), F.lit(False).alias("is_query"), "bucket")
    return met.unionByName(held)


def top_inner_products(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, every: int = 50, scale: int = 256,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer inner products, ties to the smaller id.

    Components become floor(``scale`` * x). Queries are the rows whose id is divisible by ``every``;
    candidates are all rows but the query's own id. Vectors that are null, or hold null or
    non-finite numbers, and rows with a null id take no part; a zero vector scores 0. Vectors
    must have one length. Fewer candidates than k give fewer rows, none gives none. Of rows that
    repeat an id, one with each distinct vector takes part. Other columns are left out.
    """
    stored = materialize(quantised(vectors, id_col, vector_col, scale).distinct(), "quantised")
    n = stored.count()
    n_buckets = max(1, -(-n // BUCKET))
    # equal lengths may fill a bucket: a part number keeps each below twice the aimed-at size
    edges = stored.agg(F.percentile_approx("length", [i / n_buckets for i in range(1, n_buckets)], 100 * n_buckets)).first()[0] if n_buckets > 1 else []
    edges = F.array(*map(F.lit, sorted(set(edges or [])))) if edges else F.array().cast("array<double>")
    ranked = stored.withColumn("group", F.size(F.filter(edges, lambda e: e < F.col("length"))))
    sizes = store(ranked.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / (2 * BUCKET)).cast("int").alias("parts")), "groups")
    rows = ranked.join(sizes, "group").withColumn(
        "bucket", F.struct("group", F.pmod(F.xxhash64("vec_id", F.lit(5)), F.col("parts")).cast("int").alias("part"))).drop("parts", "group")
    rows = materialize(rows, "buckets")
    buckets = store(rows.groupBy("bucket").agg(F.max("length").alias("longest"), F.count(F.lit(1)).alias("n")), "bounds")
    queries = rows.where(F.col("vec_id") % every == 0).drop("bucket")
    n_blocks = max(1, -(-n // (every * QUERIES)))
    listed = F.broadcast(buckets.agg(F.sort_array(F.collect_list(F.struct("longest", "bucket")), asc=False).alias("all")))  # one row, an entry per bucket
    queries = queries.crossJoin(listed).withColumn("first", F.slice("all", 1, FIRST))
    start = queries.select("vec_id", "v", "length", F.lit(None).cast("bigint").alias("bound"), F.transform("first", lambda b: b["bucket"]).alias("buckets"))
    found = store(_search(_blocks(start, rows, buckets, n_blocks), k), "first")
    per_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    bounds = found.withColumn("r", F.row_number().over(per_query)).where(F.col("r") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("bound"))
    rest = queries.join(bounds, "vec_id", "left").withColumn("rest", F.slice("all", FIRST + 1, F.greatest(F.size("all") - FIRST, F.lit(1))))
    open_ = F.filter("rest", lambda b: F.col("bound").isNull() | (b["longest"] * F.col("length") * (1 + 1e-9) >= F.col("bound")))
    rest = rest.select("vec_id", "v", "length", "bound", F.transform(open_, lambda b: b["bucket"]).alias("buckets"))
    found = found.unionByName(_search(_blocks(rest, rows, buckets, n_blocks), k)).distinct()
    best = found.withColumn("rank", F.row_number().over(per_query)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
