"""Near-duplicate documents by SetSketch registers.

A document's set holds the hashes of its word shingles. Its sketch has M registers; every
element contributes one exponentially distributed point to each register, drawn interval by
interval in rising order, and a register keeps the logarithm (base B) of its least point.
Sketches of parts merge by the registers' maximum. Equal registers are as likely as the
sets are alike, so runs of registers serve as bucket keys. The likelihood of the registers'
order, given both set sizes, estimates the similarity of a candidate pair; what it cannot
exclude is confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from newslens.llm.graph import components, maybe_among, store
from newslens.llm.text import mix, per_batch, word_hashes
from newslens.session import materialize

M = 128
#: Bucket keys: so many runs of ROWS registers each, drawn from the M registers by a fixed rule.
#: A pair at 0.8 shares none with a chance of about one in a million.
BANDS, ROWS = 48, 6
RATE, B, TOP = 20.0, 1.001, 65535
#: A pair is put aside without comparing sets if its estimate is this far below the threshold,
#: over five standard deviations of the estimate.
MARGIN = 0.2
#: Bucket mates below this estimate are in the bucket by chance.
CHANCE = 0.3
#: Rows on the two sides of a block of comparisons.
BLOCK_X, BLOCK_Y = 128, 512
#: Documents whose words are hashed and sketched at once.
STEP = 256


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; the whole sequence as one if it is shorter."""
    words, at = word_hashes(texts)
    sets = []
    rolled = words
    salts = mix(np.arange(1, width + 1, dtype=np.uint64))
    if len(words) >= width > 1:
        rolled = np.zeros(len(words) - width + 1, np.uint64)
        for i, salt in enumerate(salts):
            rolled = mix(rolled + words[i : len(words) - width + 1 + i] * (salt | np.uint64(1)))
    for low, high in zip(at[:-1], at[1:]):
        if high - low >= width:
            sets.append(np.unique(rolled[low : high - width + 1]))
        elif high > low:
            sets.append(np.array([xxhash.xxh3_64_intdigest(words[low:high].tobytes())], np.uint64))
        else:
            sets.append(words[:0])
    return sets


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Registers (sets x M) of non-empty sets."""
    registers = np.zeros((len(sets), M), np.int32)
    flat = registers.reshape(-1)
    element = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    place = mix(element ^ np.uint64(0x5851F42D4C957F2D))
    step = (place >> np.uint64(32)) | np.uint64(1)
    for j in range(M):
        drawn = (mix(element + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(11)) * 2.0**-53
        point = -np.log1p(-(j + drawn) / M) / RATE
        value = np.clip(np.floor(1 - np.log(np.maximum(point, 1e-300)) / np.log(B)), 0, TOP).astype(np.int32)
        register = ((place + np.uint64(j) * step) & np.uint64(M - 1)).astype(np.int64)
        np.maximum.at(flat, owner * M + register, value)
        if j + 1 == M:
            break
        # later points lie beyond this interval: a sketch whose registers all passed it is done
        reached = int(np.floor(1 - np.log(-np.log1p(-(j + 1) / M) / RATE) / np.log(B)))
        open_ = registers.min(axis=1) < reached
        if not open_.any():
            break
        go = open_[owner]
        if not go.all():
            element, owner, place, step = element[go], owner[go], place[go], step[go]
    return registers


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of pairs, from registers (pairs x M) and set sizes."""
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = M - above - below
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)

    def chance(x):
        return -np.log1p(-np.clip(x, 0, 1) * (B - 1) / B) / np.log(B)

    def likelihood(j):
        up, down = np.maximum(chance(u - v * j), 1e-12), np.maximum(chance(v - u * j), 1e-12)
        return above * np.log(up) + below * np.log(down) + same * np.log(np.maximum(1 - up - down, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(30):  # the likelihood has one peak
        left, right = low + (high - low) / 3, high - (high - low) / 3
        up = likelihood(left) < likelihood(right)
        low, high = np.where(up, left, low), np.where(up, high, right)
    return (low + high) / 2


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(doc_id, n_shingles, digest, registers); digest and registers are null for empty sets."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, digests, registers = [], [], []
        for low in range(0, batch.num_rows, STEP):
            sets = shingle_sets(batch.column(1).slice(low, STEP), width)
            sizes += [len(s) for s in sets]
            digests += [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            full = [s for s in sets if len(s)]
            rows = iter(sketch(full).astype("<u2") if full else ())
            registers += [next(rows).tobytes() if len(s) else None for s in sets]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                                           pa.array(registers, pa.binary())], names=["doc_id", "n_shingles", "digest", "registers"])

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("_text"))
    return per_batch(source, make, "doc_id bigint, n_shingles bigint, digest binary, registers binary")


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, M).astype(np.int32)


def _band_rows(reps: DataFrame) -> DataFrame:
    """(key, doc_id): one row per document and band."""
    chosen = np.random.default_rng(1).permuted(np.tile(np.arange(M), (BANDS, 1)), axis=1)[:, :ROWS]

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        registers = _registers(batch.column(1)).astype(np.uint64)
        keys = np.zeros((len(registers), BANDS), np.uint64)
        for i in range(ROWS):
            keys = mix(keys + registers[:, chosen[:, i]] * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, BANDS + 1, dtype=np.uint64))
        ids = np.repeat(batch.column(0).to_numpy(), BANDS)
        return pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(ids)], names=["key", "doc_id"])

    return per_batch(reps.select("doc_id", "registers"), make, "key bigint, doc_id bigint")


def _estimates(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Add ``likely``, the estimated similarity, to pairs (center, doc_id, key)."""
    one = reps.select(F.col("doc_id").alias("center"), F.col("registers").alias("_ra"), F.col("n_shingles").alias("_na"))
    two = reps.select("doc_id", F.col("registers").alias("_rb"), F.col("n_shingles").alias("_nb"))
    joined = pairs.join(one, "center").join(two, "doc_id").select("center", "doc_id", "_ra", "_na", "_rb", "_nb")

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [estimate(_registers(b.column(2)), _registers(b.column(4)), b.column(3).to_numpy(), b.column(5).to_numpy())
                 for low in range(0, batch.num_rows, 1024) for b in [batch.slice(low, 1024)]]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(parts))],
                                          names=["center", "doc_id", "likely"])

    return per_batch(joined, make, "center bigint, doc_id bigint, likely double")


def _star_pairs(bands: DataFrame, reps: DataFrame) -> DataFrame:
    """(center, doc_id, likely): every document with its buckets' centers, but for chance meetings.

    A bucket's center is its smallest document. Those that are unlike it are compared among
    themselves, in blocks of bounded size.
    """
    buckets = bands.groupBy("key").agg(F.min("doc_id").alias("center"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = store(bands.join(buckets, "key").where("doc_id <> center"), "members")
    likely = store(_estimates(members.select("center", "doc_id").distinct(), reps), "likely")
    near = likely.where(F.col("likely") >= CHANCE)
    left = members.join(near, ["center", "doc_id"], "left_anti").select("key", "doc_id")
    sizes = left.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK_Y).cast("int").alias("cuts"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    cut = F.pmod(F.xxhash64("doc_id"), F.col("cuts")).cast("int")
    dealt = left.join(sizes, "key").withColumn("cut", cut).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    # every pair of cuts is a block; a bucket that is not cut has one
    dealt = dealt.where("cuts = 1 or cut <> other").select("key", F.least("cut", "other").alias("low"), F.greatest("cut", "other").alias("high"), "doc_id")
    rows = dealt.join(reps, "doc_id").select("key", "low", "high", "doc_id", "n_shingles", "registers")
    return near.unionByName(_leader_pairs(rows).distinct())


def _leader_pairs(rows: DataFrame) -> DataFrame:
    """(center, doc_id, likely) within each block (key, low, high): the first document leads those like it,
    the first of the others leads those like it, and so on."""

    def block(ids: np.ndarray, sizes: np.ndarray, registers: np.ndarray) -> Iterator[tuple]:
        order = np.argsort(ids, kind="stable")
        while len(order) > 1:
            lead, rest = order[0], order[1:]
            # equal registers are nearly as frequent as the sets are alike: half the least share rules most out
            maybe = rest[(registers[rest] == registers[lead]).mean(axis=1) >= CHANCE / 2]
            if len(maybe):
                likely = estimate(np.broadcast_to(registers[lead], (len(maybe), M)), registers[maybe], np.full(len(maybe), sizes[lead]), sizes[maybe])
                near = likely >= CHANCE
                yield from zip([ids[lead]] * int(near.sum()), ids[maybe[near]], likely[near])
                rest = rest[~np.isin(rest, maybe[near])]
            order = rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # a block may go on in the next batch
        names = ["center", "doc_id", "likely"]

        def pairs(table: pa.Table) -> pa.RecordBatch:
            keys = np.stack([table[c].to_numpy() for c in ("key", "low", "high")], axis=1)
            bounds = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            ids, sizes, registers = table["doc_id"].to_numpy(), table["n_shingles"].to_numpy(), _registers(table["registers"])
            found = [p for x, y in zip(bounds, bounds[1:]) for p in block(ids[x:y], sizes[x:y], registers[x:y])]
            a, b, c = zip(*found) if found else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.float64())], names=names)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            if not table.num_rows:
                continue
            keys = np.stack([table[c].to_numpy() for c in ("key", "low", "high")], axis=1)
            last = int(np.argmax((keys == keys[-1]).all(axis=1)))
            if last:
                yield pairs(table.slice(0, last))
            held = table.slice(last)
        if held is not None and held.num_rows:
            yield pairs(held)

    ordered = rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return ordered.mapInArrow(run, "center bigint, doc_id bigint, likely double")


def _jaccard_at_least(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * shared >= percent * (len(one) + len(two) - shared)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike."""
    one, two = sets.select(F.col("doc_id").alias("a"), F.col("set").alias("_sa")), sets.select(F.col("doc_id").alias("b"), F.col("set").alias("_sb"))

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        ok = [_jaccard_at_least(np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8"), percent)
              for x, y in zip(batch.column(2), batch.column(3))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok))

    return per_batch(pairs.join(two, "b").join(one, "a").select("a", "b", "_sa", "_sb"), make, "a bigint, b bigint")


def _block_links(rows: DataFrame, percent: int) -> DataFrame:
    """Links between components within blocks of rows (family, bx, by, straggler, doc_id, component, set, registers).

    One link for any two components of a block is enough.
    """

    def block(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        table = table.sort_by("doc_id")
        side, ids = table["straggler"].to_numpy(), table["doc_id"].to_numpy()
        component, registers = table["component"].to_numpy(), _registers(table["registers"])
        sets = [np.frombuffer(s, "<u8") for s in table["set"].to_pylist()]
        sizes = np.array([len(s) for s in sets])
        ys = np.flatnonzero(~side)
        flat, ends = np.concatenate([sets[y] for y in ys]) if len(ys) else np.zeros(0, "<u8"), np.cumsum(sizes[ys])
        links, joined = [], set()
        for x in np.flatnonzero(side):
            small, large = np.minimum(sizes[ys], sizes[x]), np.maximum(sizes[ys], sizes[x])
            near = (component[ys] != component[x]) & (100 * small >= percent * large)
            k = np.flatnonzero(near)
            if not len(k):
                continue
            likely = estimate(np.broadcast_to(registers[x], (len(k), M)), registers[ys[k]], np.full(len(k), sizes[x]), sizes[ys[k]])
            for i in k[likely >= percent / 100 - MARGIN]:
                pair = component[x], component[ys[i]]
                if pair not in joined and _jaccard_at_least(sets[x], flat[ends[i] - sizes[ys[i]] : ends[i]], percent):
                    joined.add(pair)
                    links.append((ids[x], ids[ys[i]]))
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("family", "bx", "by").applyInArrow(block, "a bigint, b bigint")


def _between(family: DataFrame, sets: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Links between different components of one family, from (node, family, component).

    Every document outside its family's largest component is compared with all others of the
    family, in blocks of bounded size dealt by hashes.
    """
    sizes = store(family.groupBy("family", "component").agg(F.count(F.lit(1)).alias("n")), "parts")
    of = sizes.groupBy("family").agg(F.max_by("component", F.struct("n", -F.col("component"))).alias("main"), F.sum("n").alias("all"),
                                     F.max("n").alias("most")).where("all > most")
    members = family.join(of, "family").withColumns({
        "straggler": F.col("component") != F.col("main"),
        "_nx": F.ceil((F.col("all") - F.col("most")) / BLOCK_X).cast("int"), "_ny": F.ceil(F.col("all") / BLOCK_Y).cast("int"),
    }).select(F.col("node").alias("doc_id"), "family", "component", "straggler", "_nx", "_ny")
    members = members.join(sets, "doc_id").join(reps.select("doc_id", "registers"), "doc_id")
    deal = lambda n, salt: F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["family", "bx", "by", "side", "doc_id", "component", "set", "registers"]
    xs = members.where("straggler").withColumn("bx", deal("_nx", 1)).withColumn("by", every("_ny")).withColumn("side", F.lit(True))
    ys = members.withColumn("by", deal("_ny", 2)).withColumn("bx", every("_nx")).withColumn("side", F.lit(False))
    rows = xs.select(*columns).unionByName(ys.select(*columns)).withColumnRenamed("side", "straggler")
    return _block_links(rows, percent)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents whose word-shingle sets (``width`` words, A-Z lower-cased) have 100 * intersection
    >= ``percent`` * union are linked; ``component_id`` is the smallest id reachable by links.
    Equal sets always link. Documents without words or with a null text have an empty set and
    link with nothing. Rows that repeat an id get a row each, in one component; a null id
    takes no part, has no component and is kept. Other columns are left out; an empty table
    gives no rows. Links are found through shared bands of registers and confirmed on full sets.
    """
    stored = materialize(sketches(docs, id_col, text_col, width), "sketches")
    usable = stored.where("digest is not null and doc_id is not null")
    # copies collapse on the map side before anything is compared
    classes = materialize(usable.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    reps = materialize(usable.join(classes, "digest").where("doc_id = rep").select("doc_id", "n_shingles", "registers")
                       .dropDuplicates(["doc_id"]), "reps")
    stars = store(_star_pairs(_band_rows(reps), reps), "stars")
    family = store(components(stars.withColumnsRenamed({"center": "a", "doc_id": "b"})), "families")
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("_text"))

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [s.tobytes() for low in range(0, batch.num_rows, STEP) for s in shingle_sets(batch.column(1).slice(low, STEP), width)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["doc_id", "set"])

    met = maybe_among(source, "doc_id", family, "node").join(family.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    sets = materialize(per_batch(met, make, "doc_id bigint, set binary").dropDuplicates(["doc_id"]), "sets")
    # first the likeliest center of each document, then what still differs within a family
    best = stars.where(F.col("likely") >= percent / 100 - MARGIN).groupBy("doc_id").agg(
        F.max_by("center", F.struct("likely", -F.col("center"))).alias("a")).withColumnRenamed("doc_id", "b")
    first = store(_confirm(best, sets, percent), "links")
    joined = components(first)
    placed = family.withColumnRenamed("component", "family").join(joined, "node", "left").select(
        "node", "family", F.coalesce("component", "node").alias("component"))
    second = store(_between(store(placed, "placed"), sets, reps, percent), "links")
    joined = components(first.unionByName(second))
    whole = stored.join(classes, "digest", "left").join(joined, F.col("rep") == F.col("node"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return whole.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
