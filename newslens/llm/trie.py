"""Prefix trie of conversations, by sorted matrices of turn ids.

Turns are numbered within their conversation and stand for themselves by a 64-bit id of role, text
and place; texts are not moved. A conversation is a row of ids, cut into bands of WIDTH turns, so
that no row is long; a band starts with the hash of all turns before it. Rows are dealt out by
ranges of (band, prefix, ids): every shard holds neighbours. In a shard the rows form a padded
matrix, sorted by ``lexsort``. A node of the trie begins where a column, or one before it, changes
from the row above; ``reduceat`` over these places aggregates all nodes of a depth at once.

Only the nodes on the path of a shard's first or last row can go on in other shards. Their counts
are added up first, and sent back to the shards that hold them; then every node is attributed to
the first shard that holds it, so that sums over subtrees add up over shards as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from newslens.session import materialize

#: Turns to a band, and band rows to a shard (about).
WIDTH, SHARD_ROWS = 64, 8192

_EMPTY = hashlib.sha256(b"").hexdigest()
_LONG = ["shard", "depth", "key", "n", "ends", "conv_id", "parent_key", "rep"]


#: Rows of a small stored table to a file, at least.
FILE_ROWS = 100_000


def _store(df: DataFrame, label: str, rows: int) -> DataFrame:
    """``materialize`` in as many files as so many rows need, and three a core at least."""
    return materialize(df.coalesce(max(3 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_ROWS))), label)


def number_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, pos, turn_id, size): the turns of every conversation, numbered from 1; size is the text's code points.

    By ``turn``, nulls first; equal turns by role, then by a hash of role and text. Null roles and texts are
    empty. Rows without a conversation are left out. Repeated rows are turns of their own. Numbers are given
    in ranges of the sorted turns, so that a long conversation is spread over many tasks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    own = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), F.xxhash64(role, text).alias("turn_id"), F.length(text).cast("bigint").alias("size"))
    order = ["conv_id", "turn", "role", "turn_id"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(0).to_numpy()
            starts = np.flatnonzero(np.diff(conv, prepend=conv[0]) != 0)
            starts = np.append(0, starts)
            local = np.arange(len(conv)) - np.repeat(starts, np.diff(starts, append=len(conv))) + 1
            if conv[0] == last:
                local[: starts[1] if len(starts) > 1 else len(conv)] += seen
            last, seen = conv[-1], int(local[-1])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(conv), shard, np.int32)), batch.column(0), pa.array(local), *batch.columns[1:]], names=["shard", "conv_id", "pos", "turn_id", "size"])

    dealt = own.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn_id", "size")
    local = materialize(dealt.mapInArrow(count, "shard int, conv_id bigint, pos bigint, turn_id bigint, size bigint"), "turns")
    # conversations that go on from one range to the next: fewer than ranges
    pieces = local.groupBy("conv_id", "shard").agg(F.max("pos").alias("n"))
    by = Window.partitionBy("conv_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    cut = pieces.groupBy("conv_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("conv_id")
    before = pieces.join(cut, "conv_id", "left_semi").withColumn("before", F.sum("n").over(by)).where("before is not null").select("conv_id", "shard", "before")
    return local.join(before, ["conv_id", "shard"], "left").select("conv_id", (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"), "turn_id", "size")


def rebuild(numbered: DataFrame, group: int = 100, shares: int = 6) -> tuple[DataFrame, DataFrame]:
    """(ids of all conversations, their rebuilt turns): conversation c gets the first h turns of conversation
    c - c % ``group``, then its own after its first h, h being the CRC-32 of its decimal id modulo ``shares``."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shares).cast("int")
    heads = numbered.where(F.col("pos") < shares).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("pos", "turn_id", "size"))).alias("head"))
    heads = heads.select(F.col("conv_id").alias("_base"), "head")
    convs = numbered.select("conv_id").distinct().withColumn("_base", F.col("conv_id") - F.pmod("conv_id", F.lit(group)))
    own = convs.join(heads, "_base", "left").select("conv_id", F.slice(F.coalesce("head", F.array().cast("array<struct<pos: bigint, turn_id: bigint, size: bigint>>")), F.lit(1), h).alias("head"))
    own = _store(own, "heads", numbered.count())
    given = own.select("conv_id", F.explode("head").alias("x")).select("conv_id", "x.pos", "x.turn_id", "x.size")
    rest = numbered.where(F.col("pos") > h).join(own.select("conv_id", F.size("head").alias("_n")), "conv_id")
    rest = rest.select("conv_id", (F.col("pos") - h + F.col("_n")).alias("pos"), "turn_id", "size")
    return own.select("conv_id"), given.unionAll(rest)


def _rows(convs: DataFrame, turns: DataFrame, width: int, shard_rows: int) -> DataFrame:
    """(shard, conv_id, band, prefix, ids, sizes, last): the bands of all conversations, dealt out by ranges. The root is turn 0."""
    spark = convs.sparkSession
    root = convs.select("conv_id", F.lit(0).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("turn_id"), F.lit(0).cast("bigint").alias("size"))
    placed = root.unionAll(turns.select("conv_id", "pos", "turn_id", "size")).select(
        "conv_id", F.floor(F.col("pos") / width).cast("int").alias("band"), "pos", F.xxhash64("turn_id", "pos").alias("id"), "size")
    bands = placed.groupBy("conv_id", "band").agg(F.array_sort(F.collect_list(F.struct("pos", "id", "size"))).alias("x"), F.bit_xor("id").alias("own"))
    by = Window.partitionBy("conv_id").orderBy("band")
    rows = bands.select(
        "conv_id", "band", F.coalesce(F.bit_xor("own").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("prefix"),
        F.col("x.id").alias("ids"), F.col("x.size").alias("sizes"), F.lead("band").over(by).isNull().alias("last"))
    rows = _store(rows, "bands", turns.count() + convs.count())
    shards = max(1, -(-rows.count() // shard_rows))
    dealt = rows.repartitionByRange(shards, "band", "prefix", "ids", "conv_id") if shards > 1 else rows.coalesce(1)
    return materialize(dealt.withColumn("shard", F.spark_partition_id()), "shards")


class Shard:
    """The sorted, padded matrix of a shard and the nodes of every column."""

    def __init__(self, table: pa.Table, band_width: int):
        table = table.combine_chunks()
        lists = table["ids"].combine_chunks()
        lengths = lists.value_lengths().to_numpy()
        row = np.repeat(np.arange(len(lengths)), lengths)
        column = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        _, code = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        width = int(lengths.max())
        matrix, mixed, sizes = (np.zeros((len(lengths), width), np.int64) for _ in range(3))
        matrix[row, column] = code + 1  # 0 pads
        mixed[row, column] = lists.flatten().to_numpy()
        sizes[row, column] = table["sizes"].combine_chunks().flatten().to_numpy()
        conv, band, prefix = (table[c].to_numpy() for c in ("conv_id", "band", "prefix"))
        order = np.lexsort([conv, *matrix.T[::-1], prefix, band])
        self.matrix, self.sizes, self.lengths = matrix[order], sizes[order], lengths[order]
        self.conv, self.band, self.prefix = conv[order], band[order], prefix[order]
        self.last = table["last"].to_numpy(zero_copy_only=False)[order]
        self.order, self.width, self.band_width = order, width, band_width
        self.keys = self.prefix[:, None] ^ np.bitwise_xor.accumulate(mixed[order], axis=1)
        changed = np.ones(self.matrix.shape, bool)
        changed[1:] = self.matrix[1:] != self.matrix[:-1]
        changed[1:, 0] |= (self.band[1:] != self.band[:-1]) | (self.prefix[1:] != self.prefix[:-1])
        changed = np.logical_or.accumulate(changed, axis=1)
        self.columns = [self._column(c, np.flatnonzero(changed[:, c])) for c in range(width)]

    def _column(self, c: int, starts: np.ndarray) -> dict:
        """The nodes of a column: first row and what is known without other shards. ``run`` numbers them among the stretches of equal rows."""
        run = np.flatnonzero(self.matrix[starts, c] > 0)
        at = starts[run]
        ending = (self.last & (self.lengths == c + 1)).astype(np.int64)
        size = np.diff(starts, append=len(self.conv))
        return {
            "starts": starts, "run": run, "at": at, "key": self.keys[at, c], "depth": self.band[at].astype(np.int64) * self.band_width + c, "n": size[run],
            "ends": np.add.reduceat(ending, starts)[run], "conv_id": np.minimum.reduceat(self.conv, starts)[run], "size": self.sizes[at, c],
            "parent_key": self.keys[at, c - 1] if c else self.prefix[at], "edge": (at == 0) | (at + size[run] == len(self.conv))}


def _edges(table: pa.Table, width: int) -> pa.Table:
    shard, parts = Shard(table, width), []
    for x in shard.columns:
        e = x["edge"]
        parts.append([np.full(int(e.sum()), table["shard"][0].as_py(), np.int64), x["depth"][e], x["key"][e], x["n"][e], x["ends"][e], x["conv_id"][e]])
    return pa.table([pa.array(np.concatenate(p)) for p in zip(*parts)], names=_LONG[:6])


#: Of a shard's result: NODE is complete, OPEN is to be added up, ENDS lists the members that end in an open node, TOTAL is what a row adds to its conversation's earlier bands.
NODE, OPEN, ENDS, TOTAL = range(4)
_OUT = "kind int, shard bigint, depth bigint, key bigint, parent_key bigint, conv_id bigint, parent_conv_id bigint, n bigint, children bigint, leaves bigint, saved bigint, sha string, ids binary"
_OUT_NAMES = [c.split()[0] for c in _OUT.split(", ")]


def _sha(convs: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, convs.tolist())).encode()).hexdigest() if len(convs) else _EMPTY


def _result(_kind: int, _rows: int, **columns) -> pa.Table:
    types = {"sha": pa.string(), "ids": pa.binary()}

    def column(name: str) -> pa.Array:
        value, kind = columns.get(name), types.get(name, pa.int64())
        return pa.nulls(_rows, kind) if value is None else value if isinstance(value, pa.Array) else pa.array(value, kind)

    return pa.table([pa.array(np.full(_rows, _kind, np.int32)), *(column(c) for c in _OUT_NAMES[1:])], names=_OUT_NAMES)


def _nodes(table: pa.Table, known: pa.Table, width: int, totals: bool) -> pa.Table:
    """All nodes of a shard, given the sums of those at its edges; or, with ``totals``, only what later bands add."""
    if not table.num_rows:
        return _result(NODE, 0)
    shard, number = Shard(table, width), table["shard"][0].as_py()
    of = {(d, k): i for i, (d, k) in enumerate(zip(known["depth"].to_pylist(), known["key"].to_pylist()))}
    sums = {c: known[c].to_numpy() for c in ("n", "ends", "conv_id", "rep")}
    shape = (len(shard.conv), shard.width)
    leaves, saved = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
    for c, x in enumerate(shard.columns):
        x["first"] = np.ones(len(x["at"]), bool)  # of the shards that hold it
        for i in np.flatnonzero(x["edge"]):
            k = of[int(x["depth"][i]), int(x["key"][i])]
            x["n"][i], x["ends"][i], x["conv_id"][i] = sums["n"][k], sums["ends"][k], sums["conv_id"][k]
            x["first"][i] = sums["rep"][k] == number
        leaves[x["at"], c] = x["first"] & (x["n"] == x["ends"])
        saved[x["at"], c] = np.where(x["first"], (x["n"] - 1) * x["size"], 0)
    more = [table[c].to_numpy()[shard.order] for c in ("more_leaves", "more_saved")]
    rows = np.arange(len(shard.conv))
    for weights, later in zip((leaves, saved), more):
        weights[rows, shard.lengths - 1] += later
        np.cumsum(weights[:, ::-1], axis=1, out=weights[:, ::-1])
    if totals:
        late = shard.band > 0
        return _result(TOTAL, int(late.sum()), depth=shard.band[late].astype(np.int64), conv_id=shard.conv[late], leaves=leaves[late, 0], saved=saved[late, 0])
    out = []
    for c, x in enumerate(shard.columns):
        at, run, starts = x["at"], x["run"], x["starts"]
        n = len(at)
        add = lambda w: np.add.reduceat(w, starts)[run]
        children = np.zeros(n, np.int64)
        if c + 1 < shard.width:
            below = shard.columns[c + 1]
            parent = np.searchsorted(at, below["at"][below["first"]], "right") - 1
            children = np.bincount(parent, minlength=n).astype(np.int64)
        if c:
            above = shard.columns[c - 1]
            parent_conv, no_parent = above["conv_id"][np.searchsorted(above["at"], at, "right") - 1], np.zeros(n, bool)
        else:
            parent_conv, no_parent = np.zeros(n, np.int64), np.ones(n, bool)
        goes_on = add((~shard.last & (shard.lengths == c + 1)).astype(np.int64)) > 0
        open_ = x["edge"] | goes_on
        ending = np.flatnonzero(shard.last & (shard.lengths == c + 1))  # of equal rows, by id
        low = np.searchsorted(ending, at)
        ends = add((shard.last & (shard.lengths == c + 1)).astype(np.int64))
        members = [shard.conv[ending[a : a + e]] for a, e in zip(low.tolist(), ends.tolist())]
        columns = dict(shard=np.full(n, number, np.int64), depth=x["depth"], key=x["key"], parent_key=x["parent_key"], conv_id=x["conv_id"], n=x["n"],
                       children=children, leaves=add(leaves[:, c]), saved=add(saved[:, c]))
        for kind, which in ((NODE, ~open_), (OPEN, open_)):
            w = np.flatnonzero(which)
            shas = [_sha(members[i]) for i in w] if kind == NODE else [None if x["edge"][i] else _sha(members[i]) for i in w]
            out.append(_result(kind, len(w), parent_conv_id=pa.array(parent_conv[w], mask=no_parent[w]), sha=shas, **{k: v[w] for k, v in columns.items()}))
        w = np.flatnonzero(x["edge"] & (ends > 0))
        out.append(_result(ENDS, len(w), ids=[members[i].astype("<i8").tobytes() for i in w], **{k: columns[k][w] for k in ("shard", "depth", "key")}))
        if not c:  # a child of the last turn of the band before
            w = np.flatnonzero((x["depth"] > 0) & x["first"])
            zero = np.zeros(len(w), np.int64)
            out.append(_result(OPEN, len(w), depth=x["depth"][w] - 1, key=x["parent_key"][w], children=zero + 1, leaves=zero, saved=zero))
    return pa.concat_tables(out)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's members, whose lists follow one another; only one list is held at a time."""
    last, sha = None, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([last[0]]), pa.array([last[1]]), pa.array([sha.hexdigest()])], names=["depth", "key", "listed"])

    for batch in batches:
        for depth, key, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
            text = ",".join(map(str, np.frombuffer(ids, "<i8").tolist())).encode()
            if (depth, key) == last:
                sha.update(b"," + text)
            else:
                if last is not None:
                    yield row()
                last, sha = (depth, key), hashlib.sha256(text)
    if last is not None:
        yield row()


def prefix_trie(convs: DataFrame, turns: DataFrame, width: int = WIDTH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The nodes of the trie of all conversations, one row each.

    ``convs`` has every conv_id once, ``turns`` (conv_id, pos, turn_id, size) their turns, pos counting from 1 without
    holes. Rows: ``conv_id`` smallest member, ``depth``, ``parent_conv_id`` the parent's smallest member (root: null),
    ``n_convs`` members, ``n_children``, ``n_leaves`` childless nodes of the subtree, ``saved_tokens`` summed over it
    (n_convs - 1) times the size of the last turn, ``ends_sha256`` of the members that end here, ascending, comma-joined.
    A conversation without turns ends in the root. No conversations give no rows. Other columns are left out.
    ``width`` turns make a band, about ``shard_rows`` bands a shard. Conversations of any length are
    spread over bands; a third of all rows may share a prefix, as shards are cut by rows, not by nodes.
    """
    rows = _rows(convs, turns, width, shard_rows)
    shards, size = rows.select("shard").distinct().count(), rows.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
    edges = _store(rows.groupBy("shard").applyInArrow(lambda table: _edges(table, width), ", ".join(f"{c} bigint" for c in _LONG[:6])), "edges", shards * width)
    summed = edges.groupBy("depth", "key").agg(F.sum("n").alias("n"), F.sum("ends").alias("ends"), F.min("conv_id").alias("conv_id"), F.min("shard").alias("rep"))
    known = _store(edges.select(F.col("shard").cast("int").alias("shard"), "depth", "key").join(summed, ["depth", "key"]).select("shard", "depth", "key", "n", "ends", "conv_id", "rep"), "known", shards * width)

    def run(rows: DataFrame, totals: bool) -> DataFrame:
        return rows.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(lambda a, b: _nodes(a, b, width, totals), _OUT)

    zero = F.lit(0).cast("bigint")
    full = rows.withColumns({"more_leaves": zero, "more_saved": zero})
    if shards and rows.where("band > 0").limit(1).count():
        later = run(full, True).select("conv_id", F.col("depth").cast("int").alias("band"), "leaves", "saved")
        upto = Window.partitionBy("conv_id").orderBy(F.col("band").desc())
        later = later.select("conv_id", (F.col("band") - 1).alias("band"), F.sum("leaves").over(upto).alias("_leaves"), F.sum("saved").over(upto).alias("_saved"))
        full = rows.join(_store(later, "later", size // width), ["conv_id", "band"], "left").select(
            *rows.columns, F.coalesce("_leaves", zero).alias("more_leaves"), F.coalesce("_saved", zero).alias("more_saved"))
    out = _store(run(full, False), "nodes", size)
    listed = out.where(F.col("kind") == ENDS).select("depth", "key", "shard", "ids").repartition("depth", "key").sortWithinPartitions("depth", "key", "shard")
    listed = listed.mapInArrow(_digests, "depth bigint, key bigint, listed string")
    joined = out.where(F.col("kind") == OPEN).groupBy("depth", "key").agg(
        F.min("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.min("parent_conv_id").alias("parent_conv_id"), F.max("n").alias("n"),
        *(F.sum(c).alias(c) for c in ("children", "leaves", "saved")), F.max("sha").alias("sha"))
    joined = joined.join(listed, ["depth", "key"], "left").withColumn("sha", F.coalesce("listed", "sha", F.lit(_EMPTY))).drop("listed")
    joined = _store(joined, "joined", shards * width)
    columns = ["depth", "key", "parent_key", "conv_id", "parent_conv_id", "n", "children", "leaves", "saved", "sha"]
    nodes = out.where(F.col("kind") == NODE).select(*columns).unionAll(joined.select(*columns))
    # parents of a band's first turn stand in other shards
    parents = joined.where((F.col("depth") + 1) % width == 0).select((F.col("depth") + 1).alias("_depth"), F.col("key").alias("_key"), F.col("conv_id").alias("_parent"))
    first = nodes.where((F.col("depth") > 0) & (F.col("depth") % width == 0))
    first = first.join(parents, (F.col("depth") == F.col("_depth")) & (F.col("parent_key") == F.col("_key"))).withColumn("parent_conv_id", F.col("_parent")).select(*columns)
    nodes = nodes.where((F.col("depth") == 0) | (F.col("depth") % width != 0)).unionAll(first)
    return nodes.select("conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
                        F.col("saved").alias("saved_tokens"), F.col("sha").alias("ends_sha256"))
