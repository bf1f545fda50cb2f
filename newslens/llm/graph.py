"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newslens.session import materialize

#: Far above the logarithm of any chain of links; reaching it means a fault.
MAX_ROUNDS = 60


def store(df: DataFrame, label: str) -> DataFrame:
    """``materialize`` in at most three pieces a core: the many small tables of an iteration
    cost more in tasks and files than in rows."""
    return materialize(df.coalesce(3 * df.sparkSession.sparkContext.defaultParallelism), label)


#: Bits of the filter of ``maybe_among``, sent to the workers as at most FILTER_BITS / 64 rows.
FILTER_BITS = 1 << 23


def maybe_among(df: DataFrame, id_col: str, wanted: DataFrame, wanted_col: str) -> DataFrame:
    """The rows whose id may be among the wanted ones: all that are, and a few that only share a bit.

    For tables of long rows of which a join needs a part: the others are not shuffled. The more
    ids are wanted, the more other rows pass.
    """
    code = lambda c: F.pmod(F.xxhash64(c.cast("bigint")), F.lit(FILTER_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("_code") % 64).cast("int"))
    cells = wanted.select(code(F.col(wanted_col)).alias("_code")).groupBy(F.shiftright("_code", 6).alias("_cell")).agg(F.bit_or(bit).alias("_bits"))
    own = df.withColumn("_code", code(F.col(id_col)))
    met = own.join(F.broadcast(cells), F.shiftright("_code", 6) == F.col("_cell"))  # a bounded number of rows
    return met.where(F.getbit("_bits", (F.col("_code") % 64).cast("int")) == 1).select(*df.columns)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    Each round takes the least label among a node and its neighbours, then follows labels of
    labels, so the rounds grow with the logarithm of the longest chain. Every round is stored
    in the shared folder; only the number of changed labels reaches the driver. Null ends
    and self links are ignored, repeated links do no harm, no links give no rows.
    """
    ends = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    both = store(ends.union(ends.select("b", "a")).distinct(), "links")
    labels = store(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label"))
                         .withColumnRenamed("a", "node"), "labels")
    for _ in range(MAX_ROUNDS):
        heard = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("heard"))
        least = labels.join(heard, labels.node == heard.a).select(
            "node", "label", F.least("label", "heard").alias("least"))
        least = store(least, "least")
        step = least.select(F.col("node").alias("_at"), F.col("least").alias("_next"))
        jumped = store(
            least.join(step, least.least == step._at, "left")
            .select("node", F.coalesce("_next", "least").alias("label"),
                    (F.coalesce("_next", "least") != F.col("label")).alias("changed")),
            "labels")
        labels = jumped.select("node", "label")
        if not jumped.where("changed").limit(1).count():
            return labels.select("node", F.col("label").alias("component"))
    raise RuntimeError("components did not settle")
