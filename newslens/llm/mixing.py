"""Mixing sources to target weights: Sainte-Laguë block quotas, seeded block selection.

DataFrame functions only. A source is dealt into shards by a seeded hash of the document id,
so no source, however large, is ordered in one task. A shard's documents, in seeded order,
form one stream of words that is cut into blocks of equal length. Blocks are then
apportioned twice by highest quotients (Sainte-Laguë): first all blocks to the sources, by
their targets, then each source's blocks to its shards. A shard repeats its stream for
whole multiples of its blocks and takes the rest by a seeded systematic choice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from newslens.llm.graph import store
from newslens.llm.text import WORD, word_count
from newslens.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
BLOCK_WORDS = 64
SHARDS = 1024


def _unit(*parts: Column) -> Column:
    """A reproducible number in [0, 1) from the parts' text."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 40)) / F.lit(float(1 << 40))


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(rank, source, source_size, target): one row per source.

    ``weights`` repeat over the sources in code-point order, null last. The targets share out
    all words by weight; no target is above ``max_repeats`` times its source's size, and what
    is cut goes to the other sources by weight until none is above. In the order of
    size / weight the cut sources come first, so one running sum finds where cutting ends.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source from here on
    everything = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    ranked = sizes.withColumn("rank", F.row_number().over(everything) - 1).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ).withColumn("cap", F.col("source_size") * max_repeats)
    tight = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, here = tight.rowsBetween(Window.unboundedPreceding, -1), tight.rowsBetween(0, Window.unboundedFollowing)
    all_rows = Window.partitionBy()
    level = ranked.withColumns({
        "level": (F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        / F.sum("weight").over(here),
    })
    level = level.withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
    # the first source in this order that fits sets the level of all that follow
    level = level.withColumn("level", F.min(F.when(F.col("fits"), F.struct(F.col("cap") / F.col("weight"), "rank", "level")))
                             .over(all_rows)["level"])
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.coalesce("level", F.lit(0.0)))
    return level.select("rank", "source", "source_size", target.alias("target"))


def apportion(shares: DataFrame, by: Sequence[str], key: str, share: str, seats: str, out: str) -> DataFrame:
    """Sainte-Laguë seats within each group ``by``: ``seats`` seats to the rows by the highest ``share`` / (2k + 1).

    Rounding every row's exact part gives nearly all of them; only the quotients next to that
    are listed and ranked to add what is missing or take back what is over. Ties go to the
    smaller ``key``. A row with share 0 or null gets none.
    """
    group = Window.partitionBy(*by)
    exact = F.when(F.col("_total") > 0, F.col("_share") * F.col(seats) / F.col("_total")).otherwise(0.0)
    first = shares.withColumn("_share", F.coalesce(F.col(share).cast("double"), F.lit(0.0)))
    first = first.withColumn("_total", F.sum("_share").over(group))
    first = first.withColumn("_exact", exact).withColumn("_k", F.floor(F.col("_exact") + 0.5).cast("bigint"))
    first = first.withColumn("_short", F.col(seats) - F.sum("_k").over(group))
    # enough neighbours: a row moves at most by its part of the shortfall, and two
    reach = F.ceil(F.abs("_short") * F.col("_share") / F.col("_total")).cast("bigint") + 2
    more = F.when((F.col("_short") > 0) & (F.col("_share") > 0), F.sequence(F.lit(1), reach))
    fewer = F.when((F.col("_short") < 0) & (F.col("_k") > 0), F.sequence(F.lit(1), F.least(reach, F.col("_k"))))
    listed = first.where("_short <> 0 and _share > 0").select(
        *by, key, "_k", "_short", "_share", F.explode(F.coalesce(more, fewer)).alias("_j"))
    quotient = F.when(F.col("_short") > 0, F.col("_share") / (2 * (F.col("_k") + F.col("_j")) - 1)).otherwise(
        -F.col("_share") / (2 * (F.col("_k") - F.col("_j")) + 1))
    order = Window.partitionBy(*by).orderBy(F.col("_q").desc(), F.when(F.col("_short") > 0, F.col(key)).otherwise(-F.col(key)))
    moved = listed.withColumn("_q", quotient).withColumn("_n", F.row_number().over(order)).where(
        F.col("_n") <= F.abs("_short")).groupBy(*by, key).agg(F.sum(F.signum("_short")).cast("bigint").alias("_moved"))
    joined = first.join(moved, [*by, key], "left")
    return joined.select(*shares.columns, (F.col("_k") + F.coalesce("_moved", F.lit(0))).alias(out))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
    seed: int = 7,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, and where its words lie.

    ``_repeats`` whole passes of the document are taken, plus the words of the chosen blocks
    (``_start``, ``_words``, ``_blocks``, ``_chosen``, ``_offset`` describe the shard's stream; see
    ``mixed_text``). A null text has no words, a null source is a source of its own, the last
    one. Documents without words get nothing. Rows that repeat an id are documents of their own.
    An empty table gives no rows; other columns are left out. No document is taken more than
    ``max_repeats`` times.
    """
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    shard = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(shards))
    sized = materialize(sized.withColumn("shard", shard), "sizes")
    cells = sized.groupBy("source", "shard").agg(F.sum("size").alias("words"))
    cells = store(cells.withColumn("blocks", F.ceil(F.col("words") / block_words)), "cells")
    targets = source_targets(sized, weights, max_repeats)
    blocks = cells.groupBy("source").agg(F.sum("blocks").alias("blocks"))
    asked = targets.join(blocks, targets.source.eqNullSafe(blocks.source)).select(
        targets["*"], "blocks", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") * F.col("blocks")).otherwise(0.0).alias("asked"))
    asked = asked.withColumn("_one", F.lit(1)).withColumn(
        "seats", F.round(F.sum("asked").over(Window.partitionBy("_one"))).cast("bigint"))
    given = apportion(asked, ["_one"], "rank", "asked", "seats", "quota")
    given = store(given.withColumn("quota", F.least("quota", F.col("blocks") * max_repeats)), "quotas")
    by_shard = cells.join(given.select("source", "rank", "quota", "source_size", "target").withColumnRenamed("source", "_source"),
                          cells.source.eqNullSafe(F.col("_source"))).drop("_source")
    by_shard = apportion(by_shard, ["rank"], "shard", "blocks", "quota", "taken_blocks")
    by_shard = store(by_shard.select(
        F.col("source").alias("_source"), F.col("shard").alias("_shard"), "source_size", "target", "words", "blocks",
        F.least("taken_blocks", F.col("blocks") * max_repeats).alias("taken_blocks")), "shards")
    stream = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.col("doc_id"), F.lit(seed + 1)), "doc_id", "size")
    laid = sized.withColumn("_start", F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, -1)))
    laid = laid.withColumn("_start", F.coalesce("_start", F.lit(0)))
    placed = laid.join(by_shard, laid.source.eqNullSafe(F.col("_source")) & (laid.shard == F.col("_shard"))).withColumns({
        "_repeats": F.when(F.col("blocks") > 0, F.floor(F.col("taken_blocks") / F.col("blocks"))).otherwise(0),
        "_chosen": F.when(F.col("blocks") > 0, F.col("taken_blocks") % F.col("blocks")).otherwise(0),
        "_offset": _unit(F.lit(seed), F.coalesce("source", F.lit("")), F.col("shard")),
    }).withColumnsRenamed({"words": "_words", "blocks": "_blocks"})
    part = F.aggregate(_chosen_blocks(), F.lit(0).cast("bigint"), lambda n, b: n + _overlap(b)[1] - _overlap(b)[0])
    taken = F.col("_repeats") * F.col("size") + F.when((F.col("_chosen") > 0) & (F.col("size") > 0), part).otherwise(0)
    return placed.select("doc_id", "size", "source_size", "target", taken.cast("bigint").alias("taken"),
                         "_repeats", "_chosen", "_offset", "_start", "_words", "_blocks", F.col("shard").alias("_shard"))


def _chosen_blocks() -> Column:
    """Numbers of the chosen blocks that the document reaches into."""
    first = F.floor(F.col("_start") * F.col("_blocks") / F.col("_words")).cast("bigint")
    last = F.floor((F.col("_start") + F.col("size") - 1) * F.col("_blocks") / F.col("_words")).cast("bigint") + 1
    numbers = F.sequence(F.greatest(first - 1, F.lit(0)), F.least(last, F.col("_blocks") - 1))
    part = F.col("_chosen") / F.col("_blocks")
    at = lambda b: F.floor(b * part + F.col("_offset"))
    return F.filter(numbers, lambda b: at(b + 1) > at(b))


def _overlap(block: Column) -> tuple[Column, Column]:
    """(from, to) of the block's words within the document, as word numbers from 0; empty if none."""
    edge = lambda b: F.floor(b * F.col("_words") / F.col("_blocks")).cast("bigint") - F.col("_start")
    low = F.greatest(edge(block), F.lit(0))
    return low, F.greatest(F.least(edge(block + 1), F.col("size")), low)


def mixed_text(text: Column) -> Column:
    """The words the mix takes of a document, from the columns of ``mix_sources``: whole
    repeats as written, then the chosen blocks' words joined by spaces; parts by a line break."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    spans = F.transform(_chosen_blocks(), lambda b: F.struct(_overlap(b)[0].alias("low"), _overlap(b)[1].alias("high")))
    pieces = F.flatten(F.transform(spans, lambda s: F.slice(words, (s["low"] + 1).cast("int"), (s["high"] - s["low"]).cast("int"))))
    whole = F.array_repeat(text, F.col("_repeats").cast("int"))
    partial = F.when((F.col("_chosen") > 0) & (F.col("taken") > F.col("_repeats") * F.col("size")),
                     F.array(F.array_join(pieces, " "))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(whole, partial), "\n")
