"""Seeded samples, splits and class balancing with exact sizes.

All of them mean "the first q rows of a group in md5(id|seed) order". Ranking a
group with a window would put all of it into one task, and one class may hold a
third of the data, so the rank is never computed. Rows are counted per group and
hash prefix instead; the prefix where the quota runs out is the group's cut.
Rows below the cut are in, rows above are out, and only the rows sharing the cut
prefix (one in 65,536 by default) are ranked.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from newslens.session import materialize

PREFIX_DIGITS = 4


def hash_order(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}")))


def _cuts(keyed: DataFrame, groups: list[str], quota: Callable[[Column], Column]) -> DataFrame:
    """Per group: the prefix at which the quota is used up, and how much is left of it there."""
    counts = keyed.groupBy(*groups, "_prefix").agg(F.count(F.lit(1)).alias("_rows"))
    # at most 16^digits rows per group from here on
    by_group = Window.partitionBy(*groups)
    running = by_group.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumns({
        "_total": F.sum("_rows").over(by_group), "_until": F.sum("_rows").over(running)
    })
    target = quota(F.col("_total")).cast("bigint")
    before = F.col("_until") - F.col("_rows")
    return ranked.where((before < target) & (F.least(target, F.col("_total")) <= F.col("_until"))).select(
        *[F.col(g).alias(f"_cut_{g}") for g in groups],
        F.col("_prefix").alias("_cut"),
        (F.least(target, F.col("_total")) - before).alias("_left"),
    )


def _same(groups: Sequence[str]) -> Column:
    same = F.lit(True)
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_cut_{g}"))
    return same


def flag_first(
    df: DataFrame,
    id_col: str,
    quota: Callable[[Column], Column],
    by: Sequence[str] = (),
    seed: int = 42,
    flag: str = "selected",
    digits: int = PREFIX_DIGITS,
) -> DataFrame:
    """Add a boolean that is true for exactly ``quota(group size)`` rows of each group.

    The input is read twice: once for groups, ids and hashes, which are stored, and
    once for the rows themselves. In between, the last selected (hash, id) of each
    group is found, so a row is selected if it comes no later. Ids are unique.
    """
    order = hash_order(id_col, seed)
    groups = list(by) or ["_all"]
    keys = df.select(*by, F.col(id_col).alias("_id"), order.alias("_order"))
    keys = materialize(keys if by else keys.withColumn("_all", F.lit(1)), "keys")
    keys = keys.withColumn("_prefix", F.substring("_order", 1, digits))
    cuts = materialize(_cuts(keys, groups, quota), "cuts")
    if not by:
        cut = cuts.first()
        edge = keys.where(F.col("_prefix") == cut["_cut"]).withColumn("_left", F.lit(cut["_left"])) if cut else keys.limit(0).withColumn("_left", F.lit(0))
    else:
        edge = keys.join(cuts, _same(groups) & (F.col("_prefix") == F.col("_cut")))
    within = Window.partitionBy(*groups).orderBy("_order", "_id")
    last = edge.withColumn("_rank", F.row_number().over(within)).where(F.col("_rank") == F.col("_left")).select(
        *[F.col(g).alias(f"_cut_{g}") for g in groups], F.col("_order").alias("_last_order"), F.col("_id").alias("_last_id"))
    last = materialize(last, "last")
    if by:
        joined, last_order, last_id = df.join(last, _same(by), "left"), F.col("_last_order"), F.col("_last_id")
    else:
        row = last.first()
        joined, last_order, last_id = df, F.lit(row and row["_last_order"]), F.lit(row and row["_last_id"])
    chosen = (order < last_order) | ((order == last_order) & (F.col(id_col) <= last_id))
    return joined.withColumn(flag, F.coalesce(chosen, F.lit(False))).select(*df.columns, flag)


def sample(df: DataFrame, id_col: str, size: float, seed: int = 42) -> DataFrame:
    """Exact sample: a fraction for 0 < size < 1 (truncated), else a number of rows."""
    if 0 < size < 1:
        quota = lambda n: F.floor(n * F.lit(size))
    else:
        quota = lambda n: F.least(n, F.lit(int(size)))
    return flag_first(df, id_col, quota, seed=seed).where("selected").drop("selected")


def sample_rounded(df: DataFrame, id_col: str, fraction: float, seed: int = 42) -> DataFrame:
    """Exact sample of ``round(n * fraction)`` rows (half to even)."""
    quota = lambda n: F.bround(n * F.lit(fraction), 0)
    return flag_first(df, id_col, quota, seed=seed).where("selected").drop("selected")


def stratified_split(df: DataFrame, id_col: str, label: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split`` ('train'/'test'), with ``round(share * n)`` test rows per class."""
    quota = lambda n: F.round(n * F.lit(test_share), 0)
    flagged = flag_first(df, id_col, quota, by=[label], seed=seed, flag="_test")
    return flagged.withColumn("split", F.when(F.col("_test"), "test").otherwise("train")).drop("_test")


def random_split(df: DataFrame, id_col: str, train_share: float = 0.8, seed: int = 42) -> DataFrame:
    """Add ``split`` ('train'/'validation') with ``int(share * n)`` training rows."""
    quota = lambda n: F.floor(n * F.lit(train_share))
    flagged = flag_first(df, id_col, quota, seed=seed, flag="_train")
    return flagged.withColumn("split", F.when(F.col("_train"), "train").otherwise("validation")).drop("_train")


def target_size(n: Column, smallest: Column, max_ratio: float, min_samples: int) -> Column:
    """Rows a class should keep, given its size and that of the smallest class; a fraction is cut off."""
    cap = F.greatest(smallest, F.lit(min_samples)) * F.lit(max_ratio)
    return F.when(n <= cap, F.greatest(n, F.lit(min_samples))).otherwise(F.floor(cap)).cast("bigint")


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    """(label, n), stored: it is used several times and joined with its true size known."""
    sizes = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return materialize(sizes, "sizes")


def sampling_targets(df: DataFrame, label: str, max_ratio: float = 5, min_samples: int = 2000) -> DataFrame:
    """(label, n, target, under_min): what balancing aims at per class.

    ``under_min`` marks classes smaller than the minimum; they are kept whole.
    """
    sizes = class_sizes(df, label)
    smallest = sizes.agg(F.min("n")).scalar()
    target = target_size(F.col("n"), smallest, max_ratio, min_samples)
    return sizes.select(label, "n", target.alias("target"), (F.col("n") < min_samples).alias("under_min"))


def undersample(
    df: DataFrame, id_col: str, label: str, max_ratio: float = 5, min_samples: int = 2000, seed: int = 42
) -> DataFrame:
    """Cut every class down to its target size; smaller classes are kept whole."""
    smallest = class_sizes(df, label).agg(F.min("n")).scalar()
    quota = lambda n: target_size(n, smallest, max_ratio, min_samples)
    return flag_first(df, id_col, quota, by=[label], seed=seed).where("selected").drop("selected")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight) with the balanced weight total / (classes * n)."""
    sizes = class_sizes(df, label)
    totals = sizes.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("classes"))
    weight = totals.select(F.col("total") / F.col("classes")).scalar() / F.col("n")
    return sizes.withColumn("weight", weight)


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    weights = class_weights(df, label).select(label, F.col("weight").alias(name))
    return df.join(weights, label, "left")


def with_position(df: DataFrame, *order: str, name: str = "position") -> DataFrame:
    """Add the zero-based position in the given order without a single-task sort.

    The sorted rows are written once; their partition numbers and a count per
    partition then give each row its offset.
    """
    ordered = df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    stored = materialize(ordered, "ordered").withColumn("_part", F.shiftright("_at", 33))
    sizes = materialize(stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")), "offsets")
    # one row per sort partition
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    position = F.col("_offset") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return stored.join(offsets, "_part").select(*df.columns, position.alias(name))
