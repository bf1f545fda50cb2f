"""Exact sizes, determinism and skew of the sampling operators, against brute force."""

import hashlib

import pytest
from pyspark.sql import functions as F

from newslens.operators import joins, sampling


@pytest.fixture(scope="module")
def skewed(spark):
    """One class holds two thirds of 30,000 rows."""
    label = F.when(F.col("id") % 3 != 0, 0).otherwise((F.col("id") % 7 + 1).cast("int"))
    return spark.range(30_000).select("id", label.alias("y"))


def order(i, seed=42):
    return hashlib.md5(f"{i}|{seed}".encode()).hexdigest(), i


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_flag_first_equals_ranking(skewed, digits):
    rows = [(r["id"], r["y"]) for r in skewed.collect()]
    flagged = sampling.flag_first(skewed, "id", lambda n: F.floor(n * F.lit(0.3)), by=["y"], digits=digits)
    got = {r["id"] for r in flagged.where("selected").collect()}
    want = set()
    for y in {y for _, y in rows}:
        members = sorted((i for i, c in rows if c == y), key=order)
        want.update(members[:int(len(members) * 0.3)])
    assert got == want and flagged.count() == len(rows)


@pytest.mark.parametrize("size, n", [(0.1, 3000), (0.5, 15000), (7, 7), (99_999, 30_000), (0, 0)])
def test_sample_sizes(skewed, size, n):
    assert sampling.sample(skewed, "id", size).count() == n


def test_split_shares_and_seed(skewed):
    split = sampling.stratified_split(skewed, "id", "y")
    counts = {(r["y"], r["split"]): r["count"] for r in split.groupBy("y", "split").count().collect()}
    for y in {y for y, _ in counts}:
        total = counts[(y, "train")] + counts[(y, "test")]
        assert counts[(y, "test")] == round(0.2 * total)
    other = sampling.stratified_split(skewed, "id", "y", seed=7)
    assert split.exceptAll(other).count() > 0


def test_null_class_is_its_own_group(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(100)], "id int, y string")
    split = sampling.stratified_split(df, "id", "y")
    assert split.where("split = 'test'").groupBy("y").count().where("count = 10").count() == 2


@pytest.mark.parametrize("sizes, max_ratio, min_samples, want", [
    ({0: 100, 1: 10, 2: 40}, 3, 5, {0: 30, 1: 10, 2: 30}),
    ({0: 100, 1: 10, 2: 40}, 3, 20, {0: 60, 1: 20, 2: 40}),
    ({0: 100, 1: 10, 2: 40}, 5, 2000, {0: 2000, 1: 2000, 2: 2000}),
])
def test_sampling_targets(spark, sizes, max_ratio, min_samples, want):
    rows = [(i * 1000 + y, y) for y, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "id int, y int")
    targets = sampling.sampling_targets(df, "y", max_ratio, min_samples).collect()
    assert {r["y"]: r["target"] for r in targets} == want
    assert all(r["under_min"] == (sizes[r["y"]] < min_samples) for r in targets)
    kept = {r["y"]: r["count"] for r in sampling.undersample(df, "id", "y", max_ratio, min_samples).groupBy("y").count().collect()}
    assert kept == {y: min(n, want[y]) for y, n in sizes.items()}


def test_positions_are_dense_and_ordered(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"))
    assert sampling.with_position(df, "k").where("position <> k").count() == 0


def test_label_orders(spark):
    df = spark.createDataFrame([(3, "b"), (1, "c"), (2, "a"), (0, None)], "id int, category string")
    named = lambda by: {r["label"]: r["idx"] for r in joins.label_index(df, by=by, id_col="id").collect()}
    assert named("alphabet") == {"a": 0, "b": 1, "c": 2}
    assert named("appearance") == {"c": 0, "a": 1, "b": 2}
    assert joins.attach_index(df, joins.label_index(df)).where("category IS NULL AND category_id IS NULL").count() == 1
