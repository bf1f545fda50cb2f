"""Sketches of daily word statistics against exact ones."""

import datetime
import random
from collections import Counter

from pyspark.sql import functions as F

from newslens.operators import sketches


def rows(n=400):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    weights = [1000 / (i + 1) for i in range(3000)]
    day = lambda i: datetime.date(2024, 1, 1) + datetime.timedelta(days=i % 30)
    out = [(day(i), rng.choice("abc"), " ".join(rng.choices(words, weights, k=rng.randint(0, 60)))) for i in range(n)]
    return out + [(day(1), "a", None), (None, "a", "lost"), (day(2), None, "lost")]


def test_any_range_is_united_from_days(spark):
    data = rows()
    df = spark.createDataFrame(data, "date date, category string, text string").repartition(6)
    stored = sketches.daily_sketches(df).cache()
    assert stored.count() == len({(d, c) for d, c, _ in data if d and c})
    for low, high in ((1, 30), (5, 9), (17, 17)):
        kept = [(c, t) for d, c, t in data if d and c and low <= d.day <= high]
        united = sketches.united(stored, within=F.dayofmonth("day").between(low, high))
        row = sketches.distinct_words(united).first()
        words = Counter(w for _, t in kept for w in (t or "").split())
        assert row["articles"] == len(kept) and row["words"] == sum(words.values())
        assert abs(row["mean_length"] - sum(len(t or "") for _, t in kept) / len(kept)) < 1e-9
        assert abs(row["distinct_words"] - len(words)) <= 4 * 1.04 / 2**7 * len(words) + 1
        found = {r["term"]: r["n"] for r in sketches.frequent_words(united, 20).collect()}
        for w, n in words.most_common(10):
            assert abs(found[w] - n) <= 3.5 / sketches.ITEMS * sum(words.values()) + 1
    by_category = {r["category"]: r["articles"] for r in sketches.united(stored, "category").collect()}
    assert by_category == Counter(c for d, c, _ in data if d and c)


def test_sketches_can_be_stored(spark, tmp_path):
    df = spark.createDataFrame(rows(60), "date date, category string, text string")
    path = str(tmp_path / "sketches")
    sketches.daily_sketches(df.where("day(date) <= 15")).write.parquet(path)
    sketches.daily_sketches(df.where("day(date) > 15")).write.mode("append").parquet(path)
    united = sketches.united(spark.read.parquet(path), "category")
    whole = sketches.united(sketches.daily_sketches(df), "category")
    pick = lambda x: sorted(map(str, sketches.distinct_words(x).drop("frequent").collect()))
    assert pick(united) == pick(whole)
    assert sketches.daily_sketches(df.where("1 = 0")).count() == 0
