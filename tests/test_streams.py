"""Streams against their batch forms, restarts included."""

import os
from collections import Counter

from pyspark.sql import functions as F

from newslens.session import materialize, scratch_path, scratch_tables, shared_folder
from newslens.streaming import jobs


def test_timeline_survives_a_restart_and_late_files(spark, folder, tmp_path):
    events = spark.read.parquet(f"{folder}/events.parquet").select("ts", F.col("event_type").alias("category"))
    halves = events.orderBy("ts").limit(events.count() // 2), events
    into, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    first = halves[0].cache()
    first.write.parquet(into)
    for part in (None, events.exceptAll(first)):
        if part is not None:
            part.write.mode("append").parquet(into)
        jobs.daily_counts_stream(spark.readStream.schema(events.schema).parquet(into), out, checkpoint).awaitTermination()
    got = jobs.latest_daily_counts(spark, out)
    want = events.groupBy(F.to_date("ts").alias("day"), "category").agg(F.count(F.lit(1)).alias("n"))
    assert first.exceptAll(events).count() == 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_events_of_any_age_count_and_batches_can_be_folded(spark, tmp_path):
    into, out, checkpoint, folded = (str(tmp_path / n) for n in ("in", "out", "checkpoint", "folded"))
    for day in ("2024-06-01", "2024-01-01", "2024-06-01"):  # the second is months late
        events = spark.createDataFrame([(f"{day} 10:00:00", "a")], "ts string, category string")
        events.write.mode("append").parquet(into)
        jobs.daily_counts_stream(
            spark.readStream.schema(events.schema).parquet(into), out, checkpoint, trigger={"availableNow": True}).awaitTermination()
    want = {("2024-06-01", 2), ("2024-01-01", 1)}
    assert {(str(r["day"]), r["n"]) for r in jobs.latest_daily_counts(spark, out).collect()} == want
    jobs.compact_daily_counts(spark, out, folded)
    assert {(str(r["day"]), r["n"]) for r in jobs.latest_daily_counts(spark, folded).collect()} == want


def test_live_timeline_corrects_and_folds_itself_while_it_runs(spark, tmp_path):
    into, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    days = ["2024-06-01", "2024-06-02", "2024-01-01", "2024-06-01", None, "2024-01-01", "2024-06-02"]
    rows = [[(f"{d} 10:00:00" if d else None, c) for c in "aab"] for d in days]
    for part in rows[:5]:
        spark.createDataFrame(part, "ts string, category string").coalesce(1).write.mode("append").parquet(into)

    def run():
        stream = spark.readStream.schema("ts string, category string").option("maxFilesPerTrigger", 1).parquet(into)
        jobs.live_timeline_stream(stream, out, checkpoint, compact_every=2).awaitTermination()

    def wanted(parts):
        counts = Counter((d[:10], c) for part in parts for d, c in part if d)
        return {(d, c, n) for (d, c), n in counts.items()}

    seen = lambda: {(str(r["day"]), r["category"], r["n"]) for r in jobs.live_timeline(spark, out).collect()}
    run()
    assert seen() == wanted(rows[:5])
    assert 0 not in jobs._complete(spark, f"{out}/changes") and len(jobs._complete(spark, f"{out}/snapshots")) <= 2
    for part in rows[5:]:  # the stream stops and goes on from its state
        spark.createDataFrame(part, "ts string, category string").coalesce(1).write.mode("append").parquet(into)
    run()
    assert seen() == wanted(rows)
    # a snapshot that was not written to its end is passed over
    os.makedirs(f"{out}/snapshots/batch=99")
    assert seen() == wanted(rows)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_materialized_table_reads_from_files(spark):
    stored = materialize(spark.range(10), "numbers")
    assert stored.count() == 10 and stored.inputFiles()[0].find(shared_folder(spark)) >= 0


def test_scratch_tables_go_when_their_block_ends(spark):
    kept = materialize(spark.range(3), "kept")
    with scratch_tables(spark):
        gone = materialize(spark.range(4), "gone").inputFiles()[0].removeprefix("file://")
        assert os.path.exists(gone)
    assert not os.path.exists(gone) and kept.count() == 3
