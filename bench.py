"""Times the headline queries; prints one JSON line.

``m32_scores`` answers with the model that ``m18_training_report`` has trained, so its time is that of scoring alone.

BENCH_SF_DIR names the folder of tables (default /root/testdata/sf0.1),
BENCH_CPUS the number of local cores (default 8).
"""

from __future__ import annotations

import json
import os
import time

from newslens.plans import load_all
from newslens.session import TEXT_PARTITIONS, build_session

HEADLINE = [
    "flagship_monthly_categories", "a2_keep_first", "a8_counts_by_month", "a14_word_cloud_terms", "f8_clean_text",
    "x9_annotated_articles", "x11_raw_text_sentiment", "a9_category_sentiment", "w1_entity_runs", "p10_fraction_sample",
    "m13_stratified_split", "m4_vocabulary", "m3_tfidf_sublinear", "m9_chi_square", "m22_classification_report",
    "m25_batch_mean_accuracy", "t3_daily_timeline", "m6_topics", "m5_svd_of_tfidf", "m18_training_report", "m32_scores",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g", TEXT_PARTITIONS: cpus,
    })
    spark.sparkContext.setLogLevel("ERROR")
    registered = load_all()
    spark.read.parquet(f"{folder}/region.parquet").count()  # start-up is not part of any query
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        registered[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
