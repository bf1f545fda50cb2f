"""Cleaning, curation and annotation on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from newslens.functions import tagging, text
from newslens.functions.dictionary import MAX_ENTRIES, Dictionary
from newslens.functions.tagging import Tagger
from newslens.functions.wordlists import CATEGORY_MERGES, KEEP_WORDS, annotator_stop_words
from newslens.operators import annotate as ops
from newslens.operators import curate
from newslens.sources import files
from newslens.sources.schemas import ARTICLE

ROWS = [
    (1, 'He said "It\'s over" and "" left', "They can't, we'll see!"),
    (2, "Visit https://a.b/c?d=1 or www.x.org now", "<p>Big <b>news</b></p>"),
    (3, None, None),
    (4, "", "Only description here"),
    (5, "Café ouvre", "tab\tand\nnewline"),
    (6, 'He said "It\'s over" and "" left', "They can't, we'll see!"),
    (7, "Short one", "tiny text"),
    (8, "New York Times reports big breakthrough", "Officials announced plans quickly."),
    (9, "not good", "but great!!!"),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "id int, headline string, short_description string")


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "v string").select(expression(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("given, want", [
    ("can't they're it's he'd we'll i've i'm", "ca not they are it is he would we will i have i am"),
    ("the dog's n'ts", "the dog is  nots"),
])
def test_contractions(spark, given, want):
    assert one(spark, text.expand_contractions, given) == want


@pytest.mark.parametrize("given, want", [
    ("see http://a.b/c?d=1 or www.x.org", "see or"),
    ("a <b>bold</b> move <br/>now", "a bold move now"),
    ("broken <tag\nover lines>", "broken tag over lines"),
    ("café   50% & more here", "caf 50 more here"),
    ("", ""),
])
def test_scrub(spark, given, want):
    assert one(spark, text.scrub, given) == want


def test_quotes_keep_empty_ones(spark):
    assert one(spark, text.quoted_spans, 'a "b c" and "" and "open') == ["b c", ""]


@pytest.mark.parametrize("given, want", [(None, 0), ("", 0), ("  ", 0), ("a b\tc\n", 3), (" x ", 1)])
def test_count_words(spark, given, want):
    assert one(spark, text.count_words, given) == want


def test_labels_at_the_edges(spark):
    labels = spark.createDataFrame([(0.05,), (-0.05,), (0.0499,), (0.0,)], "c double").select(
        text.sentiment_label(F.col("c")).alias("l")).collect()
    assert [r["l"] for r in labels] == ["positive", "negative", "neutral", "neutral"]


def test_category_merge_is_one_pass(spark):
    df = spark.createDataFrame([(c,) for c in [*CATEGORY_MERGES, "POLITICS", "ARTS & CULTURE"]], "category string")
    merged = [r["category"] for r in curate.merge_categories(df).collect()]
    assert merged == [*CATEGORY_MERGES.values(), "POLITICS", "ARTS & CULTURE"]


def test_short_filter_and_duplicates(rows):
    assert [r["id"] for r in curate.drop_short(rows).orderBy("id").collect()] == [1, 6, 8]
    assert curate.count_duplicates(rows, "headline", "short_description").first()[0] == 1
    kept = curate.keep_first(rows, ["headline", "short_description"], "id")
    assert [r["id"] for r in kept.orderBy("id").collect()] == [1, 2, 3, 4, 5, 7, 8, 9]


def test_keep_first_carries_other_columns(rows):
    tagged = rows.withColumn("extra", F.col("id") * 10)
    kept = curate.keep_first(tagged, ["headline", "short_description"], "id").orderBy("id").collect()
    assert [r["extra"] for r in kept] == [10, 20, 30, 40, 50, 70, 80, 90]


def test_annotated_rows(rows):
    got = {r["id"]: r for r in ops.annotate(rows).collect()}
    empty = got[3]
    assert (empty["processed_text"], empty["sentiment_text"]) == ("", "")
    assert set(empty["pos_features"]) == {0} and all(v == [] for v in empty["news_patterns"])
    first = got[1]
    assert first["news_patterns"]["quotes"] == ["it is over", ""]
    assert first["pos_features"]["quote_count"] == 2
    news = got[8]
    assert news["news_patterns"]["named_entities"] == ["york"]
    assert "big breakthrough" in news["news_patterns"]["descriptive_phrases"]
    assert "announced plans" in news["news_patterns"]["action_phrases"]
    assert news["processed_text"].split() == ["new", "york", "time", "report", "big", "breakthrough", "official", "announc", "plan"]
    assert news["pos_features"]["adv_count"] == 1
    assert news["news_patterns"]["temporal_expressions"] == [] == news["news_patterns"]["location_expressions"]


def test_case_kept_for_tagging(rows):
    row = ops.annotate(rows.where("id = 8"), tag_on="original").first()
    assert row["news_patterns"]["named_entities"] == ["York Times", "Officials"]
    assert row["pos_features"]["proper_noun_count"] == 3


def test_serving_rule_differs_from_batch(spark):
    tokens = spark.createDataFrame([("the 42 dogs who ran, not the",)], "t string").select(
        Tagger().annotate(tagging.tokenize(F.col("t"))).alias("k"))
    stops = annotator_stop_words()
    both = tokens.select(
        tagging.sentiment_text(F.col("k"), stops, KEEP_WORDS, "batch").alias("batch"),
        tagging.sentiment_text(F.col("k"), stops, KEEP_WORDS, "serving").alias("serving"),
    ).first()
    assert both["batch"] == "dog who ran , not"
    assert both["serving"] == "42 dog who ran , not"


def test_purpose_prunes_the_other_text(rows):
    got = ops.annotate(rows.where("id = 8"), purpose="topic").first()
    assert got["processed_text"] and got["sentiment_text"] == ""
    with pytest.raises(ValueError):
        ops.annotate(rows, purpose="mood")


def test_row_local_patterns_equal_window_patterns(spark, folder):
    from newslens.plans.annotation import token_arrays

    arrays = token_arrays(spark, folder)
    table = ops.token_table(arrays, "doc_id")
    by_window = {
        "named_entities": ops.entities_by_window(table, "doc_id").withColumnRenamed("entity", "phrase"),
        "VB": ops.phrases_by_window(table, "doc_id", "VB"), "JJ": ops.phrases_by_window(table, "doc_id", "JJ"),
    }
    row_local = {
        "named_entities": tagging.named_entities(F.col("_tokens")),
        "VB": tagging.followed_by_noun(F.col("_tokens"), "VB"), "JJ": tagging.followed_by_noun(F.col("_tokens"), "JJ"),
    }
    for key, expression in row_local.items():
        local = arrays.select("doc_id", F.explode(expression).alias("phrase"))
        window = by_window[key].select("doc_id", "phrase")
        assert local.count() > 0
        assert local.exceptAll(window).count() == 0 and window.exceptAll(local).count() == 0


def test_long_runs_do_not_overflow(spark):
    chain, runs = "-".join(["ab"] * 50_000), "york " * 50_000
    df = spark.createDataFrame([(1, chain, runs)], "id int, headline string, short_description string")
    row = ops.annotate(df).first()
    assert row["news_patterns"]["named_entities"] == [runs.strip()]


def test_dictionary(spark):
    words = {f"w{i}": i for i in range(1000)}
    df = spark.range(1500).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("w"), "id")
    got = df.select("id", Dictionary(words, "int").get(F.col("w")).alias("v"))
    assert got.where("(id < 1000 AND v <=> id) OR (id >= 1000 AND v IS NULL)").count() == 1500
    with pytest.raises(ValueError):
        Dictionary({str(i): 1 for i in range(MAX_ENTRIES + 1)}, "int")


def test_csv_round_trip(spark, tmp_path):
    rows = [('a "quoted" one, with comma', "line\nbreak", "X", None), ("NA", " NaN ", "NULL", None)]
    df = spark.createDataFrame(rows, ARTICLE)
    path = str(tmp_path / "csv")
    files.write_csv(df, path, byte_order_mark=True)
    back = {tuple(r) for r in files.read_marked_csv(spark, path).collect()}
    assert back == {rows[0], (None, None, None, None)}


def test_unreadable_json_line_is_kept_apart(spark, tmp_path):
    path = tmp_path / "in.json"
    path.write_text('{"headline": "a", "date": "2020-01-02"}\nnot json\n')
    rows = files.read_articles_json(spark, str(path)).cache().orderBy("headline").collect()
    assert rows[0]["_corrupt_record"] == "not json" and rows[1]["headline"] == "a"


def test_wrong_request_keys_become_errors(spark, tmp_path):
    path = tmp_path / "in.json"
    path.write_text('{"header": "a", "summary": "b", "date": "2020-01-02"}\n{"headline ": ""}\n')
    checked = curate.with_request_error(files.read_requests(spark, str(path))).collect()
    assert [r["success"] for r in checked] == [False, False]


def test_sample_naming():
    assert files.dataset_path("s3://b/x/", "processed", True) == "s3://b/x/processed_sample"
    assert files.dataset_path("data", "processed", False) == "data/processed"


def test_hot_content_is_combined_before_the_shuffle(spark):
    """A third of the rows are copies of one article."""
    copies = F.when(F.col("id") % 3 == 0, F.lit("same text")).otherwise(F.concat(F.lit("text "), F.col("id").cast("string")))
    df = spark.range(0, 30_000, 1, 8).select("id", copies.alias("headline"))
    kept = curate.keep_first(df, ["headline"], "id")
    assert kept.count() == 20_001 and kept.where("headline = 'same text'").first()["id"] == 0
    assert curate.count_duplicates(df, "headline").first()[0] == 9_999
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange")  # the tree prints the top first


def test_filters_and_columns_reach_the_scan(spark, folder):
    from newslens.plans import load_all

    queries = load_all()
    by_category = queries["p8_category_filter"].run(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(source,src3)" in by_category
    by_month = queries["a8_counts_by_month"].run(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in by_month
