"""Category, time, sentiment and part-of-speech reports."""

from pyspark.sql import Window, functions as F

from newslens.functions import text
from newslens.functions.sentiment import SentimentScorer
from newslens.functions.wordlists import POS_KEYS
from newslens.operators import annotate as annotate_ops
from newslens.operators import curate, reports, sketches
from newslens.plans.annotation import (
    ANN_CTES, COUNTS_SQL, MOOD_SQL, POS_SQL, QUOTES_SQL, annotated, moody, sentiment_ctes,
)
from newslens.plans.articles import articles, over_articles, text_articles
from newslens.plans.curation import NOT_SPACE_SQL, words_sql
from newslens.plans.registry import query
from newslens.session import materialize
from newslens.sources.files import read_table

YEARS = list(range(2012, 2023))
ORDER_YEARS = list(range(1992, 1999))
MEASURES = POS_KEYS[:5]


@query("flagship_monthly_categories", over_articles(f"""
SELECT strftime(date, '%Y-%m') AS year_month, category, count(*) AS n FROM (
  SELECT headline, short_description, category, date, min(doc_id) AS doc_id FROM articles
  WHERE NOT ({words_sql('headline')} < 6 AND {words_sql('short_description')} < 6)
  GROUP BY headline, short_description, category, date) GROUP BY ALL"""))
def monthly_categories(spark, folder):
    """Curate (short filter, exact deduplication), then count categories by month."""
    rows = text_articles(spark, folder, "doc_id", "headline", "short_description", "category", "date")
    kept = curate.keep_first(
        curate.drop_short(rows), ["headline", "short_description", "category", "date"], "doc_id"
    )
    return reports.counts_by_month(kept)


@query("a4_value_counts", over_articles("SELECT category, count(*) AS n FROM articles WHERE category IS NOT NULL GROUP BY category"))
def value_counts(spark, folder):
    return reports.ranked_counts(articles(spark, folder, "category"), "category")


@query("a5_category_shares", """
SELECT quality AS category, count(*) AS n, count(*) / (SELECT count(*) FROM documents) AS share
FROM documents JOIN labels USING (doc_id) GROUP BY quality""")
def category_shares(spark, folder):
    """Shares are of all rows; rows without a category have no row of their own."""
    labels = read_table(spark, folder, "labels").select("doc_id", F.col("quality").alias("category"))
    rows = read_table(spark, folder, "documents").select("doc_id").join(labels, "doc_id", "left")
    return reports.category_shares(rows.select("category"))


@query("a6_mean_length", over_articles("SELECT category, round(avg(length(text)), 6) AS avg_length FROM articles GROUP BY category"))
def mean_length(spark, folder):
    rows = reports.mean_length(articles(spark, folder, "category", "text"))
    return rows.select("category", F.round("avg_length", 6).alias("avg_length"))


@query("a7_counts_by_year", """
SELECT p.o_orderpriority AS category, y.year, count(o.o_orderkey) AS n
FROM (SELECT DISTINCT o_orderpriority FROM orders) p CROSS JOIN (SELECT CAST(unnest(range(1992, 1999)) AS INTEGER) AS year) y
LEFT JOIN orders o ON o.o_orderpriority = p.o_orderpriority AND year(o.o_orderdate) = y.year GROUP BY ALL""")
def counts_by_year(spark, folder):
    rows = read_table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("category"), F.col("o_orderdate").alias("date")
    )
    return reports.counts_by_year_long(rows, ORDER_YEARS)


@query("a7_counts_by_year_wide", over_articles("SELECT category, " + ", ".join(
    f'count(*) FILTER (year(date) = {y}) AS "{y}"' for y in YEARS) + " FROM articles GROUP BY category"))
def counts_by_year_wide(spark, folder):
    return reports.counts_by_year(articles(spark, folder, "category", "date"), YEARS)


@query("a8_counts_by_month", over_articles(
    "SELECT strftime(date, '%Y-%m') AS year_month, category, count(*) AS n FROM articles GROUP BY ALL"))
def counts_by_month(spark, folder):
    return reports.counts_by_month(articles(spark, folder, "category", "date"))


@query("a8_order_months", """
SELECT strftime(o_orderdate, '%Y-%m') AS year_month, o_orderpriority AS category, count(*) AS n FROM orders GROUP BY ALL""")
def order_months(spark, folder):
    rows = read_table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("category"), F.col("o_orderdate").alias("date")
    )
    return reports.counts_by_month(rows)


LABELLED_SQL = """labelled AS (SELECT doc_id, category, text, CASE WHEN compound >= 0.05 THEN 'positive'
  WHEN compound <= -0.05 THEN 'negative' ELSE 'neutral' END AS sentiment FROM scored JOIN moody USING (doc_id))"""
MOOD_CTES = [MOOD_SQL, *sentiment_ctes("doc_id", "moody", "text"), LABELLED_SQL]


def labelled(spark, folder):
    scored = SentimentScorer().score(moody(spark, folder, "doc_id", "category", "text"), "text")
    return scored.withColumn("sentiment", text.sentiment_label(F.col("compound")))


@query("a9_category_sentiment", over_articles(
    "SELECT category, sentiment, count(*) AS n FROM labelled GROUP BY ALL", *MOOD_CTES))
def category_sentiment(spark, folder):
    return reports.value_counts(labelled(spark, folder), "category", "sentiment")


@query("a9_category_sentiment_text", over_articles(
    "SELECT category, md5(text) AS text_md5, count(*) AS n FROM moody GROUP BY ALL", MOOD_SQL))
def category_sentiment_text(spark, folder):
    """The variant grouped by the raw sentiment text, by its digest, so that no text is shuffled."""
    rows = moody(spark, folder, "category", F.md5("text").alias("text_md5"))
    return reports.value_counts(rows, "category", "text_md5")


@query("a10_sentiment_share", over_articles("""
SELECT 'all' AS scope, sentiment, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM labelled), 6) AS percent
FROM labelled GROUP BY sentiment UNION ALL
SELECT 'src3', sentiment, count(*), round(100.0 * count(*) / (SELECT count(*) FROM labelled WHERE category = 'src3'), 6)
FROM labelled WHERE category = 'src3' GROUP BY sentiment""", *MOOD_CTES))
def sentiment_share(spark, folder):
    """Percent per label, overall and for one category, from one grouped pass."""
    # stored, as it is used four times
    grouped = materialize(reports.value_counts(labelled(spark, folder), "category", "sentiment"), "grouped")
    scopes = grouped.groupBy("sentiment").agg(F.sum("n").alias("n")).select(F.lit("all").alias("scope"), "*")
    one = grouped.where(F.col("category") == "src3").select(F.lit("src3").alias("scope"), "sentiment", "n")
    both = [reports.with_share(part, "percent", 100.0) for part in (scopes, one)]
    return both[0].unionByName(both[1]).withColumn("percent", F.round("percent", 6))


def _flat(spark, folder):
    return annotate_ops.flatten_features(annotated(spark, folder)).select("doc_id", "category", "date", *POS_KEYS)


FLAT_CTES = [*ANN_CTES, COUNTS_SQL, QUOTES_SQL, f"""flat AS (SELECT f.doc_id, f.category, a.date, {POS_SQL} FROM full_text f
  JOIN articles a USING (doc_id) JOIN quoted USING (doc_id) LEFT JOIN counts USING (doc_id))"""]


@query("a11_pos_totals", over_articles(
    "SELECT category, measure, CAST(sum(v) AS BIGINT) AS total FROM (UNPIVOT flat ON " + ", ".join(MEASURES)
    + " INTO NAME measure VALUE v) GROUP BY ALL", *FLAT_CTES))
def pos_totals(spark, folder):
    return reports.pos_totals(_flat(spark, folder), MEASURES)


@query("a12_adjectives_over_time", over_articles(
    "SELECT CAST(date AS VARCHAR) AS date, CAST(sum(adj_count) AS BIGINT) AS total, round(avg(adj_count), 6) AS mean "
    "FROM flat GROUP BY date", *FLAT_CTES))
def adjectives_over_time(spark, folder):
    rows = reports.measure_over_time(_flat(spark, folder), "adj_count")
    return rows.select(F.col("date").cast("string").alias("date"), "total", F.round("mean", 6).alias("mean"))


@query("a13_adjectives_and_nouns", over_articles(
    "SELECT category, count(*) AS n, round(avg(adj_count), 6) AS mean_x, round(avg(noun_count), 6) AS mean_y, "
    "round(covar_pop(adj_count, noun_count), 5) AS covariance, round(corr(adj_count, noun_count), 6) AS correlation "
    "FROM flat GROUP BY category", *FLAT_CTES))
def adjectives_and_nouns(spark, folder):
    rows = reports.measure_relation(_flat(spark, folder), "adj_count", "noun_count")
    return rows.select("category", "n", F.round("mean_x", 6).alias("mean_x"), F.round("mean_y", 6).alias("mean_y"),
                       F.round("covariance", 5).alias("covariance"), F.round("correlation", 6).alias("correlation"))


@query("a14_word_cloud_terms", rf"""
SELECT term, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '{NOT_SPACE_SQL}')) AS term FROM documents)
GROUP BY term ORDER BY n DESC, term LIMIT 200""")
def word_cloud_terms(spark, folder):
    """The 200 most frequent words."""
    return reports.word_frequencies(text_articles(spark, folder, "text"), "text", 200)


@query("a15_overview", over_articles(f"""
SELECT count(*) AS articles, count(DISTINCT category) AS categories, round(avg(length(text)), 6) AS mean_length,
       round(avg({words_sql('text')}), 6) AS mean_words FROM articles"""))
def overview(spark, folder):
    rows = text_articles(spark, folder, "category", "text")
    stats = reports.overview(rows, "category", F.length("text"), text.count_words(F.col("text")))
    return stats.withColumns({c: F.round(c, 6) for c in ("mean_length", "mean_words")})


def _sketched(spark, folder):
    """The stored sketches of all documents, by day and category."""
    return materialize(sketches.daily_sketches(text_articles(spark, folder, "text", "date", "category")), "sketches")


@query("u1_distinct_words_in_range", over_articles(rf"""
SELECT category, CAST(count(DISTINCT doc_id) AS BIGINT) AS articles, count(term) AS words, round(any_value(mean_length), 6) AS mean_length, TRUE AS within_bound
FROM (SELECT doc_id, category, avg(length(text)) OVER (PARTITION BY category) AS mean_length, text FROM articles WHERE date BETWEEN DATE '2012-02-01' AND DATE '2013-12-31')
LEFT JOIN (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{NOT_SPACE_SQL}')) AS term FROM articles) USING (doc_id)
GROUP BY category"""))
def distinct_words_in_range(spark, folder):
    """Twenty-three months united from daily sketches: exact counts, and distinct words within four standard errors of the exact number."""
    chosen = lambda c: F.col(c).between(F.lit("2012-02-01").cast("date"), F.lit("2013-12-31").cast("date"))
    found = sketches.distinct_words(sketches.united(_sketched(spark, folder), "category", within=chosen("day"))).drop("frequent")
    rows = text_articles(spark, folder, "text", "date", "category").where(chosen("date"))
    exact = rows.select("category", F.explode(text.words(F.lower("text"))).alias("term")).groupBy("category").agg(F.countDistinct("term").alias("exact"))
    off = F.abs(F.col("distinct_words") - F.col("exact")) <= 4 * 1.04 / 2 ** (sketches.LG_REGISTERS / 2) * F.col("exact") + 1
    return found.join(exact, "category").select("category", "articles", "words", F.round("mean_length", 6).alias("mean_length"), off.alias("within_bound"))


@query("a14_words_from_sketches", rf"""
SELECT term, count(*) AS n, TRUE AS within_bound FROM (SELECT unnest(regexp_extract_all(lower(text), '{{NOT_SPACE}}')) AS term FROM documents)
GROUP BY term ORDER BY n DESC, term LIMIT 20""".replace("{NOT_SPACE}", NOT_SPACE_SQL))
def words_from_sketches(spark, folder):
    """The twenty most frequent words, exactly, and whether the united daily sketches know each within their bound."""
    whole = sketches.united(_sketched(spark, folder))
    bound = whole.select(F.col("words") * 3.5 / sketches.ITEMS).scalar()
    near = sketches.frequent_words(whole, 200).withColumnRenamed("n", "near")
    exact = reports.word_frequencies(text_articles(spark, folder, "text"), "text", 20)
    return exact.join(near, "term", "left").select(
        "term", "n", (F.abs(F.coalesce("near", F.lit(0)) - F.col("n")) <= bound + 1).alias("within_bound"))


@query("m29_category_statistics", over_articles(f"""
SELECT category, count(*) AS n, count(*) / (SELECT count(*) FROM articles) AS frequency,
       round(avg(length(text)), 6) AS avg_length, """ + ", ".join(
    f'count(*) FILTER (year(date) = {y}) AS "{y}"' for y in YEARS) + " FROM articles GROUP BY category"))
def category_statistics(spark, folder):
    """Count, frequency, mean length and yearly counts in one row per category."""
    rows = articles(spark, folder, "category", "date", "text")
    yearly = [F.sum((F.year("date") == y).cast("bigint")).alias(str(y)) for y in YEARS]
    grouped = rows.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(F.length("text")), 6).alias("avg_length"), *yearly)
    # one row per category from here on
    return grouped.withColumn("frequency", F.col("n") / F.sum("n").over(Window.partitionBy()))


@query("m31_validation_summary", over_articles(f"""
SELECT 'articles' AS check_name, CAST(count(*) AS DOUBLE) AS value FROM articles
UNION ALL SELECT 'categories', count(DISTINCT category) FROM articles
UNION ALL SELECT 'mean_length', round(avg(length(text)), 6) FROM articles
UNION ALL SELECT 'mean_words', round(avg({words_sql('text')}), 6) FROM articles
UNION ALL SELECT 'nulls: ' || 'quality', count(*) FROM articles LEFT JOIN labels USING (doc_id) WHERE quality IS NULL HAVING count(*) > 0
UNION ALL (SELECT 'top: ' || category, count(*) AS n FROM articles GROUP BY category ORDER BY n DESC, category LIMIT 5)"""))
def validation_summary(spark, folder):
    """Totals, columns with nulls and the five largest categories: one pass over the texts, one over the ids."""
    rows = text_articles(spark, folder, "category", "text")
    grouped = reports.overview_by_category(rows, "category", F.length("text"), text.count_words(F.col("text")))
    grouped = materialize(grouped, "categories")  # a row per category from here on
    total = F.sum("n").cast("double")
    totals = grouped.agg(F.array(*(F.struct(F.lit(name).alias("check_name"), value.alias("value")) for name, value in (
        ("articles", total), ("categories", F.count("category").cast("double")),
        ("mean_length", F.round(F.sum("length") / total, 6)), ("mean_words", F.round(F.sum("words") / total, 6))))).alias("rows")).select(F.inline("rows"))
    top = grouped.where("category IS NOT NULL").orderBy(F.desc("n"), "category").limit(5).select(
        F.concat(F.lit("top: "), "category").alias("check_name"), F.col("n").cast("double").alias("value"))
    quality = read_table(spark, folder, "labels").select("doc_id", "quality")
    joined = articles(spark, folder, "doc_id", "category").join(quality, "doc_id", "left")
    nulls = reports.columns_with_nulls(joined).select(
        F.concat(F.lit("nulls: "), "column_name").alias("check_name"), F.col("nulls").cast("double").alias("value"))
    return totals.unionByName(nulls).unionByName(top)
