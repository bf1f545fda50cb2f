"""Scalar text and date functions, each over whole texts."""

from pyspark.sql import functions as F

from newslens.functions import text
from newslens.functions.wordlists import CONTRACTIONS
from newslens.plans.articles import articles, over_articles, text_articles
from newslens.plans.noise import CLEANING_NOISE, noisy, noisy_sql, quote
from newslens.plans.registry import query
from newslens.sources.files import read_table, read_texts

SPACE_SQL = r"\t-\r\x{1C}-\x{20}\x{85}\p{Z}"


def strip_sql(c: str) -> str:
    return rf"regexp_replace({c}, '\A[{SPACE_SQL}]+|[{SPACE_SQL}]+\z', '', 'g')"


def contractions_sql(c: str) -> str:
    for short, long in CONTRACTIONS:
        c = f"replace({c}, {quote(short)}, {quote(long)})"
    return c


def no_urls_sql(c: str) -> str:
    return rf"regexp_replace({c}, 'https?://[^{SPACE_SQL}]+|www\.[^{SPACE_SQL}]+', '', 'g')"


def no_tags_sql(c: str) -> str:
    return f"regexp_replace({c}, '<.*?>', '', 'g')"


def plain_sql(c: str) -> str:
    return rf"regexp_replace({c}, '[^a-zA-Z0-9''{SPACE_SQL}.,!?\x22-]', '', 'g')"


def collapse_sql(c: str) -> str:
    return rf"trim(regexp_replace({c}, '[{SPACE_SQL}]+', ' ', 'g'))"


def scrub_sql(c: str) -> str:
    return collapse_sql(plain_sql(no_tags_sql(no_urls_sql(c))))


NOISY_SQL = f"noisy AS (SELECT doc_id, {noisy_sql('text', CLEANING_NOISE)} AS text FROM documents)"


def _noisy(spark, folder):
    return read_texts(spark, folder, "documents", "doc_id", "text").withColumn(
        "text", noisy(F.col("text"), CLEANING_NOISE)
    )


def _digest(df, column, *keep):
    """Whole texts are compared by length and digest."""
    return df.select(*keep, F.length(column).alias("characters"), F.md5(column).alias("digest"))


def _digest_sql(expression: str, keep: str, source: str) -> str:
    return (f"SELECT {keep}, length(v) AS characters, md5(v) AS digest "
            f"FROM (SELECT {keep}, {expression} AS v FROM {source})")


@query("f1_combine", over_articles(_digest_sql(strip_sql("headline || ' . ' || short_description"), "doc_id", "articles")))
def combine(spark, folder):
    rows = text_articles(spark, folder)
    return _digest(rows.withColumn("v", text.combine(F.col("headline"), F.col("short_description"))), "v", "doc_id")


@query("f2_lower", _digest_sql("lower(text)", "doc_id", "documents"))
def lower(spark, folder):
    return _digest(read_texts(spark, folder, "documents", "doc_id", "text").withColumn("v", F.lower("text")), "v", "doc_id")


@query("f3_contractions", "WITH " + NOISY_SQL + _digest_sql(contractions_sql("lower(text)"), "doc_id", "noisy"))
def contractions(spark, folder):
    return _digest(_noisy(spark, folder).withColumn("v", text.expand_contractions(F.lower("text"))), "v", "doc_id")


@query("f4_quotes", "WITH " + NOISY_SQL + f"""
SELECT doc_id, len(q) AS quotes, array_to_string(q, '~') AS quoted
FROM (SELECT doc_id, regexp_extract_all({contractions_sql('lower(text)')}, '"([^"]*)"', 1) AS q FROM noisy)""")
def quotes(spark, folder):
    rows = _noisy(spark, folder).withColumn("q", text.quoted_spans(text.expand_contractions(F.lower("text"))))
    return rows.select("doc_id", F.size("q").alias("quotes"), F.array_join("q", "~").alias("quoted"))


@query("f5_urls", "WITH " + NOISY_SQL + _digest_sql(no_urls_sql("lower(text)"), "doc_id", "noisy"))
def urls(spark, folder):
    return _digest(_noisy(spark, folder).withColumn("v", text.remove_urls(F.lower("text"))), "v", "doc_id")


@query("f5_page_urls", _digest_sql(no_urls_sql("'see ' || url || ' and ' || url"), "page_id", "pages"))
def page_urls(spark, folder):
    rows = read_texts(spark, folder, "pages", "page_id", "url")
    seen = F.concat(F.lit("see "), F.col("url"), F.lit(" and "), F.col("url"))
    return _digest(rows.withColumn("v", text.remove_urls(seen)), "v", "page_id")


@query("f6_tags", _digest_sql(no_tags_sql("html"), "page_id", "pages"))
def tags(spark, folder):
    rows = read_texts(spark, folder, "pages", "page_id", "html")
    return _digest(rows.withColumn("v", text.remove_tags(F.col("html"))), "v", "page_id")


@query("f7_plain_characters", _digest_sql(plain_sql("html"), "page_id", "pages"))
def plain_characters(spark, folder):
    rows = read_texts(spark, folder, "pages", "page_id", "html")
    return _digest(rows.withColumn("v", text.keep_plain_characters(F.col("html"))), "v", "page_id")


@query("f8_collapse_spaces", "WITH " + NOISY_SQL + _digest_sql(collapse_sql("text"), "doc_id", "noisy"))
def collapse_spaces(spark, folder):
    return _digest(_noisy(spark, folder).withColumn("v", text.collapse_spaces(F.col("text"))), "v", "doc_id")


@query("f8_clean_text", "WITH " + NOISY_SQL + _digest_sql(scrub_sql(contractions_sql("lower(text)")), "doc_id", "noisy"))
def clean_text(spark, folder):
    """The whole cleaning order in one expression."""
    cleaned = text.scrub(text.expand_contractions(F.lower("text")))
    return _digest(_noisy(spark, folder).withColumn("v", cleaned), "v", "doc_id")


@query("f9_length", "SELECT doc_id, length(text) AS text_length FROM documents")
def length(spark, folder):
    return read_table(spark, folder, "documents").select("doc_id", F.length("text").alias("text_length"))


@query("f10_word_count", rf"""
SELECT conv_id, turn, len(regexp_extract_all(text, '[^{SPACE_SQL}]+')) AS word_count FROM conversations""")
def word_count(spark, folder):
    rows = read_texts(spark, folder, "conversations", "conv_id", "turn", "text")
    return rows.select("conv_id", "turn", text.count_words(F.col("text")).alias("word_count"))


@query("f11_parse_date", """
SELECT o_orderkey, CAST(TRY_CAST(raw AS TIMESTAMP) AS VARCHAR) AS parsed FROM (
  SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 'no date' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS raw
  FROM orders)""")
def parse_date(spark, folder):
    """Text to timestamp; what is no date becomes null."""
    raw = F.when(F.col("o_orderpriority") == "5-LOW", "no date").otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    )
    parsed = F.try_to_timestamp(raw, F.lit("yyyy-MM-dd HH:mm:ss"))
    return read_table(spark, folder, "orders").select(
        "o_orderkey", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("parsed")
    )


@query("f12_year_month", "SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month FROM orders")
def year_month(spark, folder):
    return read_table(spark, folder, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )


@query("f13_month_label", over_articles("SELECT doc_id, strftime(date, '%Y-%m') AS year_month FROM articles"))
def month_label(spark, folder):
    rows = articles(spark, folder, "doc_id", "date")
    return rows.select("doc_id", text.month_label(F.col("date")).alias("year_month"))


@query("f14_default_date", over_articles("""
SELECT doc_id, CASE lang WHEN 'fr' THEN '2024-05-06' WHEN 'de' THEN '2024-05-06' ELSE CAST(date AS VARCHAR) END AS date
FROM articles"""))
def default_date(spark, folder):
    given = F.when(F.col("lang") == "fr", None).when(F.col("lang") == "de", "").otherwise(F.col("date").cast("string"))
    return articles(spark, folder, "doc_id", "lang", "date").select(
        "doc_id", text.date_or_today(given, "2024-05-06").alias("date")
    )


@query("f15_sentiment_label", """
SELECT vec_id, CASE WHEN c >= 0.05 THEN 'positive' WHEN c <= -0.05 THEN 'negative' ELSE 'neutral' END AS sentiment
FROM (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS c FROM embeddings)""")
def sentiment_label(spark, folder):
    score = F.col("embedding")[0].cast("double")
    return read_table(spark, folder, "embeddings").select("vec_id", text.sentiment_label(score).alias("sentiment"))
