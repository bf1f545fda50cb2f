"""Scans, filters, duplicates, lookups and set operations."""

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from newslens.functions import text
from newslens.functions.wordlists import KEEP_WORDS, STOP_WORDS
from newslens.operators import curate, joins, reports, sampling
from newslens.plans.articles import articles, over_articles, text_articles
from newslens.plans.registry import query
from newslens.session import scratch_path
from newslens.sources import files
from newslens.sources.files import read_table, read_texts
from newslens.sources.schemas import ARTICLE_WITH_ID

FIELDS = ("doc_id", "headline", "short_description", "category", "date")
# The same word classes, spelled for the SQL side.
NOT_SPACE_SQL = r"[^\t-\r\x{1C}-\x{20}\x{85}\p{Z}]+"
# Merges that apply to the source names of the test tables.
SOURCE_MERGES = {"src1": "src0", "src2": "src0", "src7": "src6", "src13": "src12"}
MERGED_SQL = "CASE " + " ".join(
    f"WHEN category = '{a}' THEN '{b}'" for a, b in SOURCE_MERGES.items()
) + " ELSE category END"


def words_sql(column: str) -> str:
    return f"coalesce(len(regexp_extract_all({column}, '{NOT_SPACE_SQL}')), 0)"


ALL_ARTICLES_SQL = over_articles(
    "SELECT doc_id, headline, short_description, category, CAST(date AS VARCHAR) AS date FROM articles"
)


def _shown(df):
    return df.select("doc_id", "headline", "short_description", "category", F.col("date").cast("string").alias("date"))


@query("s1_json_scan", ALL_ARTICLES_SQL)
def json_scan(spark, folder):
    """JSON-lines articles written from the documents and read back by schema."""
    path = scratch_path(spark, "json")
    articles(spark, folder, *FIELDS).write.json(path)
    return _shown(files.read_articles_json(spark, path, ARTICLE_WITH_ID))


@query("s2_csv_scan", over_articles(
    "SELECT doc_id, nullif(headline, '') AS headline, nullif(short_description, '') AS short_description, "
    "category, CAST(date AS VARCHAR) AS date FROM articles"
))
def csv_scan(spark, folder):
    """CSV with embedded quotes and newlines; empty cells read as null."""
    path = scratch_path(spark, "csv")
    files.write_csv(articles(spark, folder, *FIELDS), path)
    return _shown(files.read_articles_csv(spark, path, ARTICLE_WITH_ID))


@query("s3_null_markers", """
SELECT event_id, CASE WHEN marked IN ('', 'NA', 'null', 'NULL', 'NaN') THEN NULL ELSE marked END AS event_type
FROM (SELECT event_id, CASE event_type WHEN 'error' THEN 'NA' WHEN 'click' THEN ' NaN ' ELSE event_type END AS raw,
             trim(raw) AS marked FROM events)""")
def null_markers(spark, folder):
    """Marker texts become null; a CSV round trip carries a byte-order mark."""
    marked = read_table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", "NA").when(F.col("event_type") == "click", " NaN ")
        .otherwise(F.col("event_type")).alias("event_type"),
    )
    path = scratch_path(spark, "marked")
    files.write_csv(marked, path, byte_order_mark=True)
    schema = StructType([StructField("event_id", LongType()), StructField("event_type", StringType())])
    return files.read_marked_csv(spark, path, schema)


@query("s4_profile", """
SELECT column_name, non_null, total FROM (
  SELECT count(*) AS total, count(doc_id) AS doc_id, count(text) AS text, count(lang) AS lang,
         count(source) AS source, count(n_chars) AS n_chars FROM documents)
UNPIVOT (non_null FOR column_name IN (doc_id, text, lang, source, n_chars))""")
def table_profile(spark, folder):
    return reports.profile(read_table(spark, folder, "documents"))


@query("s5_csv_sink", over_articles(
    "SELECT category, count(*) AS n, CAST(sum(length(headline) + length(short_description)) AS BIGINT) AS characters "
    "FROM articles GROUP BY category"
))
def csv_sink(spark, folder):
    """Articles survive a CSV write and a Parquet write unchanged."""
    csv, dataset = scratch_path(spark, "csv"), scratch_path(spark, "dataset")
    files.write_csv(articles(spark, folder, *FIELDS), csv)
    files.write_dataset(files.read_articles_csv(spark, csv, ARTICLE_WITH_ID), dataset, ("category",))
    size = F.length(text.or_empty(F.col("headline"))) + F.length(text.or_empty(F.col("short_description")))
    return spark.read.parquet(dataset).groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.sum(size).alias("characters")
    )


@query("s6_sample_naming", over_articles(
    "SELECT 'processed_sample' AS name, CAST(floor(count(*) * 0.1) AS BIGINT) AS n FROM articles UNION ALL "
    "SELECT 'processed' AS name, count(*) AS n FROM articles"
))
def sample_naming(spark, folder):
    """A sampled run and a full run of the same job land side by side."""
    base = scratch_path(spark, "named")
    rows = articles(spark, folder, "doc_id", "category")
    result = None
    for sampled in (True, False):
        path = files.dataset_path(base, "processed", sampled)
        files.write_dataset(sampling.sample(rows, "doc_id", 0.1) if sampled else rows, path)
        counted = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(path.rsplit("/", 1)[1]).alias("name"), "n"
        )
        result = counted if result is None else result.unionByName(counted)
    return result


@query("s9_category_mapping", over_articles(
    "SELECT CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS idx, category AS label "
    "FROM (SELECT DISTINCT category FROM articles WHERE category IS NOT NULL)"
))
def category_mapping(spark, folder):
    """The numbered categories, written and read back."""
    return joins.label_index(articles(spark, folder, "category"))


@query("p1_projection", over_articles("SELECT doc_id, category, headline FROM articles"))
def projection(spark, folder):
    """Helper columns dropped by name; the scan reads only what is left."""
    counted = curate.with_word_counts(articles(spark, folder))
    return counted.drop("headline_words", "description_words").select("doc_id", "category", "headline")


@query("p2_blank_rows", over_articles(
    "SELECT doc_id, category FROM articles WHERE headline = '' AND short_description = '' "
    "UNION ALL SELECT doc_id, 'half' FROM articles WHERE short_description = ''"
))
def blank_rows(spark, folder):
    rows = articles(spark, folder, "doc_id", "headline", "short_description", "category")
    half = rows.where(F.col("short_description") == "").select("doc_id", F.lit("half").alias("category"))
    return curate.blank_rows(rows).select("doc_id", "category").unionByName(half)


@query("p3_word_counts", over_articles(
    f"SELECT doc_id, {words_sql('headline')} AS headline_words, "
    f"{words_sql('short_description')} AS description_words FROM articles"
))
def word_counts(spark, folder):
    rows = text_articles(spark, folder, "doc_id", "headline", "short_description")
    return curate.with_word_counts(rows).drop("headline", "short_description")


@query("p4_short_filter", over_articles(
    f"SELECT doc_id, category FROM articles WHERE NOT ({words_sql('headline')} < 6 "
    f"AND {words_sql('short_description')} < 6)"
))
def short_filter(spark, folder):
    """Drop articles whose two texts both have fewer than six words."""
    rows = text_articles(spark, folder, "doc_id", "headline", "short_description", "category")
    return curate.drop_short(rows).select("doc_id", "category")


@query("p5_drop_incomplete", """
SELECT doc_id, source, quality FROM (
  SELECT d.doc_id, d.source, l.quality FROM documents d LEFT JOIN labels l USING (doc_id))
WHERE quality IS NOT NULL AND source IS NOT NULL""")
def drop_incomplete(spark, folder):
    labels = read_table(spark, folder, "labels").select("doc_id", "quality")
    rows = read_table(spark, folder, "documents").select("doc_id", "source").join(labels, "doc_id", "left")
    return curate.drop_incomplete(rows, "quality", "source")


@query("p6_only_text", "SELECT conv_id, turn, length(text) AS characters FROM conversations WHERE text IS NOT NULL")
def only_text(spark, folder):
    """With a fixed schema the type guard is a null filter."""
    rows = read_table(spark, folder, "conversations").where(F.col("text").isNotNull())
    return rows.select("conv_id", "turn", F.length("text").alias("characters"))


@query("p7_date_range", """
SELECT o_orderkey, o_orderpriority FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1993-03-01' AND DATE '1995-06-30'""")
def date_range(spark, folder):
    rows = read_table(spark, folder, "orders").withColumn("date", F.col("o_orderdate").cast("date"))
    return curate.in_date_range(rows, "1993-03-01", "1995-06-30").select("o_orderkey", "o_orderpriority")


@query("p8_category_filter", over_articles("SELECT doc_id, headline FROM articles WHERE category = 'src3'"))
def category_filter(spark, folder):
    return articles(spark, folder).where(F.col("category") == "src3").select("doc_id", "headline")


@query("p9_highlight", over_articles(
    "SELECT doc_id, category, category IN ('src0', 'src5') AS highlighted, TRUE AS unselected FROM articles"
))
def highlight(spark, folder):
    rows = curate.with_highlight(articles(spark, folder, "doc_id", "category"), ["src0", "src5"])
    return curate.with_highlight(rows.withColumnRenamed("highlighted", "kept"), []).select(
        "doc_id", "category", F.col("kept").alias("highlighted"), F.col("highlighted").alias("unselected")
    )


@query("p12_null_defaults", """
SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), '') AS quality FROM documents d LEFT JOIN labels l USING (doc_id)""")
def null_defaults(spark, folder):
    labels = read_table(spark, folder, "labels").select("doc_id", F.col("quality").cast("string"))
    rows = read_table(spark, folder, "documents").select("doc_id").join(labels, "doc_id", "left")
    return rows.select("doc_id", text.or_empty(F.col("quality")).alias("quality"))


@query("p14_bad_rows", """
SELECT CASE WHEN number IS NULL THEN 'number' WHEN kind NOT IN ('click', 'view') THEN 'kind' ELSE 'good' END AS outcome,
       count(*) AS n
FROM (SELECT TRY_CAST(CASE WHEN event_type = 'error' THEN 'x' ELSE json_extract_string(props, '$.k') END AS INTEGER) AS number,
             event_type AS kind FROM events) GROUP BY outcome""")
def bad_rows(spark, folder):
    """Rows that fail a check are set aside with the reason instead of failing the job."""
    parsed = read_table(spark, folder, "events").select(
        F.col("event_type").alias("kind"),
        F.when(F.col("event_type") == "error", "x").otherwise(F.get_json_object("props", "$.k"))
        .try_cast("int").alias("number"),
    )
    good, rejects = curate.split_rejects(
        parsed, {"number": F.col("number").isNotNull(), "kind": F.col("kind").isin("click", "view")}
    )
    counted = good.select(F.lit("good").alias("outcome")).unionByName(rejects.select(F.col("reason").alias("outcome")))
    return reports.value_counts(counted, "outcome")


@query("p15_request_errors", over_articles("""
SELECT doc_id, error IS NULL AS success, error FROM (
  SELECT doc_id, CASE WHEN h IS NULL OR d IS NULL THEN 'Headline and short_description must be strings'
    WHEN regexp_replace(h, '[\\t-\\r\\x{1C}-\\x{20}\\x{85}\\p{Z}]+', '', 'g') = ''
      OR regexp_replace(d, '[\\t-\\r\\x{1C}-\\x{20}\\x{85}\\p{Z}]+', '', 'g') = ''
    THEN 'Headline and short_description cannot be empty' END AS error
  FROM (SELECT doc_id, CASE WHEN category = 'src4' THEN NULL ELSE headline END AS h,
               CASE WHEN category = 'src9' THEN chr(160) || ' ' ELSE short_description END AS d FROM articles))"""))
def request_errors(spark, folder):
    """Requests with a missing or blank side carry an error instead of a result."""
    requests = articles(spark, folder, "doc_id", "headline", "short_description", "category").select(
        "doc_id",
        F.when(F.col("category") != "src4", F.col("headline")).alias("headline"),
        F.when(F.col("category") == "src9", F.lit("  ")).otherwise(F.col("short_description"))
        .alias("short_description"),
    )
    return curate.with_request_error(requests).select("doc_id", "success", "error")


@query("p16_category_merge", over_articles(f"SELECT doc_id, {MERGED_SQL} AS category FROM articles"))
def category_merge(spark, folder):
    return curate.merge_categories(articles(spark, folder, "doc_id", "category"), SOURCE_MERGES)


@query("p17_filter_bounds", over_articles(
    "SELECT category, CAST(min(b.lo) AS VARCHAR) AS min_date, CAST(max(b.hi) AS VARCHAR) AS max_date "
    "FROM articles, (SELECT min(date) AS lo, max(date) AS hi FROM articles) b GROUP BY category"
))
def filter_bounds(spark, folder):
    bounds = reports.filter_bounds(articles(spark, folder, "date", "category"))
    return bounds.select(
        "category", F.col("min_date").cast("string").alias("min_date"), F.col("max_date").cast("string").alias("max_date")
    )


@query("j1_label_lookup", over_articles("""
SELECT doc_id, category, idx AS category_id, n / (SELECT count(*) FROM articles) AS category_frequency
FROM articles LEFT JOIN (
  SELECT category, CAST(row_number() OVER (ORDER BY min(doc_id)) - 1 AS INTEGER) AS idx, count(*) AS n
  FROM articles WHERE category <> 'src6' GROUP BY category) USING (category)"""))
def label_lookup(spark, folder):
    """Label -> number and label -> frequency; an unknown label gives null."""
    rows = articles(spark, folder, "doc_id", "category")
    known = rows.where(F.col("category") != "src6")
    numbered = joins.attach_index(rows, joins.label_index(known, by="appearance", id_col="doc_id"))
    total = rows.agg(F.count(F.lit(1))).scalar()
    frequency = reports.value_counts(known, "category").select(
        "category", (F.col("n") / total).alias("category_frequency")
    )
    return numbered.join(frequency, "category", "left").select("doc_id", "category", "category_id", "category_frequency")


@query("j2_name_lookup", """
SELECT vec_id, coalesce(name, 'UNKNOWN') AS predicted FROM embeddings
LEFT JOIN (SELECT CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS label, lang AS name
           FROM (SELECT DISTINCT lang FROM documents)) USING (label)""")
def name_lookup(spark, folder):
    """Number -> name with a default for numbers outside the mapping."""
    names = joins.label_index(articles(spark, folder, "lang"), "lang")
    rows = read_table(spark, folder, "embeddings").select("vec_id", F.col("label").alias("pred"))
    return joins.attach_label(rows, names).select("vec_id", "predicted")


@query("j3_key_concat", over_articles(f"""
SELECT doc_id, category, length(text) AS text_length, {words_sql('text')} AS word_count, l.toxic
FROM articles LEFT JOIN labels l USING (doc_id)"""))
def key_concat(spark, folder):
    """Columns are put side by side by key, never by position."""
    rows = text_articles(spark, folder, "doc_id", "category", "text").select(
        "doc_id", "category", F.length("text").alias("text_length"), text.count_words(F.col("text")).alias("word_count")
    )
    return rows.join(read_table(spark, folder, "labels").select("doc_id", "toxic"), "doc_id", "left")


@query("j4_remove_rows", over_articles(
    f"SELECT doc_id FROM articles WHERE doc_id NOT IN (SELECT doc_id FROM articles WHERE {words_sql('headline')} < 6 "
    f"AND {words_sql('short_description')} < 6)"
))
def remove_rows(spark, folder):
    """The short filter in its anti-join form."""
    rows = text_articles(spark, folder, "doc_id", "headline", "short_description")
    return joins.without(rows, rows.where(curate.is_short(6)), "doc_id").select("doc_id")


_STOP_SQL = ", ".join("('" + w.replace("'", "''") + "')" for w in STOP_WORDS)
_KEEP_SQL = ", ".join(f"('{w}')" for w in KEEP_WORDS)


@query("j5_membership", over_articles(f"""
SELECT word, count(*) AS n, word IN (SELECT w FROM keep) AS kept FROM tokens
WHERE word NOT IN (SELECT w FROM stop) OR word IN (SELECT w FROM keep) GROUP BY word""",
    f"stop AS (SELECT * FROM (VALUES {_STOP_SQL}) AS t(w))", f"keep AS (SELECT * FROM (VALUES {_KEEP_SQL}) AS t(w))",
    rf"tokens AS (SELECT unnest(regexp_extract_all(lower(text), '{NOT_SPACE_SQL}')) AS word FROM articles)"))
def membership(spark, folder):
    """Words outside the stop list plus the keep words: anti and semi joins on counted words."""
    tokens = text_articles(spark, folder, "text").select(F.explode(text.words(F.lower("text"))).alias("word"))
    counted = reports.value_counts(tokens, "word")
    stop, keep = (F.broadcast(spark.createDataFrame([(w,) for w in ws], "word string")) for ws in (STOP_WORDS, KEEP_WORDS))  # constants
    stays = joins.members(counted, keep, "word").withColumn("kept", F.lit(True))
    others = joins.without(joins.without(counted, stop, "word"), keep, "word").withColumn("kept", F.lit(False))
    return stays.unionByName(others)


@query("j6_text_labels", """
SELECT doc_id, source AS category, quality, toxic FROM documents JOIN labels USING (doc_id)""")
def text_labels(spark, folder):
    rows = read_table(spark, folder, "documents").select("doc_id", F.col("source").alias("category"))
    return rows.join(read_table(spark, folder, "labels"), "doc_id").select("doc_id", "category", "quality", "toxic")


@query("a1_duplicate_count", "SELECT count(*) - count(DISTINCT (text, lang)) AS duplicated_rows FROM documents")
def duplicate_count(spark, folder):
    return curate.count_duplicates(read_table(spark, folder, "documents"), "text", "lang")


@query("a2_keep_first", """
SELECT doc_id, source FROM documents
QUALIFY row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) = 1""")
def keep_first(spark, folder):
    rows = read_table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return curate.keep_first(rows, ["text", "lang"], "doc_id").select("doc_id", "source")


@query("a2_drop_duplicates", "SELECT DISTINCT source, lang, n_chars FROM documents")
def drop_duplicates(spark, folder):
    return read_table(spark, folder, "documents").select("source", "lang", "n_chars").dropDuplicates()


@query("a3_null_counts", """
SELECT column_name, nulls FROM (
  SELECT count(*) - count(doc_id) AS doc_id, count(*) - count(quality) AS quality, count(*) - count(toxic) AS toxic
  FROM documents LEFT JOIN labels USING (doc_id))
UNPIVOT (nulls FOR column_name IN (doc_id, quality, toxic))""")
def null_counts(spark, folder):
    labels = read_table(spark, folder, "labels")
    return reports.null_counts(read_table(spark, folder, "documents").select("doc_id").join(labels, "doc_id", "left"))


@query("k1_sorted_categories", over_articles("SELECT DISTINCT category FROM articles"))
def sorted_categories(spark, folder):
    return articles(spark, folder, "category").distinct().orderBy("category")


@query("k2_head", over_articles("SELECT doc_id, headline FROM articles ORDER BY doc_id LIMIT 10"))
def head(spark, folder):
    return articles(spark, folder, "doc_id", "headline").orderBy("doc_id").limit(10)


@query("k2_top_values", over_articles(
    "SELECT lang, count(*) AS n FROM articles GROUP BY lang ORDER BY n DESC, lang LIMIT 5"
))
def top_values(spark, folder):
    return reports.ranked_counts(articles(spark, folder, "lang"), "lang", top=5)


@query("u1_unique_words", over_articles(
    rf"SELECT doc_id, len(list_distinct(regexp_extract_all(text, '{NOT_SPACE_SQL}'))) AS unique_words FROM articles"
))
def unique_words(spark, folder):
    rows = text_articles(spark, folder, "doc_id", "text")
    return rows.select("doc_id", text.count_unique_words(F.col("text")).alias("unique_words"))


@query("u2_word_difference", f"""
WITH words AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{NOT_SPACE_SQL}')) AS word FROM conversations)
SELECT word FROM words WHERE word IN (SELECT w FROM (VALUES {_STOP_SQL}) AS t(w))
EXCEPT SELECT w FROM (VALUES {_KEEP_SQL}) AS t(w)""")
def word_difference(spark, folder):
    """Stop words minus keep words, among the words that occur."""
    words = read_texts(spark, folder, "conversations", "text").select(
        F.explode(text.words(F.lower("text"))).alias("word")
    ).distinct()
    stop, keep = (F.broadcast(spark.createDataFrame([(w,) for w in ws], "word string")) for ws in (STOP_WORDS, KEEP_WORDS))  # constants
    return joins.without(joins.members(words, stop, "word"), keep, "word")


@query("u3_merge_sources", """
SELECT origin, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS characters FROM (
  SELECT 'documents' AS origin, text FROM documents UNION ALL SELECT 'conversations', text FROM conversations
  UNION ALL SELECT 'benchmark', text FROM benchmark) GROUP BY origin""")
def merge_sources(spark, folder):
    """Several sources as one frame, by column name."""
    merged = None
    for name in ("documents", "conversations", "benchmark"):
        part = read_table(spark, folder, name).select(F.lit(name).alias("origin"), "text")
        merged = part if merged is None else merged.unionByName(part)
    return merged.groupBy("origin").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("characters"))
