"""Vocabularies, n-grams, TF-IDF, chi-square and model-frame preparation."""

from pyspark.sql import functions as F

from newslens.functions import text
from newslens.functions.dictionary import Dictionary
from newslens.functions.wordlists import CLS_ID, PAD_ID, SEP_ID, STOP_WORDS, UNK_ID
from newslens.operators import features, joins, reports
from newslens.operators import terms as ops
from newslens.operators.terms import PLAIN, SUBLINEAR, TermSettings, Vocabulary
from newslens.plans.annotation import values_sql
from newslens.plans.articles import over_articles, text_articles
from newslens.plans.curation import NOT_SPACE_SQL, words_sql
from newslens.plans.registry import query

BASIC, TUNED = ops.BASIC, ops.TUNED
TERM_SQL = r"[\p{L}\p{N}_]{2,}"
STOPS_SQL = values_sql("stops", "w", [(w,) for w in STOP_WORDS])


def term_ctes(settings: TermSettings, source: str = "documents") -> list[str]:
    """CTEs tokens -> terms(doc_id, term) -> counted(doc_id, term, tf) -> vocab(idx, term, tf, df, idf)."""
    return [
        STOPS_SQL,
        f"token_lists AS (SELECT doc_id, regexp_extract_all(lower(text), '{TERM_SQL}') AS l FROM {source})",
        "all_tokens AS (SELECT doc_id, unnest(l) AS w1, unnest(range(len(l))) AS pos FROM token_lists)",
        "kept_tokens AS (SELECT * FROM all_tokens WHERE w1 NOT IN (SELECT w FROM stops))",
        "neighbours AS (SELECT doc_id, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM kept_tokens "
        "WINDOW o AS (PARTITION BY doc_id ORDER BY pos))",
        "terms AS (SELECT doc_id, w1 AS term FROM neighbours UNION ALL "
        "SELECT doc_id, w1 || ' ' || w2 FROM neighbours WHERE w2 IS NOT NULL UNION ALL "
        "SELECT doc_id, w1 || ' ' || w2 || ' ' || w3 FROM neighbours WHERE w3 IS NOT NULL)",
        "counted AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL)",
        f"total AS (SELECT count(*) AS n FROM {source})",
        f"kept_terms AS (SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM counted GROUP BY term "
        f"HAVING df >= {settings.min_df} AND df <= {settings.max_df} * (SELECT n FROM total) "
        f"ORDER BY tf DESC, term{f' LIMIT {settings.max_features}' if settings.max_features else ''})",
        "vocab AS (SELECT CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, term, tf, df, "
        "ln((1 + (SELECT n FROM total)) / (1.0 + df)) + 1 AS idf FROM kept_terms)",
    ]


def weight_ctes(frequency: str) -> list[str]:
    return [
        f"weighted AS (SELECT doc_id, idx, term, {frequency} * idf AS w FROM counted c JOIN vocab v USING (term))",
        "normed AS (SELECT doc_id, idx, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM weighted)",
    ]


def texts(spark, folder):
    return text_articles(spark, folder, "doc_id", "text", "category", "lang")


def _rounded(df):
    return df.withColumn("idf", F.round("idf", 6))


VOCAB_SQL = "SELECT idx, term, tf, df, round(idf, 6) AS idf FROM vocab"


@query("w4_ngrams", "WITH " + ", ".join(term_ctes(BASIC)) + """
SELECT len(string_split(term, ' ')) AS words, count(*) AS n, count(DISTINCT term) AS terms FROM terms GROUP BY words""")
def ngrams(spark, folder):
    """1- to 3-grams after stop-word removal."""
    stats = ops.term_statistics(texts(spark, folder), "text", BASIC)
    by_size = stats.groupBy((F.regexp_count("term", F.lit(" ")) + 1).alias("words"))
    return by_size.agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("terms"))


@query("k4_vocabulary_cap", "WITH " + ", ".join(term_ctes(TUNED)) + VOCAB_SQL)
def vocabulary_cap(spark, folder):
    """The most frequent terms, by counting every n-gram."""
    return _rounded(ops.vocabulary_table(texts(spark, folder), "text", TUNED, prune=False))


@query("k4_pruned_vocabulary", "WITH " + ", ".join(term_ctes(TUNED)) + VOCAB_SQL)
def pruned_vocabulary(spark, folder):
    """The same table without shuffling the n-grams that cannot be kept."""
    return _rounded(ops.vocabulary_table(texts(spark, folder), "text", TUNED, prune=True))


@query("m4_vocabulary", "WITH " + ", ".join(term_ctes(BASIC)) + VOCAB_SQL)
def vocabulary(spark, folder):
    return _rounded(ops.vocabulary_table(texts(spark, folder), "text", BASIC))


@query("k5_first_columns", "WITH " + ", ".join(term_ctes(TUNED)) + """
SELECT 'alphabet' AS chosen_by, term FROM vocab WHERE idx < 1000 UNION ALL
(SELECT 'frequency', term FROM vocab ORDER BY tf DESC, term LIMIT 1000)""")
def first_columns(spark, folder):
    """The first 1,000 vocabulary columns, alphabetically or by frequency."""
    table = ops.vocabulary_table(texts(spark, folder), "text", TUNED)
    parts = [
        ops.first_columns(table, 1000, by).select(F.lit(by).alias("chosen_by"), "term")
        for by in ("alphabet", "frequency")
    ]
    return parts[0].unionByName(parts[1])


@query("m1_term_counts", "WITH " + ", ".join(term_ctes(TUNED)) + """
SELECT doc_id, idx, tf FROM counted JOIN (SELECT idx, term FROM vocab) USING (term)""")
def term_counts(spark, folder):
    rows = texts(spark, folder)
    fitted = Vocabulary.fit(rows, "text", TUNED)
    return ops.count_entries(fitted.count(rows, "text"), "counts", "doc_id").withColumn("tf", F.col("tf").cast("bigint"))


def _tfidf(spark, folder, settings, weighting):
    rows = texts(spark, folder)
    fitted = Vocabulary.fit(rows, "text", settings)
    entries = fitted.weigh(fitted.count(rows, "text"), "counts", "entries", weighting)
    return ops.tfidf_long(entries, "entries", "doc_id").withColumn("weight", F.round("weight", 6))


@query("m2_tfidf", "WITH " + ", ".join([*term_ctes(BASIC), *weight_ctes("c.tf")])
       + "SELECT doc_id, idx, round(weight, 6) AS weight FROM normed")
def tfidf(spark, folder):
    return _tfidf(spark, folder, BASIC, PLAIN)


@query("m3_tfidf_sublinear", "WITH " + ", ".join([*term_ctes(TUNED), *weight_ctes("(1 + ln(c.tf))")])
       + "SELECT doc_id, idx, round(weight, 6) AS weight FROM normed")
def tfidf_sublinear(spark, folder):
    return _tfidf(spark, folder, TUNED, SUBLINEAR)


@query("m2_tfidf_by_join", "WITH " + ", ".join([*term_ctes(TermSettings(min_df=2, max_features=None)), *weight_ctes("c.tf")])
       + "SELECT doc_id, term, round(weight, 6) AS weight FROM normed")
def tfidf_by_join(spark, folder):
    """The relational form, with every term of two documents or more."""
    rows, settings = texts(spark, folder), TermSettings(min_df=2, max_features=None)
    table = ops.vocabulary_table(rows, "text", settings)
    return ops.tfidf_by_join(rows, "doc_id", "text", table, settings).withColumn("weight", F.round("weight", 6))


CHI_CTES = [
    "labelled AS (SELECT doc_id, lang AS y FROM documents)",
    "entries AS (SELECT c.doc_id, v.idx, y, c.tf FROM counted c JOIN vocab v USING (term) JOIN labelled USING (doc_id))",
    "observed AS (SELECT idx, y, sum(tf) AS o FROM entries GROUP BY ALL)",
    "expected AS (SELECT t.idx, s.y, s.n / (SELECT count(*) FROM labelled) * t.total AS e "
    "FROM (SELECT idx, sum(tf) AS total FROM entries GROUP BY idx) t CROSS JOIN (SELECT y, count(*) AS n FROM labelled GROUP BY y) s)",
    "scores AS (SELECT idx, sum((coalesce(o, 0) - e) * (coalesce(o, 0) - e) / e) AS score "
    "FROM expected LEFT JOIN observed USING (idx, y) GROUP BY idx)",
]


def _chi_scores(spark, folder):
    rows = texts(spark, folder).withColumnRenamed("lang", "y")
    fitted = Vocabulary.fit(rows, "text", TUNED)
    counted = fitted.count(rows, "text")
    return ops.chi_square(ops.count_entries(counted, "counts", "y"), "y", rows.select("y"))


@query("m9_chi_square", "WITH " + ", ".join([*term_ctes(TUNED), *CHI_CTES]) + "SELECT idx, round(score, 5) AS score FROM scores")
def chi_square(spark, folder):
    return _chi_scores(spark, folder).withColumn("score", F.round("score", 5))


@query("k6_best_features", "WITH " + ", ".join([*term_ctes(TUNED), *CHI_CTES])
       + "SELECT idx, round(score, 5) AS score FROM scores ORDER BY round(score, 9) DESC, idx LIMIT 7500")
def best_features(spark, folder):
    scores = _chi_scores(spark, folder).withColumn("score", F.round("score", 9))
    return ops.best_features(scores, 7500).withColumn("score", F.round("score", 5))


_FRAME_SQL = rf"""
SELECT a.doc_id, a.category, year(date) AS year, month(date) AS month, length(text) AS text_length,
       {words_sql('text')} AS word_count, len(list_distinct(regexp_extract_all(text, '{NOT_SPACE_SQL}'))) AS unique_words,
       m.category_id, m.n / (SELECT n FROM total) AS category_frequency, coalesce(c.terms, 0) AS terms,
       round(coalesce(c.tf, 0), 6) AS tf_sum, round(coalesce(w.s, 0), 5) AS weight_sum
FROM articles a JOIN (SELECT category, CAST(row_number() OVER (ORDER BY min(doc_id)) - 1 AS INTEGER) AS category_id, count(*) AS n
                      FROM articles GROUP BY category) m USING (category)
LEFT JOIN (SELECT doc_id, count(*) AS terms, sum(counted.tf) AS tf FROM counted JOIN vocab USING (term) GROUP BY doc_id) c USING (doc_id)
LEFT JOIN (SELECT doc_id, sum(weight) AS s FROM normed GROUP BY doc_id) w USING (doc_id)"""


@query("m30_model_frame", over_articles(_FRAME_SQL, *term_ctes(BASIC), *weight_ctes("c.tf")))
def model_frame(spark, folder):
    """Dates, lengths, label numbers and one count and one TF-IDF row per article."""
    rows = text_articles(spark, folder, "doc_id", "category", "date", "text")
    frame = prepare(rows, Vocabulary.fit(rows, "text", BASIC))
    plus = lambda acc, v: acc + v
    counts = F.unwrap_udt("doc_term")["values"]
    return frame.select(
        "doc_id", "category", "year", "month", "text_length", "word_count", "unique_words", "category_id",
        "category_frequency", F.size(counts).alias("terms"), F.round(F.aggregate(counts, F.lit(0.0), plus), 6).alias("tf_sum"),
        F.round(F.aggregate("entries", F.lit(0.0), lambda acc, e: acc + e["weight"]), 5).alias("weight_sum"),
    )


def prepare(rows, fitted):
    """The model frame: text features, label numbers and term vectors."""
    frame = fitted.weigh(fitted.count(rows, "text", "doc_term"), "doc_term").withColumns({
        "year": F.year("date"), "month": F.month("date"), "text_length": F.length("text"),
        "word_count": text.count_words(F.col("text")), "unique_words": text.count_unique_words(F.col("text")),
    }).drop("text")
    keys = rows.select("doc_id", "category")
    numbered = joins.attach_index(frame, joins.label_index(keys, by="appearance", id_col="doc_id"))
    shares = reports.category_shares(keys).select("category", F.col("share").alias("category_frequency"))
    return numbered.join(shares, "category", "left")


@query("x12_token_ids", "WITH " + ", ".join(term_ctes(TermSettings(ngrams=(1, 1), min_df=3, stop_words=())))
       .replace("WHERE w1 NOT IN (SELECT w FROM stops)", "")
       .replace("UNION ALL SELECT doc_id, w1 || ' ' || w2 FROM neighbours WHERE w2 IS NOT NULL UNION ALL "
                "SELECT doc_id, w1 || ' ' || w2 || ' ' || w3 FROM neighbours WHERE w3 IS NOT NULL", "") + """
SELECT doc_id, array_to_string(ids || list_transform(range(128 - len(ids)), lambda x: 0), ' ') AS input_ids, len(ids) AS tokens FROM (
  SELECT doc_id, [101] || coalesce(list(coalesce(idx + 1000, 100) ORDER BY pos) FILTER (pos < 126), []) || [102] AS ids
  FROM documents LEFT JOIN all_tokens USING (doc_id) LEFT JOIN vocab ON term = w1 AND pos < 126 GROUP BY doc_id)""")
def token_ids(spark, folder):
    """Fixed-length ids: start, known or unknown words, end, padding, and the mask."""
    rows = texts(spark, folder)
    settings = TermSettings(ngrams=(1, 1), min_df=3, stop_words=())
    ids = Vocabulary.fit(rows, "text", settings).dictionary(offset=1000)
    encoded = ops.token_ids(rows, "text", ids, 128, (PAD_ID, UNK_ID, CLS_ID, SEP_ID))
    return encoded.select(
        "doc_id", F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda acc, m: acc + m).alias("tokens"),
    )


PIECES_SQL = "WITH RECURSIVE " + ", ".join(term_ctes(TermSettings(ngrams=(1, 1), min_df=3, stop_words=()))).replace(
    "WHERE w1 NOT IN (SELECT w FROM stops)", "").replace("UNION ALL SELECT doc_id, w1 || ' ' || w2 FROM neighbours WHERE w2 IS NOT NULL UNION ALL "
    "SELECT doc_id, w1 || ' ' || w2 || ' ' || w3 FROM neighbours WHERE w3 IS NOT NULL", "") + r""",
short AS (SELECT term FROM vocab WHERE length(term) <= 20),
letters AS (SELECT DISTINCT unnest(string_split(term, '')) AS c FROM short),
pieces AS (SELECT piece, CAST(row_number() OVER (ORDER BY piece) - 1 + 1000 AS INTEGER) AS id FROM (
  SELECT term AS piece FROM short UNION SELECT c FROM letters UNION SELECT '##' || c FROM letters
  UNION SELECT '##' || right(term, 2) FROM short WHERE length(term) > 2 UNION SELECT '##' || right(term, 3) FROM short WHERE length(term) > 3)),
basic AS (SELECT doc_id, unnest(l[:126]) AS w, unnest(range(1, 1 + len(l[:126]))) AS pos FROM (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}\p{M}_]+|[^\s\p{L}\p{N}\p{M}_]') AS l FROM documents)),
distinct_words AS (SELECT DISTINCT w FROM basic),
places AS (SELECT w, unnest(range(length(w))) AS p FROM distinct_words WHERE length(w) <= 100),
tries AS (SELECT w, p, unnest(range(1, 1 + least(20, length(w) - p))) AS n FROM places),
best AS (SELECT w, p, max(n) AS n, arg_max(id, n) AS id FROM tries JOIN pieces ON piece = CASE WHEN p > 0 THEN '##' ELSE '' END || substr(w, p + 1, n) GROUP BY w, p),
walk AS (
  SELECT w, CAST(0 AS BIGINT) AS p, CAST([] AS INTEGER[]) AS ids FROM distinct_words
  UNION ALL SELECT walk.w, walk.p + best.n, list_append(walk.ids, best.id) FROM walk JOIN best ON best.w = walk.w AND best.p = walk.p),
done AS (SELECT w, ids FROM walk WHERE p = length(w)),
sequences AS (SELECT doc_id, list(coalesce(ids, [100]) ORDER BY pos) FILTER (pos IS NOT NULL) AS l FROM documents LEFT JOIN basic USING (doc_id) LEFT JOIN done USING (w) GROUP BY doc_id),
shaped AS (SELECT doc_id, [101] || flatten(coalesce(l, []))[:126] || [102] AS ids FROM sequences)
SELECT doc_id, array_to_string(ids || list_transform(range(128 - len(ids)), lambda x: 0), ' ') AS input_ids, len(ids) AS tokens FROM shaped"""


@query("x12_word_pieces", PIECES_SQL)
def word_pieces(spark, folder):
    """Fixed-length ids of word pieces: the longest piece at each place, from a vocabulary of words, characters and endings."""
    rows = texts(spark, folder)
    words = ops.vocabulary_table(rows, "text", TermSettings(ngrams=(1, 1), min_df=3, stop_words=()))
    table = ops.piece_table(words).collect()  # at most a dictionary's entries
    pieces = Dictionary({r["piece"]: r["idx"] + 1000 for r in table}, "int")
    encoded = ops.word_piece_ids(rows, "text", pieces, 20, 128, (PAD_ID, UNK_ID, CLS_ID, SEP_ID))
    return encoded.select(
        "doc_id", F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda acc, m: acc + m).alias("tokens"))


@query("m10_standardise", """
SELECT vec_id, dim, round((v - mean) / CASE WHEN std > 0 THEN std ELSE 1 END, 6) AS scaled FROM (
  SELECT vec_id, unnest(range(len(embedding))) AS dim, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
JOIN (SELECT dim, avg(v) AS mean, stddev_pop(v) AS std FROM (
  SELECT unnest(range(len(embedding))) AS dim, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings) GROUP BY dim) USING (dim)""")
def standardise(spark, folder):
    """Population standardisation of the embedding columns."""
    rows = features.embedding_vectors(
        spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding"), "embedding", "v"
    )
    scaled = features.fit_scaler(rows, "v", "scaled", center=True).transform(rows)
    return features.vector_entries(scaled, "scaled", "vec_id").select(
        "vec_id", F.col("idx").alias("dim"), F.round("tf", 6).alias("scaled")
    )
