"""Label encoding, samples, splits, class balancing and class weights."""

from pyspark.sql import functions as F

from newslens.operators import evaluate, joins, sampling
from newslens.plans.articles import articles, over_articles
from newslens.plans.registry import query
from newslens.sources.files import read_table

ORDER_SQL = "md5(CAST(doc_id AS VARCHAR) || '|42'), doc_id"
LABELLED_SQL = "labelled AS (SELECT doc_id, source, quality AS y FROM documents JOIN labels USING (doc_id))"
SPLIT_SQL = f"""split_rows AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY y ORDER BY {ORDER_SQL})
  <= round(0.2 * count(*) OVER (PARTITION BY y)) THEN 'test' ELSE 'train' END AS split FROM labelled)"""
# Balancing settings that fit the size of the labelled table.
MAX_RATIO, MIN_SAMPLES = 1.5, 20
TARGET_SQL = f"""targets AS (SELECT y, n, CAST(CASE WHEN n <= cap THEN greatest(n, {MIN_SAMPLES}) ELSE floor(cap) END AS BIGINT) AS target
  FROM (SELECT y, n, greatest(min(n) OVER (), {MIN_SAMPLES}) * {MAX_RATIO} AS cap FROM (
    SELECT y, count(*) AS n FROM split_rows WHERE split = 'train' GROUP BY y)))"""
BALANCED_SQL = f"""balanced AS (SELECT s.* FROM (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {ORDER_SQL}) AS r
  FROM split_rows WHERE split = 'train') s JOIN targets USING (y) WHERE r <= target)"""


def labelled(spark, folder):
    labels = read_table(spark, folder, "labels").select("doc_id", F.col("quality").alias("y"))
    return read_table(spark, folder, "documents").select("doc_id", "source").join(labels, "doc_id")


def parts(spark, folder):
    """(train, balanced train, test) of the labelled documents."""
    split = sampling.stratified_split(labelled(spark, folder), "doc_id", "y")
    train, test = split.where(F.col("split") == "train"), split.where(F.col("split") == "test")
    return train, sampling.undersample(train, "doc_id", "y", MAX_RATIO, MIN_SAMPLES), test


@query("p10_fraction_sample", f"""
SELECT doc_id, source FROM documents QUALIFY row_number() OVER (ORDER BY {ORDER_SQL}) <= floor(count(*) OVER () * 0.37)""")
def fraction_sample(spark, folder):
    return sampling.sample(read_table(spark, folder, "documents").select("doc_id", "source"), "doc_id", 0.37)


@query("p10_row_sample", f"SELECT doc_id, source FROM documents ORDER BY {ORDER_SQL} LIMIT 125")
def row_sample(spark, folder):
    """An absolute sample size: exactly that many rows, or all of them."""
    return sampling.sample(read_table(spark, folder, "documents").select("doc_id", "source"), "doc_id", 125)


@query("p11_rounded_sample", f"""
SELECT conv_id, turn FROM (SELECT *, conv_id || '-' || turn AS id FROM conversations)
QUALIFY row_number() OVER (ORDER BY md5(id || '|42'), id) <= round_even(count(*) OVER () * 0.1, 0)""")
def rounded_sample(spark, folder):
    rows = read_table(spark, folder, "conversations").select("conv_id", "turn", F.concat_ws("-", "conv_id", "turn").alias("id"))
    return sampling.sample_rounded(rows, "id", 0.1).drop("id")


@query("m11_alphabetical_labels", over_articles("""
SELECT doc_id, CAST(dense_rank() OVER (ORDER BY category) - 1 AS INTEGER) AS category_id FROM articles"""))
def alphabetical_labels(spark, folder):
    rows = articles(spark, folder, "doc_id", "category")
    return joins.attach_index(rows, joins.label_index(rows)).select("doc_id", "category_id")


@query("m12_first_appearance_labels", """
SELECT event_type AS label, CAST(row_number() OVER (ORDER BY min(event_id)) - 1 AS INTEGER) AS idx FROM events GROUP BY event_type""")
def first_appearance_labels(spark, folder):
    rows = read_table(spark, folder, "events").select("event_id", "event_type")
    return joins.label_index(rows, "event_type", by="appearance", id_col="event_id")


@query("m13_stratified_split", f"WITH {LABELLED_SQL}, {SPLIT_SQL} SELECT doc_id, y, split FROM split_rows")
def stratified_split(spark, folder):
    return sampling.stratified_split(labelled(spark, folder), "doc_id", "y").select("doc_id", "y", "split")


@query("m13_stratified_split_events", """
SELECT event_id, event_type, CASE WHEN row_number() OVER (PARTITION BY event_type ORDER BY md5(CAST(event_id AS VARCHAR) || '|42'), event_id)
  <= round(0.2 * count(*) OVER (PARTITION BY event_type)) THEN 'test' ELSE 'train' END AS split FROM events""")
def stratified_split_events(spark, folder):
    """Few classes with many rows each, one of them dominant."""
    rows = read_table(spark, folder, "events").select("event_id", "event_type")
    return sampling.stratified_split(rows, "event_id", "event_type")


@query("m14_random_split", f"""
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {ORDER_SQL}) <= floor(count(*) OVER () * 0.8)
  THEN 'train' ELSE 'validation' END AS split FROM documents""")
def random_split(spark, folder):
    return sampling.random_split(read_table(spark, folder, "documents").select("doc_id"), "doc_id")


@query("m15_sampling_targets", f"""
WITH {LABELLED_SQL}, {SPLIT_SQL}, {TARGET_SQL} SELECT y, n, target, n < {MIN_SAMPLES} AS under_min FROM targets""")
def sampling_targets(spark, folder):
    return sampling.sampling_targets(parts(spark, folder)[0], "y", MAX_RATIO, MIN_SAMPLES)


@query("m15_default_targets", """
SELECT event_type, n, CAST(CASE WHEN n <= cap THEN greatest(n, 2000) ELSE floor(cap) END AS BIGINT) AS target, n < 2000 AS under_min
FROM (SELECT *, greatest(min(n) OVER (), 2000) * 5 AS cap FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type))""")
def default_targets(spark, folder):
    return sampling.sampling_targets(read_table(spark, folder, "events").select("event_type"), "event_type")


@query("m16_undersampled", f"WITH {LABELLED_SQL}, {SPLIT_SQL}, {TARGET_SQL}, {BALANCED_SQL} SELECT doc_id, y FROM balanced")
def undersampled(spark, folder):
    return parts(spark, folder)[1].select("doc_id", "y")


@query("m17_class_weights", """
SELECT doc_id, y, round((SELECT count(*) FROM labels) / (2 * n), 9) AS weight
FROM (SELECT doc_id, quality AS y FROM labels) JOIN (SELECT quality AS y, count(*) AS n FROM labels GROUP BY quality) USING (y)""")
def class_weights(spark, folder):
    rows = read_table(spark, folder, "labels").select("doc_id", F.col("quality").alias("y"))
    return sampling.with_class_weight(rows, "y").select("doc_id", "y", F.round("weight", 9).alias("weight"))


DISTRIBUTION_SQL = """distribution AS (SELECT c.y, coalesce(a.n, 0) AS train, coalesce(b.n, 0) AS resampled, coalesce(t.n, 0) AS test
  FROM (SELECT unnest([0, 1, 2]) AS y) c
  LEFT JOIN (SELECT y, count(*) AS n FROM split_rows WHERE split = 'train' GROUP BY y) a USING (y)
  LEFT JOIN (SELECT y, count(*) AS n FROM balanced GROUP BY y) b USING (y)
  LEFT JOIN (SELECT y, count(*) AS n FROM split_rows WHERE split = 'test' GROUP BY y) t USING (y))"""
_DISTRIBUTION = f"WITH {LABELLED_SQL}, {SPLIT_SQL}, {TARGET_SQL}, {BALANCED_SQL}, {DISTRIBUTION_SQL}"


@query("a16_class_distribution", _DISTRIBUTION + "SELECT * FROM distribution")
def class_distribution(spark, folder):
    """Rows per class in train, balanced train and test; a class without rows counts 0."""
    train, balanced, test = parts(spark, folder)
    return evaluate.class_distribution(train, balanced, test, [0, 1, 2])


@query("a17_reduction_ratios", _DISTRIBUTION
       + "SELECT y, round(CASE WHEN train > 0 THEN resampled / train ELSE 0 END, 9) AS ratio FROM distribution")
def reduction_ratios(spark, folder):
    ratios = evaluate.reduction_ratios(class_distribution(spark, folder))
    return ratios.withColumn("ratio", F.round("ratio", 9))
