"""The dealt operators over their whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newslens.llm import bpe, chunk_bpe, line_dedup, lm, minhash, mixing, pii, quality, ranked, secret_scan, topk, trie, vectors
from newslens.llm.registry import QUERIES, SQL, query

__all__ = ["QUERIES", "SQL"]

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
WORD_VOCABULARY = "word_bpe_49k.json"


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _digest(spans: Column, base: tuple[str, ...]) -> Column:
    return F.sha2(pii.spans_text(F.filter(spans, lambda s: s["kind"].isin(*base))), 256)


def _counts(spans: Column, base: tuple[str, ...]) -> list[Column]:
    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return [count(kind) for kind in base]


@query("op1_pii")
def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.with_pii(_read(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "pii")
    return found.select("doc_id", *_counts(F.col("pii"), pii.BASE), _digest(F.col("pii"), pii.BASE).alias("base_sha256"),
                        pii.spans_text(F.col("pii")).alias("spans"))


@query("op4_minhash", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l FROM documents
), s AS (
  SELECT doc_id, CASE len(l) WHEN 0 THEN [] WHEN 1 THEN l ELSE list_distinct([l[i] || ' ' || l[i + 1] FOR i IN range(1, len(l))]) END AS g FROM w
), n AS (SELECT doc_id, len(g) AS n FROM s), e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach(a, b) AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, n AS n_shingles, least(doc_id, coalesce(low.b, doc_id)) AS component_id, doc_id = least(doc_id, coalesce(low.b, doc_id)) AS kept
FROM n LEFT JOIN low ON low.a = doc_id
""")
def op4_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_read(spark, folder, "documents"), width=2, percent=80)


@query("op6_secrets")
def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.with_secrets(_read(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "secrets")
    return found.select("doc_id", *_counts(F.col("secrets"), secret_scan.BASE),
                        _digest(F.col("secrets"), secret_scan.BASE).alias("base_sha256"), pii.spans_text(F.col("secrets")).alias("spans"))


@query("op7_bpe")
def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = _read(spark, folder, "documents").select("doc_id", "text")
    encoded = bpe.encode_digests(docs, public_tokenizers.path(VOCABULARY), pattern=public_tokenizers.PATTERN)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op10_mixing")
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(_read(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op3_topk", """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum([z[1] * z[2] FOR z IN list_zip(a.q, b.q)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""")
def op3_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_inner_products(_read(spark, folder, "embeddings"))


@query("op8_embeddings", """
WITH RECURSIVE v AS (
  SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS q FROM embeddings
), ok AS (
  SELECT vec_id, q FROM v WHERE q IS NOT NULL AND len([x FOR x IN q IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN q IF x <> 0]) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND (a.q = b.q OR list_cosine_similarity(a.q, b.q) >= 0.95)
), reach(a, b) AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(low.b, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(low.b, vec_id)) AS kept
FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN low ON low.a = vec_id
""")
def op8_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(_read(spark, folder, "embeddings"))


@query("op5_quality")
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    ratings = _read(spark, folder, "labels").select("doc_id", quality.grade(F.col("quality"), F.col("toxic")).alias("grade"))
    graded = quality.grade_documents(docs, quality.train(docs, ratings))
    return graded.select("doc_id", "expected_grade", "tail", F.coalesce(F.col("tail") >= quality.SELECT, F.lit(True)).alias("selected"))


@query("op9_lm")
def op9_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score_documents(_read(spark, folder, "documents"))


@query("op2_lines")
def op2_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs, lines = line_dedup.line_classes(_read(spark, folder, "documents"))
    named = F.concat_ws(":", "line", "component.doc_id", "component.line")
    per_doc = lines.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_shared"), F.sum(line_dedup.repeats(lines).cast("bigint")).alias("n_repeats"),
        F.sum("n_links").alias("n_links"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", named.alias("name")))), lambda x: x["name"]), ",").alias("classes"))
    zero = F.lit(0).cast("bigint")
    return docs.join(per_doc, "doc_id", "left").select(
        "doc_id", "n_lines", *(F.coalesce(c, zero).alias(c) for c in ("n_shared", "n_repeats", "n_links")), F.coalesce("classes", F.lit("")).alias("classes"))


@query("op13_chunks")
def op13_chunks(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = _read(spark, folder, "documents").select("doc_id", "text")
    return chunk_bpe.encode_digests(docs, public_tokenizers.path(WORD_VOCABULARY)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op12_ranked", r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS l FROM documents
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), s AS (SELECT CAST(count(*) FILTER (len(l) > 0) AS BIGINT) AS n_docs, CAST(sum(len(l)) AS BIGINT) AS n_terms FROM t),
f AS (SELECT doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc_id, CAST(len(l) AS BIGINT) AS n, unnest(l) AS term FROM t) WHERE term IN (SELECT term FROM q) GROUP BY doc_id, n, term),
d AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM f, s GROUP BY term),
g AS (
  SELECT q.item_id, f.doc_id, CAST(sum(d.w * ((1000000000 * f.tf) // (1000 * f.tf + 20 * (50 + (50 * f.n * s.n_docs) // s.n_terms)))) AS BIGINT) AS score
  FROM q JOIN f ON f.term = q.term JOIN d ON d.term = q.term, s GROUP BY q.item_id, f.doc_id
), r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM g WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
""")
def op12_ranked(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.best_documents(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


@query("op11_trie", """
WITH o AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT DISTINCT conv_id, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ord(x) AS BIGINT) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]),
    lambda a, b: list_reduce(list_prepend(xor(a, b), CAST(range(8) AS BIGINT[])), lambda x, y: xor(x // 2, CAST(3988292384 AS BIGINT) * (x % 2)))) AS crc FROM o
), k AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(crc, CAST(4294967295 AS BIGINT)) % 6 AS h FROM c),
given AS (SELECT k.conv_id, o.pos, o.role, o.text FROM k JOIN o ON o.conv_id = k.base AND o.pos <= k.h),
had AS (SELECT conv_id, count(*) AS n FROM given GROUP BY conv_id),
t AS (
  SELECT * FROM given UNION ALL
  SELECT k.conv_id, o.pos - k.h + coalesce(had.n, 0), o.role, o.text FROM k JOIN o ON o.conv_id = k.conv_id AND o.pos > k.h LEFT JOIN had ON had.conv_id = k.conv_id
), p AS (
  SELECT conv_id, pos AS depth, length(text) AS size, string_agg(sha256(role || ':' || length(role) || ':' || text), ',') OVER (PARTITION BY conv_id ORDER BY pos) AS path FROM t
  UNION ALL SELECT conv_id, 0, 0, '' FROM k
), e AS (SELECT conv_id, max(depth) AS len FROM p GROUP BY conv_id),
n AS (
  SELECT p.path, p.depth, min(p.conv_id) AS conv_id, count(*) AS n, any_value(p.size) AS size,
    sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (e.len = p.depth), '')) AS ends FROM p JOIN e ON e.conv_id = p.conv_id GROUP BY p.path, p.depth
), u AS (SELECT DISTINCT a.path, b.path AS parent FROM p a JOIN p b ON a.conv_id = b.conv_id AND a.depth = b.depth + 1),
kids AS (SELECT parent, count(*) AS k FROM u GROUP BY parent),
m AS (SELECT n.*, coalesce(kids.k, 0) AS k FROM n LEFT JOIN kids ON kids.parent = n.path),
s AS (
  SELECT b.path, sum(CAST(m.k = 0 AS BIGINT)) AS leaves, sum((m.n - 1) * m.size) AS saved FROM m
  JOIN p a ON a.conv_id = m.conv_id AND a.depth = m.depth JOIN p b ON b.conv_id = a.conv_id AND b.depth <= a.depth GROUP BY b.path
)
SELECT m.conv_id, CAST(m.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, CAST(m.n AS BIGINT) AS n_convs, CAST(m.k AS BIGINT) AS n_children,
  CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, m.ends AS ends_sha256
FROM m JOIN s ON s.path = m.path LEFT JOIN u ON u.path = m.path LEFT JOIN n q ON q.path = u.parent
""")
def op11_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(*trie.rebuild(trie.number_turns(_read(spark, folder, "conversations"))))
