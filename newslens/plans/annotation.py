"""Tokens, tags, lemmas, phrase patterns and sentiment."""

from pyspark.sql import functions as F

from newslens.functions import tagging, text
from newslens.functions.sentiment import SentimentScorer
from newslens.functions.tagging import Tagger
from newslens.functions.wordlists import (
    BOOSTER_PHRASES, BOOSTERS, IDIOMS, KEEP_WORDS, NEGATIONS, POS_KEYS, annotator_stop_words, sentiment_lexicon, tag_lexicon,
)
from newslens.operators import annotate as ops
from newslens.operators.tag_model import TagModel, agreement
from newslens.plans.articles import over_articles, text_articles
from newslens.plans.noise import CLEANING_NOISE, MOOD_NOISE, noisy, noisy_sql, quote
from newslens.plans.registry import query
from newslens.plans.texts import SPACE_SQL, contractions_sql, scrub_sql, strip_sql
from newslens.session import materialize
from newslens.sources.files import read_texts

# The starter lexicon plus tags for frequent words of the test documents.
LEXICON = {
    **tag_lexicon(),
    **{w: ("NNP", w) for w in "re th nd ou er st ti rewh orre thatin ononst".split()},
    **{w: ("JJ", w) for w in "es ha un der".split()},
    **{w: ("VB", w) for w in "ed la die und".split()},
}
STOPS = annotator_stop_words()


def values_sql(name: str, columns: str, rows) -> str:
    cells = ", ".join("(" + ", ".join(quote(v) if isinstance(v, str) else repr(v) for v in r) + ")" for r in rows)
    return f"{name} AS (SELECT * FROM (VALUES {cells}) AS t({columns}))"


LEX_SQL = values_sql("lex", "word, tag, lemma", [(w, t, l) for w, (t, l) in LEXICON.items()])
STOP_SQL = values_sql("stop", "w", [(w,) for w in STOPS])
KEEP_SQL = values_sql("keep", "w", [(w,) for w in KEEP_WORDS])


def _ends(*endings):
    return "(" + " OR ".join(f"ends_with(word, '{e}')" for e in endings) + ")"


GUESS_SQL = f"""CASE WHEN word IN ('.', ',', '!', '?') THEN word WHEN regexp_matches(word, '^[0-9]') THEN 'CD'
  WHEN {_ends('ly')} AND length(word) > 4 THEN 'RB' WHEN {_ends('ing')} AND length(word) > 5 THEN 'VBG'
  WHEN {_ends('ed')} AND length(word) > 4 THEN 'VBD'
  WHEN {_ends('ous', 'ful', 'able', 'ible', 'ive', 'less')} AND length(word) > 5 THEN 'JJ'
  WHEN {_ends('s')} AND NOT {_ends('ss')} AND length(word) > 3 THEN 'NNS' ELSE 'NN' END"""
CLASS_SQL = "CASE substr(tag, 1, 1) WHEN 'J' THEN 'a' WHEN 'V' THEN 'v' WHEN 'R' THEN 'r' ELSE 'n' END"
_ES = _ends("sses", "xes", "ches", "shes", "zes")
RULE_SQL = f"""CASE
  WHEN cls = 'n' THEN CASE WHEN {_ends('ies')} AND length(word) > 4 THEN regexp_replace(word, 'ies$', 'y')
    WHEN {_ES} THEN word[:-3] WHEN {_ends('ss', 'us', 'is')} THEN word
    WHEN {_ends('s')} AND length(word) > 3 THEN word[:-2] ELSE word END
  WHEN cls = 'v' THEN CASE WHEN {_ends('ies', 'ied')} AND length(word) > 4 THEN word[:-4] || 'y' WHEN {_ES} THEN word[:-3]
    WHEN length(word) > 6 AND regexp_matches(word, '(bb|dd|gg|mm|nn|pp|rr|tt)ing$') THEN word[:-5]
    WHEN {_ends('ing')} AND length(word) > 5 THEN word[:-4]
    WHEN length(word) > 5 AND regexp_matches(word, '(bb|dd|gg|mm|nn|pp|rr|tt)ed$') THEN word[:-4]
    WHEN {_ends('ed')} AND length(word) > 4 THEN word[:-3] WHEN {_ends('ss')} THEN word
    WHEN {_ends('s')} AND length(word) > 3 THEN word[:-2] ELSE word END
  WHEN cls = 'a' THEN CASE WHEN {_ends('iest')} AND length(word) > 5 THEN word[:-5] || 'y'
    WHEN {_ends('ier')} AND length(word) > 4 THEN word[:-4] || 'y' ELSE word END
  ELSE word END"""


def token_ctes(id_cols: str, source: str, column: str) -> list[str]:
    """CTEs clean -> tokens -> tagged -> ann over ``source.column``."""
    return [
        f"expanded AS (SELECT {id_cols}, {contractions_sql(f'lower({column})')} AS e FROM {source})",
        f"clean AS (SELECT {id_cols}, e, {scrub_sql('e')} AS c FROM expanded)",
        f"lists AS (SELECT {id_cols}, regexp_extract_all(c, '[A-Za-z0-9]+(?:[''-][A-Za-z0-9]+)*|[.,!?]') AS l FROM clean)",
        f"tokens AS (SELECT {id_cols}, unnest(l) AS word, unnest(range(len(l))) AS pos FROM lists)",
        f"tagged AS (SELECT tokens.*, coalesce(tag, {GUESS_SQL}) AS tag, lemma AS known FROM tokens LEFT JOIN lex USING (word))",
        f"classed AS (SELECT *, {CLASS_SQL} AS cls FROM tagged)",
        f"ann AS (SELECT *, coalesce(known, {RULE_SQL}) AS lemma FROM classed)",
    ]


FULL_SQL = f"""full_text AS (SELECT doc_id, category, CASE WHEN f = '.' THEN '' ELSE f END AS f FROM (
  SELECT doc_id, category, {strip_sql("headline || ' . ' || short_description")} AS f FROM (
    SELECT doc_id, category, {noisy_sql('headline', CLEANING_NOISE)} AS headline,
           {noisy_sql('short_description', CLEANING_NOISE)} AS short_description FROM articles)))"""
ANN_CTES = [LEX_SQL, STOP_SQL, KEEP_SQL, FULL_SQL, *token_ctes("doc_id, category", "full_text", "f")]
IS_STOP = "word IN (SELECT w FROM stop)"
TOPIC_RULE = f"regexp_matches(tag, '^(NN|VB|JJ)') AND length(word) > 2 AND NOT {IS_STOP}"
BATCH_RULE = (f"(word IN (SELECT w FROM keep) OR regexp_matches(tag, '^(JJ|RB|VB)') OR tag IN ('.', ',', '!', '?') "
              f"OR (starts_with(tag, 'NN') AND NOT {IS_STOP}))")
SERVING_RULE = f"(NOT {IS_STOP} OR regexp_matches(tag, '^(JJ|RB|VB)') OR tag IN ('.', ',', '!', '?'))"
# Phrase tables: entities per run, pairs per hit.
ENTITY_CTE = """entities AS (
  SELECT doc_id, min(pos) AS start, string_agg(word, ' ' ORDER BY pos) AS entity FROM (
    SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM ann WHERE starts_with(tag, 'NNP'))
  GROUP BY doc_id, island)"""
PAIR_CTE = """pairs AS (
  SELECT doc_id, pos, tag, word || ' ' || next_word AS phrase FROM (
    SELECT *, lead(word) OVER w AS next_word, lead(tag) OVER w AS next_tag FROM ann
    WINDOW w AS (PARTITION BY doc_id ORDER BY pos)) WHERE starts_with(next_tag, 'NN'))"""


def noisy_articles(spark, folder):
    rows = text_articles(spark, folder, "doc_id", "headline", "short_description", "category", "date")
    return rows.withColumns({
        c: noisy(F.col(c), CLEANING_NOISE) for c in ("headline", "short_description")
    })


def annotated(spark, folder, **options):
    return ops.annotate(noisy_articles(spark, folder), tagger=Tagger(LEXICON), **options)


def token_arrays(spark, folder):
    """(doc_id, category, _quotes, _tokens) of the noisy articles."""
    rows = noisy_articles(spark, folder)
    full = rows.withColumn("_full", text.combine(F.col("headline"), F.col("short_description")))
    return ops.with_tokens(ops.with_clean_text(full, "_full"), Tagger(LEXICON)).select(
        "doc_id", "category", "_quotes", "_tokens"
    )


@query("x1_tokens", over_articles("SELECT doc_id, pos, word FROM tokens", *ANN_CTES))
def tokens(spark, folder):
    return ops.token_table(token_arrays(spark, folder), "doc_id").select("doc_id", "pos", "word")


@query("x2_tags", over_articles("SELECT doc_id, tag, count(*) AS n FROM tagged GROUP BY doc_id, tag", *ANN_CTES))
def tags(spark, folder):
    """Lexicon and suffix-rule tags, counted per article."""
    table = ops.token_table(token_arrays(spark, folder), "doc_id")
    return table.groupBy("doc_id", "tag").agg(F.count(F.lit(1)).alias("n"))


@query("x2_tags_by_join", over_articles("SELECT word, tag, lemma, count(*) AS n FROM ann GROUP BY word, tag, lemma", *ANN_CTES))
def tags_by_join(spark, folder):
    """The table-lexicon form, over the distinct counted words."""
    words = ops.token_table(token_arrays(spark, folder), "doc_id").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    lexicon = spark.createDataFrame([(w, t, l) for w, (t, l) in LEXICON.items()], "word string, tag string, lemma string")
    return ops.tag_by_join(words, lexicon).select("word", "tag", "lemma", "n")


@query("x3_lemma_classes", over_articles("SELECT cls, tag, count(*) AS n FROM classed GROUP BY cls, tag", *ANN_CTES))
def lemma_classes(spark, folder):
    table = ops.token_table(token_arrays(spark, folder), "doc_id").withColumn("cls", tagging.lemma_class(F.col("tag")))
    return table.groupBy("cls", "tag").agg(F.count(F.lit(1)).alias("n"))


@query("x4_lemmas", over_articles("SELECT tag, lemma, count(*) AS n FROM ann GROUP BY tag, lemma", *ANN_CTES))
def lemmas(spark, folder):
    table = ops.token_table(token_arrays(spark, folder), "doc_id")
    return table.groupBy("tag", "lemma").agg(F.count(F.lit(1)).alias("n"))


def _joined_sql(rule: str, name: str) -> str:
    return over_articles(f"""
SELECT doc_id, md5(coalesce(v, '')) AS {name} FROM full_text LEFT JOIN (
  SELECT doc_id, string_agg(lemma, ' ' ORDER BY pos) AS v FROM ann WHERE {rule} GROUP BY doc_id) USING (doc_id)""", *ANN_CTES)


@query("x5_topic_text", _joined_sql(TOPIC_RULE, "processed_text"))
def topic_text(spark, folder):
    return annotated(spark, folder, purpose="topic").select("doc_id", F.md5("processed_text").alias("processed_text"))


@query("x6_sentiment_text_batch", _joined_sql(BATCH_RULE, "sentiment_text"))
def sentiment_text_batch(spark, folder):
    return annotated(spark, folder, purpose="sentiment").select("doc_id", F.md5("sentiment_text").alias("sentiment_text"))


@query("x2_trained_tagger", over_articles("""
SELECT count(*) AS tokens, count(DISTINCT doc_id) AS articles, TRUE AS beats_lexicon, TRUE AS above_floor FROM ann WHERE doc_id % 5 = 1""", *ANN_CTES))
def trained_tagger(spark, folder):
    """A tag model trained on four fifths of the tagged articles, on the rest: whether it agrees with their tags in more
    places than the starter lexicon does, and in more than 99 of a hundred."""
    rows = token_arrays(spark, folder).select(
        "doc_id", F.transform("_tokens", lambda t: t["word"]).alias("words"), F.transform("_tokens", tagging.tag_of).alias("tags"))
    rows = materialize(rows, "tagged")
    model = TagModel.fit(rows.where("doc_id % 5 <> 1"), "words", "tags")
    held = model.tag(rows.where("doc_id % 5 = 1 AND size(words) > 0"), "words", "found")
    starter = F.transform(Tagger().annotate(F.col("words")), tagging.tag_of)
    scored = held.select(F.size("words").alias("n"), agreement(F.col("tags"), F.col("found")).alias("model"), agreement(F.col("tags"), starter).alias("lexicon"))
    return scored.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("articles"), (F.sum("model") > F.sum("lexicon")).alias("beats_lexicon"),
                      (F.sum("model") > 0.99 * F.sum("n")).alias("above_floor"))


@query("x7_sentiment_text_serving", _joined_sql(SERVING_RULE, "sentiment_text"))
def sentiment_text_serving(spark, folder):
    rows = token_arrays(spark, folder)
    served = tagging.sentiment_text(F.col("_tokens"), STOPS, KEEP_WORDS, "serving")
    return rows.select("doc_id", F.md5(served).alias("sentiment_text"))


@query("x8_purposes", over_articles(f"""
SELECT purpose, count(*) AS n, CAST(sum(CASE WHEN purpose <> 'sentiment' THEN t ELSE 0 END) AS BIGINT) AS topic_words,
       CAST(sum(CASE WHEN purpose <> 'topic' THEN s ELSE 0 END) AS BIGINT) AS sentiment_words
FROM (SELECT unnest(['topic', 'sentiment', 'both']) AS purpose, * FROM (
  SELECT f.doc_id, count(word) FILTER ({TOPIC_RULE}) AS t, count(word) FILTER ({BATCH_RULE}) AS s
  FROM full_text f LEFT JOIN ann USING (doc_id) GROUP BY f.doc_id)) GROUP BY purpose""", *ANN_CTES))
def purposes(spark, folder):
    """One annotation, and what each purpose keeps of it."""
    words = lambda name, purpose: F.sum(text.count_words(ops.for_purpose(F.col(name), name, purpose)))
    sums = annotated(spark, folder).agg(F.array(*(
        F.struct(F.lit(p).alias("purpose"), F.count(F.lit(1)).alias("n"), words("processed_text", p).alias("topic_words"),
                 words("sentiment_text", p).alias("sentiment_words")) for p in ops.PURPOSES)).alias("rows"))
    return sums.select(F.inline("rows"))


COUNTS_SQL = """counts AS (SELECT doc_id, count(*) FILTER (starts_with(tag, 'JJ')) AS adj_count,
  count(*) FILTER (starts_with(tag, 'VB')) AS verb_count, count(*) FILTER (starts_with(tag, 'NN')) AS noun_count,
  count(*) FILTER (starts_with(tag, 'NNP')) AS proper_noun_count, count(*) FILTER (starts_with(tag, 'RB')) AS adv_count
  FROM ann GROUP BY doc_id)"""
QUOTES_SQL = "quoted AS (SELECT doc_id, regexp_extract_all(e, '\"([^\"]*)\"', 1) AS q FROM clean)"
POS_SQL = ", ".join(f"coalesce({k}, 0) AS {k}" for k in POS_KEYS[:5]) + ", len(q) AS quote_count"


@query("f20_pos_counts", over_articles(
    f"SELECT doc_id, {POS_SQL} FROM quoted LEFT JOIN counts USING (doc_id)", *ANN_CTES, COUNTS_SQL, QUOTES_SQL))
def pos_counts(spark, folder):
    return annotated(spark, folder).select("doc_id", "pos_features.*")


@query("f17_flat_struct", over_articles(
    f"SELECT doc_id, category, {POS_SQL} FROM full_text JOIN quoted USING (doc_id) LEFT JOIN counts USING (doc_id)",
    *ANN_CTES, COUNTS_SQL, QUOTES_SQL))
def flat_struct(spark, folder):
    flat = ops.flatten_features(annotated(spark, folder))
    return flat.select("doc_id", "category", *POS_KEYS)


PATTERN_LISTS_SQL = """
SELECT doc_id, coalesce(named, '') AS named_entities, coalesce(acts, '') AS action_phrases,
       coalesce(descs, '') AS descriptive_phrases
FROM full_text
LEFT JOIN (SELECT doc_id, string_agg(entity, '~' ORDER BY start) AS named FROM entities GROUP BY doc_id) USING (doc_id)
LEFT JOIN (SELECT doc_id, string_agg(phrase, '~' ORDER BY pos) AS acts FROM pairs WHERE starts_with(tag, 'VB') GROUP BY doc_id) USING (doc_id)
LEFT JOIN (SELECT doc_id, string_agg(phrase, '~' ORDER BY pos) AS descs FROM pairs WHERE starts_with(tag, 'JJ') GROUP BY doc_id) USING (doc_id)"""


@query("w_pattern_lists", over_articles(PATTERN_LISTS_SQL, *ANN_CTES, ENTITY_CTE, PAIR_CTE))
def pattern_lists(spark, folder):
    """The three phrase lists per article in their row-local form."""
    patterns = F.col("news_patterns")
    return annotated(spark, folder).select("doc_id", *[
        F.array_join(patterns[k], "~").alias(k) for k in ("named_entities", "action_phrases", "descriptive_phrases")
    ])


@query("w1_entity_runs", over_articles("SELECT doc_id, start, entity FROM entities", *ANN_CTES, ENTITY_CTE))
def entity_runs(spark, folder):
    """Proper-noun runs, found inside their row."""
    return token_arrays(spark, folder).select("doc_id", F.inline(tagging.entity_runs(F.col("_tokens"))))


@query("w2_action_phrases", over_articles(
    "SELECT doc_id, pos, phrase FROM pairs WHERE starts_with(tag, 'VB')", *ANN_CTES, PAIR_CTE))
def action_phrases(spark, folder):
    return token_arrays(spark, folder).select("doc_id", F.inline(tagging.noun_pairs(F.col("_tokens"), "VB")))


@query("w3_descriptive_phrases", over_articles(
    "SELECT doc_id, pos, phrase FROM pairs WHERE starts_with(tag, 'JJ')", *ANN_CTES, PAIR_CTE))
def descriptive_phrases(spark, folder):
    return token_arrays(spark, folder).select("doc_id", F.inline(tagging.noun_pairs(F.col("_tokens"), "JJ")))


PATTERN_COUNTS_SQL = """pattern_counts AS (SELECT doc_id, len(q) AS pattern_quotes_count,
    coalesce(ne, 0) AS pattern_named_entities_count, coalesce(ac, 0) AS pattern_action_phrases_count,
    coalesce(de, 0) AS pattern_descriptive_phrases_count, 0 AS pattern_temporal_expressions_count,
    0 AS pattern_location_expressions_count FROM quoted
  LEFT JOIN (SELECT doc_id, count(*) AS ne FROM entities GROUP BY doc_id) USING (doc_id)
  LEFT JOIN (SELECT doc_id, count(*) FILTER (starts_with(tag, 'VB')) AS ac, count(*) FILTER (starts_with(tag, 'JJ')) AS de
             FROM pairs GROUP BY doc_id) USING (doc_id))"""
FEATURE_CTES = [*ANN_CTES, ENTITY_CTE, PAIR_CTE, COUNTS_SQL, QUOTES_SQL, PATTERN_COUNTS_SQL]


@query("f16_pattern_counts", over_articles("SELECT * FROM pattern_counts", *FEATURE_CTES))
def pattern_counts(spark, folder):
    rows = annotated(spark, folder)
    return rows.select("doc_id", *text.pattern_counts(F.col("news_patterns")))


@query("x9_annotated_articles", over_articles(f"""
SELECT doc_id, category, md5(coalesce(t, '')) AS processed_text, md5(coalesce(s, '')) AS sentiment_text, {POS_SQL},
       pattern_counts.* EXCLUDE (doc_id)
FROM full_text JOIN quoted USING (doc_id) LEFT JOIN counts USING (doc_id) JOIN pattern_counts USING (doc_id)
LEFT JOIN (SELECT doc_id, string_agg(lemma, ' ' ORDER BY pos) FILTER ({TOPIC_RULE}) AS t,
                  string_agg(lemma, ' ' ORDER BY pos) FILTER ({BATCH_RULE}) AS s FROM ann GROUP BY doc_id) USING (doc_id)""",
    *FEATURE_CTES))
def annotated_articles(spark, folder):
    """The whole feature table in one pass: two texts and twelve counts per article."""
    flat = ops.flatten_features(annotated(spark, folder).drop("headline", "short_description", "date"))
    return flat.withColumns({c: F.md5(c) for c in ("processed_text", "sentiment_text")})


@query("p13_empty_articles", over_articles(f"""
SELECT doc_id, coalesce(t, '') = '' AS empty, coalesce(n, 0) AS nouns FROM articles LEFT JOIN (
  SELECT doc_id, string_agg(lemma, ' ' ORDER BY pos) FILTER ({TOPIC_RULE}) AS t,
         count(*) FILTER (starts_with(tag, 'NN')) AS n FROM ann GROUP BY doc_id) USING (doc_id)""",
    LEX_SQL, STOP_SQL,
    f"""full_text AS (SELECT doc_id, CASE WHEN f = '.' THEN '' ELSE f END AS f FROM (SELECT doc_id,
      {strip_sql("CASE WHEN doc_id % 10 <> 3 THEN headline ELSE '' END || ' . ' || CASE WHEN doc_id % 10 <> 3 THEN short_description ELSE '' END")} AS f FROM articles))""",
    *token_ctes("doc_id", "full_text", "f")))
def empty_articles(spark, folder):
    """Articles without text stay, with empty texts and zero counts: one in ten, in every language, has lost its texts."""
    left = lambda c: F.when(F.col("doc_id") % 10 != 3, F.col(c)).alias(c)
    rows = text_articles(spark, folder, "doc_id", "headline", "short_description").select("doc_id", left("headline"), left("short_description"))
    done = ops.annotate(rows, tagger=Tagger(LEXICON))
    return done.select("doc_id", (F.col("processed_text") == "").alias("empty"), F.col("pos_features.noun_count").alias("nouns"))


@query("f19_complete_patterns", over_articles(
    "SELECT doc_id, coalesce(string_agg(phrase, '~' ORDER BY pos), '') AS action_phrases, 0 AS others FROM full_text "
    "LEFT JOIN (SELECT * FROM pairs WHERE starts_with(tag, 'VB')) USING (doc_id) GROUP BY doc_id", *ANN_CTES, PAIR_CTE))
def complete_patterns(spark, folder):
    """Missing pattern lists are filled with empty ones."""
    only = text.complete_patterns({"action_phrases": tagging.followed_by_noun(F.col("_tokens"), "VB")})
    rows = token_arrays(spark, folder).select("doc_id", only.alias("p"))
    others = sum((F.size(f"p.{k}") for k in ("named_entities", "quotes", "descriptive_phrases",
                                             "temporal_expressions", "location_expressions")), F.lit(0))
    return rows.select("doc_id", F.array_join("p.action_phrases", "~").alias("action_phrases"), others.alias("others"))


def sentiment_ctes(key: str, source: str, column: str) -> list[str]:
    """CTEs ending in ``scored(key, compound, positive, neutral, negative)``."""
    lags = ", ".join(
        f"lag({c}, {k}) OVER w AS {c}{k}" for c in ("low", "v", "b", "neg", "caps") for k in (1, 2, 3)
    )

    def lift(k: int, damping: float) -> str:
        return (f"(CASE WHEN v{k} IS NULL AND b{k} IS NOT NULL THEN b{k} + "
                f"CASE WHEN caps{k} AND mixed THEN 0.733 ELSE 0e0 END ELSE 0e0 END * {damping}e0)")

    def step(previous: str, k: int, damping: float, flip: str) -> str:
        move = lift(k, damping)
        return (f"({previous} + CASE WHEN {previous} < 0 THEN -{move} ELSE {move} END) * "
                f"CASE WHEN low{k} IS NOT NULL AND v{k} IS NULL THEN {flip} ELSE 1e0 END")

    flips = [
        "CASE WHEN neg1 THEN -0.74e0 ELSE 1e0 END",
        "CASE WHEN low2 = 'never' AND low1 IN ('so', 'this') THEN 1.25e0 WHEN low2 = 'without' AND low1 = 'doubt' THEN 1e0 "
        "WHEN neg2 THEN -0.74e0 ELSE 1e0 END",
        "CASE WHEN low3 = 'never' AND (low2 IN ('so', 'this') OR low1 IN ('so', 'this')) THEN 1.25e0 "
        "WHEN low3 = 'without' AND (low2 = 'doubt' OR low1 = 'doubt') THEN 1e0 WHEN neg3 THEN -0.74e0 ELSE 1e0 END",
    ]
    spots = ["low || ' ' || low_next || ' ' || low_next2", "low || ' ' || low_next", "low1 || ' ' || low",
             "low2 || ' ' || low1 || ' ' || low", "low2 || ' ' || low1", "low3 || ' ' || low2 || ' ' || low1", "low3 || ' ' || low2"]
    cases = " ".join(f"WHEN {quote(k)} THEN {v}e0" for k, v in IDIOMS.items())
    idioms = ", ".join(f"CASE {spot} {cases} END" for spot in spots)
    lifts = " ".join(f"WHEN {quote(k)} THEN {v}e0" for k, v in BOOSTER_PHRASES.items())
    phrases = " + ".join(f"coalesce(CASE {spot} {lifts} END, 0e0)" for spot in (spots[5], spots[6], spots[4]))
    edge = r"\A[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+\z"
    return [
        values_sql("moods", "low, v", [(w, v) for w, v in sentiment_lexicon().items()]),
        values_sql("boosts", "low, b", list(BOOSTERS.items())),
        values_sql("negations", "w", [(w,) for w in NEGATIONS]),
        f"split AS (SELECT {key}, regexp_extract_all({column}, '[^{SPACE_SQL}]+') AS l FROM {source})",
        f"raw AS (SELECT {key}, unnest(l) AS raw, unnest(range(len(l))) AS pos FROM split)",
        f"bare AS (SELECT *, regexp_replace(raw, '{edge}', '', 'g') AS bare FROM raw)",
        "chosen AS (SELECT *, CASE WHEN length(bare) > 2 THEN bare ELSE raw END AS word FROM bare)",
        f"words AS (SELECT {key}, pos, lower(word) AS low, word = upper(word) AND word <> lower(word) AS caps FROM chosen)",
        "looked AS (SELECT words.*, CAST(v AS DOUBLE) AS v, CAST(b AS DOUBLE) AS b, "
        "low IN (SELECT w FROM negations) OR contains(low, 'n''t') AS neg "
        "FROM words LEFT JOIN moods USING (low) LEFT JOIN boosts USING (low))",
        f"around AS (SELECT *, {lags}, lead(low) OVER w AS low_next, lead(low, 2) OVER w AS low_next2, lead(v) OVER w AS v_next, "
        f"sum(CAST(caps AS INTEGER)) OVER (PARTITION BY {key}) BETWEEN 1 AND count(*) OVER (PARTITION BY {key}) - 1 AS mixed "
        f"FROM looked WINDOW w AS (PARTITION BY {key} ORDER BY pos))",
        "v0 AS (SELECT *, CASE WHEN low1 = 'no' OR low2 = 'no' OR (low3 = 'no' AND low1 IN ('or', 'nor')) THEN v * -0.74e0 "
        "WHEN low = 'no' AND v_next IS NOT NULL THEN 0e0 ELSE v END AS s FROM around)",
        "va AS (SELECT *, CASE WHEN caps AND mixed THEN CASE WHEN s > 0 THEN s + 0.733e0 ELSE s - 0.733e0 END ELSE s END AS sa FROM v0)",
        f"v1 AS (SELECT *, {step('sa', 1, 1.0, flips[0])} AS s1 FROM va)",
        f"v2 AS (SELECT *, {step('s1', 2, 0.95, flips[1])} AS s2 FROM v1)",
        f"v3 AS (SELECT *, {step('s2', 3, 0.9, flips[2])} AS s3 FROM v2)",
        f"v4 AS (SELECT *, CASE WHEN low3 IS NOT NULL AND v3 IS NULL THEN coalesce({idioms}, s3) + {phrases} ELSE s3 END AS s4 FROM v3)",
        "valued AS (SELECT *, CASE WHEN v IS NULL OR b IS NOT NULL OR (low = 'kind' AND low_next = 'of') THEN 0e0 "
        "ELSE s4 * CASE WHEN low1 = 'least' AND v1 IS NULL AND (low2 IS NULL OR low2 NOT IN ('at', 'very')) THEN -0.74e0 ELSE 1e0 END "
        "END AS x FROM v4)",
        f"buts AS (SELECT *, min(CASE WHEN low = 'but' THEN pos END) OVER (PARTITION BY {key}) AS but_at FROM valued)",
        f"weighed AS (SELECT {key}, pos, x * CASE WHEN pos < but_at THEN 0.5e0 WHEN pos > but_at THEN 1.5e0 ELSE 1e0 END AS x FROM buts)",
        f"""sums AS (SELECT {key}, sum(x ORDER BY pos) AS raw, coalesce(sum(x + 1 ORDER BY pos) FILTER (x > 0), 0) AS p,
          coalesce(sum(x - 1 ORDER BY pos) FILTER (x < 0), 0) AS n, count(*) FILTER (x = 0) AS z FROM weighed GROUP BY {key})""",
        f"""marks AS (SELECT {key}, least(length({column}) - length(replace({column}, '!', '')), 4) * 0.292e0
          + CASE WHEN q > 3 THEN 0.96e0 WHEN q > 1 THEN q * 0.18e0 ELSE 0e0 END AS emphasis
          FROM (SELECT *, length({column}) - length(replace({column}, '?', '')) AS q FROM {source}))""",
        f"""parts AS (SELECT {key}, coalesce(raw + sign(raw) * emphasis, 0) AS raw, coalesce(z, 0) AS z,
          coalesce(CASE WHEN p > -n THEN p + emphasis ELSE p END, 0) AS p, coalesce(CASE WHEN p < -n THEN n - emphasis ELSE n END, 0) AS n
          FROM marks LEFT JOIN sums USING ({key}))""",
        f"""scored AS (SELECT {key}, round_even(raw / sqrt(raw * raw + 15), 4) AS compound,
          CASE WHEN t > 0 THEN round_even(p / t, 3) ELSE 0 END AS positive, CASE WHEN t > 0 THEN round_even(z / t, 3) ELSE 0 END AS neutral,
          CASE WHEN t > 0 THEN round_even(abs(n) / t, 3) ELSE 0 END AS negative FROM (SELECT *, p + abs(n) + z AS t FROM parts))""",
    ]


MOOD_SQL = (f"moody AS (SELECT doc_id, category, {noisy_sql('headline', MOOD_NOISE)} AS headline, "
            f"{noisy_sql('short_description', MOOD_NOISE)} AS short_description, {noisy_sql('text', MOOD_NOISE)} AS text FROM articles)")
SCORES_SQL = "SELECT doc_id, compound, positive, neutral, negative FROM scored"


def moody(spark, folder, *columns):
    rows = text_articles(spark, folder, "doc_id", "category", "date", "headline", "short_description", "text").withColumns({
        c: noisy(F.col(c), MOOD_NOISE) for c in ("headline", "short_description", "text")
    })
    return rows.select(*columns)


@query("x10_sentiment_headlines", over_articles(SCORES_SQL, MOOD_SQL,
    "whole AS (SELECT doc_id, headline || ' ' || short_description AS whole FROM moody)", *sentiment_ctes("doc_id", "whole", "whole")))
def sentiment_headlines(spark, folder):
    """Headline and description, joined by a blank."""
    whole = moody(spark, folder, "doc_id", F.concat_ws(" ", "headline", "short_description").alias("whole"))
    return SentimentScorer().score(whole, "whole").drop("whole")


@query("x10_sentiment_words", """
WITH """ + ",\n".join(sentiment_ctes("doc_id", "documents", "text")) + "\n" + SCORES_SQL)
def sentiment_words(spark, folder):
    """Unchanged documents: few opinion words, long texts."""
    rows = read_texts(spark, folder, "documents", "doc_id", "text")
    return SentimentScorer().score(rows, "text").drop("text")


@query("x11_raw_text_sentiment", over_articles(SCORES_SQL, MOOD_SQL, *sentiment_ctes("doc_id", "moody", "text")))
def raw_text_sentiment(spark, folder):
    """The serving variant scores the raw text."""
    return SentimentScorer().score(moody(spark, folder, "doc_id", "text"), "text").drop("text")


@query("x11_batch_text_sentiment", over_articles(
    SCORES_SQL, LEX_SQL, STOP_SQL, KEEP_SQL, MOOD_SQL,
    "full_text AS (SELECT doc_id, " + strip_sql("headline || ' . ' || short_description") + " AS f FROM moody)",
    *token_ctes("doc_id", "full_text", "f"),
    f"""texts AS (SELECT doc_id, coalesce(s, '') AS s FROM moody LEFT JOIN (
      SELECT doc_id, string_agg(lemma, ' ' ORDER BY pos) AS s FROM ann WHERE {BATCH_RULE} GROUP BY doc_id) USING (doc_id))""",
    *[c.replace("raw AS (SELECT doc_id, unnest", "raw_words AS (SELECT doc_id, unnest").replace("FROM raw)", "FROM raw_words)")
      for c in sentiment_ctes("doc_id", "texts", "s")]))
def batch_text_sentiment(spark, folder):
    """The batch variant scores the annotated sentiment text."""
    rows = moody(spark, folder, "doc_id", text.combine(F.col("headline"), F.col("short_description")).alias("full"))
    clean = ops.with_tokens(ops.with_clean_text(rows, "full"), Tagger(LEXICON))
    texts = clean.select("doc_id", tagging.sentiment_text(F.col("_tokens"), STOPS, KEEP_WORDS).alias("s"))
    return SentimentScorer().score(texts, "s").drop("s")
