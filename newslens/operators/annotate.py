"""Article annotation: cleaned text -> tokens -> texts, counts and patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from newslens.functions import tagging, text
from newslens.functions.tagging import Tagger
from newslens.functions.wordlists import KEEP_WORDS, annotator_stop_words

PURPOSES = ("topic", "sentiment", "both")


def with_clean_text(df: DataFrame, text_col: str, tag_on: str = "lower") -> DataFrame:
    """Add ``_clean`` and ``_quotes``.

    ``tag_on='lower'`` lowers the text before tagging (so proper nouns come from
    the lexicon only); ``'original'`` keeps its case for the tagger.
    """
    source = F.lower(F.col(text_col)) if tag_on == "lower" else F.col(text_col)
    expanded = df.withColumn("_expanded", text.expand_contractions(source))
    return expanded.withColumns({
        "_quotes": text.quoted_spans(F.col("_expanded")),
        "_clean": text.scrub(F.col("_expanded")),
    }).drop("_expanded")


def with_tokens(df: DataFrame, tagger: Tagger) -> DataFrame:
    """Add ``_words``, the words of ``_clean``, and ``_tokens``, the same annotated."""
    return df.withColumn("_words", tagging.tokenize(F.col("_clean"))).withColumn("_tokens", tagger.annotate(F.col("_words")))


def annotate(
    df: DataFrame,
    headline: str = "headline",
    description: str = "short_description",
    *,
    tagger: Tagger | None = None,
    stop_words: list[str] | None = None,
    keep_words: list[str] = KEEP_WORDS,
    purpose: str = "both",
    mode: str = "batch",
    tag_on: str = "lower",
) -> DataFrame:
    """Add ``processed_text, sentiment_text, pos_features, news_patterns``.

    One pass over each article, no shuffle. A line of its words crosses to one Python worker of
    the task, which answers with the tags and the texts, each a line as well. Both texts missing or blank gives
    empty texts, zero counts and empty lists. Texts not asked for by ``purpose``
    are empty; columns not used downstream are pruned by the optimizer.
    """
    if purpose not in PURPOSES:
        raise ValueError(f"purpose must be one of {PURPOSES}")
    stops = annotator_stop_words() if stop_words is None else stop_words
    combine = text.combine if mode == "batch" else text.combine_stripped
    full = combine(F.col(headline), F.col(description))
    staged = df.withColumn("_full", F.when(full == ".", "").otherwise(full))
    staged = with_clean_text(staged, "_full", tag_on)
    tagger = tagger or Tagger(cased=tag_on == "original")
    staged = staged.withColumn("_line", F.array_join(tagging.tokenize(F.col("_clean")), " ")).drop("_full", "_clean")
    line, quotes = F.col("_line"), F.col("_quotes")
    # side by side, so that one worker evaluates them all
    staged = staged.withColumns({
        "_tags": tagger.tags(line),
        "_topic_text": for_purpose(tagger.topic_text(line, stops), "processed_text", purpose),
        "_sentiment_text": for_purpose(tagger.sentiment_text(line, stops, keep_words, mode), "sentiment_text", purpose),
    })
    staged = staged.withColumn("_tokens", tagging.tokens_of(line, F.col("_tags")))
    tokens = F.col("_tokens")
    return staged.select(
        *[F.col(c) for c in df.columns],
        F.col("_topic_text").alias("processed_text"),
        F.col("_sentiment_text").alias("sentiment_text"),
        tagging.tag_counts(F.col("_tags"), quotes).alias("pos_features"),
        text.complete_patterns({
            "named_entities": tagging.named_entities(tokens),
            "action_phrases": tagging.followed_by_noun(tokens, "VB"),
            "descriptive_phrases": tagging.followed_by_noun(tokens, "JJ"),
            "quotes": quotes,
        }).alias("news_patterns"),
    )


def for_purpose(text_col: Column, name: str, purpose: str) -> Column:
    """One of the two texts as a purpose has it: empty, where it is not asked for."""
    asked = {"processed_text": purpose != "sentiment", "sentiment_text": purpose != "topic"}[name]
    return (text_col if asked else F.lit("")).alias(name)


def flatten_features(annotated: DataFrame) -> DataFrame:
    """Counts as flat columns: six part-of-speech counts and six pattern counts."""
    kept = [c for c in annotated.columns if c not in ("pos_features", "news_patterns")]
    return annotated.select(
        *kept, F.col("pos_features.*"), *text.pattern_counts(F.col("news_patterns"))
    )


def token_table(df: DataFrame, id_col: str) -> DataFrame:
    """The exploded form: one row per token with its zero-based position.

    Pattern operators over this table need a shuffle per document, so the
    row-local forms above are the ones to run at scale; this one is for
    joining tokens with tables too large for a dictionary.
    """
    return df.select(id_col, F.posexplode("_tokens").alias("pos", "t")).select(
        id_col, "pos", "t.word", "t.mark.tag", "t.mark.lemma"
    )


def tag_by_join(tokens: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Tag ``(…, word)`` rows from a lexicon table ``(word, tag, lemma)`` of any size.

    The lexicon has one row per word, so a very frequent word only makes the
    token side skewed, which adaptive execution splits.
    """
    known = lexicon.select("word", F.col("tag").alias("_tag"), F.col("lemma").alias("_lemma"))
    tagged = tokens.join(known, "word", "left").withColumn("_unknown", tagging.fallback_mark(F.col("word")))
    return tagged.withColumns({
        "tag": F.coalesce("_tag", "_unknown.tag"), "lemma": F.coalesce("_lemma", "_unknown.lemma")
    }).drop("_tag", "_lemma", "_unknown")


def entities_by_window(tokens: DataFrame, id_col: str) -> DataFrame:
    """Proper-noun runs from a token table: (id, start, entity)."""
    order = Window.partitionBy(id_col).orderBy("pos")
    proper = tokens.where(F.startswith("tag", F.lit("NNP"))).withColumn(
        "_island", F.col("pos") - F.row_number().over(order)
    )
    grouped = proper.groupBy(id_col, "_island").agg(
        F.min("pos").alias("start"),
        F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("_run"),
    )
    joined = F.array_join(F.transform("_run", lambda r: r["word"]), " ")
    return grouped.select(id_col, "start", joined.alias("entity"))


def phrases_by_window(tokens: DataFrame, id_col: str, prefix: str) -> DataFrame:
    """(id, pos, phrase): a token of the tag prefix followed by a noun."""
    order = Window.partitionBy(id_col).orderBy("pos")
    following = tokens.withColumns({
        "_word": F.lead("word").over(order), "_tag": F.lead("tag").over(order)
    })
    hits = following.where(
        F.startswith("tag", F.lit(prefix)) & F.startswith("_tag", F.lit("NN"))
    )
    return hits.select(id_col, "pos", F.concat_ws(" ", "word", "_word").alias("phrase"))
