"""Tokens, tags, lemmas and phrase patterns, all computed inside the row.

One article is one row, so nothing here shuffles: tokens become an array of
``struct<word, mark<tag, lemma>>`` and every later step filters or zips that array.
A word's mark depends on nothing but the word, so the distinct words of an Arrow batch are marked
once; the texts kept of a batch are looked up in the same way.
Neighbours are reached by zipping an array with its own shift, never by indexing
the array from inside a lambda, which would evaluate it once per element.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from newslens.functions.wordlists import tag_lexicon

# The possessive quantifier keeps Java's matcher iterative on long hyphen chains.
TOKEN = r"[A-Za-z0-9]+(?:['-][A-Za-z0-9]+)*+|[.,!?]"
PUNCTUATION = [".", ",", "!", "?"]
# Plural and third-person endings that lose two letters.
ES_ENDINGS = ["sses", "xes", "ches", "shes", "zes"]
DOUBLED = ["bb", "dd", "gg", "mm", "nn", "pp", "rr", "tt"]
#: Tokens whose lemmas a worker gathers at once, or those of one list.
TOKENS = 1 << 19
# Stands between named-entity runs while they are cut out of one string.
_BREAK = "\u0001"


def tokenize(clean_text: Column) -> Column:
    """Words (inner hyphens and apostrophes kept) and sentence punctuation."""
    return F.regexp_extract_all(clean_text, F.lit(TOKEN), F.lit(0))


def _ends(word: Column, *endings: str) -> Column:
    test = F.endswith(word, F.lit(endings[0]))
    for ending in endings[1:]:
        test = test | F.endswith(word, F.lit(ending))
    return test


def _drop(word: Column, n: int, extra: str = "") -> Column:
    stem = F.substring(word, F.lit(1), F.length(word) - n)
    return F.concat(stem, F.lit(extra)) if extra else stem


def _if(test: Column, then: Column | str, otherwise: Column | str) -> Column:
    # Inside lambdas expressions are interpreted, and there one long CASE walks its
    # branch list for every branch; nested two-way choices do not.
    return F.when(test, then).otherwise(otherwise)


def _noun_lemma(word: Column) -> Column:
    length = F.length(word)
    return _if(
        ~_ends(word, "s"), word,
        _if(_ends(word, "ies") & (length > 4), _drop(word, 3, "y"),
            _if(_ends(word, *ES_ENDINGS), _drop(word, 2),
                _if((length < 4) | _ends(word, "ss", "us", "is"), word, _drop(word, 1)))),
    )


def _verb_lemma(word: Column) -> Column:
    length = F.length(word)
    doubled_ing = F.substring(word, length - 4, F.lit(2)).isin(DOUBLED)
    doubled_ed = F.substring(word, length - 3, F.lit(2)).isin(DOUBLED)
    ing = _if((length > 6) & doubled_ing, _drop(word, 4), _if(length > 5, _drop(word, 3), word))
    ed = _if((length > 5) & doubled_ed, _drop(word, 3), _if(length > 4, _drop(word, 2), word))
    plain_s = _if(_ends(word, "ss") | (length < 4), word, _drop(word, 1))
    return _if(
        _ends(word, "ing"), ing,
        _if(_ends(word, "ies", "ied") & (length > 4), _drop(word, 3, "y"),
            _if(_ends(word, "ed"), ed,
                _if(_ends(word, *ES_ENDINGS), _drop(word, 2), _if(_ends(word, "s"), plain_s, word)))),
    )


def lemma_class(tag: Column) -> Column:
    """First letter of the tag -> a(djective) / n(oun) / v(erb) / r (adverb)."""
    first = F.substring(tag, 1, 1)
    return (
        F.when(first == "J", "a").when(first == "V", "v").when(first == "R", "r").otherwise("n")
    )


def fallback_mark(word: Column) -> Column:
    """Suffix rules for words the lexicon does not hold: struct<tag, lemma>."""
    length = F.length(word)

    def mark(tag: Column | str, lemma: Column) -> Column:
        tag = F.lit(tag) if isinstance(tag, str) else tag
        return F.struct(tag.alias("tag"), lemma.alias("lemma"))

    noun, verb, unchanged = mark("NN", _noun_lemma(word)), _verb_lemma(word), mark("NN", word)
    after_s = _if((length > 5) & _ends(word, "ous", "less"), mark("JJ", word),
                  _if((length > 3) & ~_ends(word, "ss"), mark("NNS", _noun_lemma(word)), noun))
    others = _if((length > 5) & _ends(word, "ful", "able", "ible", "ive"), mark("JJ", word), unchanged)
    lettered = _if(_ends(word, "s"), after_s,
                   _if(_ends(word, "ed") & (length > 4), mark("VBD", verb),
                       _if(_ends(word, "ing") & (length > 5), mark("VBG", verb),
                           _if(_ends(word, "ly") & (length > 4), mark("RB", word), others))))
    first = F.substring(word, 1, 1)
    numeric = _if(first <= "9", _if(word.isin(PUNCTUATION), mark(word, word), mark("CD", _noun_lemma(word))),
                  mark("?", word))
    # letters sort after digits and all punctuation but the question mark
    return _if(first > "?", lettered, numeric)


def _word_noun_lemma(word: str) -> str:
    if not word.endswith("s"):
        return word
    if word.endswith("ies") and len(word) > 4:
        return word[:-3] + "y"
    if word.endswith(tuple(ES_ENDINGS)):
        return word[:-2]
    return word if len(word) < 4 or word.endswith(("ss", "us", "is")) else word[:-1]


def _word_verb_lemma(word: str) -> str:
    n = len(word)
    if word.endswith("ing"):
        return word[:-4] if n > 6 and word[n - 5:n - 3] in DOUBLED else word[:-3] if n > 5 else word
    if word.endswith(("ies", "ied")) and n > 4:
        return word[:-3] + "y"
    if word.endswith("ed"):
        return word[:-3] if n > 5 and word[n - 4:n - 2] in DOUBLED else word[:-2] if n > 4 else word
    if word.endswith(tuple(ES_ENDINGS)):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") and n >= 4 else word


def word_mark(word: str) -> tuple[str, str]:
    """``fallback_mark`` of one word: (tag, lemma)."""
    n, first = len(word), word[:1]
    if first <= "9":
        return (word, word) if word in PUNCTUATION else ("CD", _word_noun_lemma(word))
    if first <= "?":
        return "?", word
    if word.endswith("s"):
        if n > 5 and word.endswith(("ous", "less")):
            return "JJ", word
        return "NNS" if n > 3 and not word.endswith("ss") else "NN", _word_noun_lemma(word)
    if word.endswith("ed") and n > 4:
        return "VBD", _word_verb_lemma(word)
    if word.endswith("ing") and n > 5:
        return "VBG", _word_verb_lemma(word)
    if word.endswith("ly") and n > 4:
        return "RB", word
    return "JJ" if n > 5 and word.endswith(("ful", "able", "ible", "ive")) else "NN", word


class Tagger:
    """Turns a token array into ``array<struct<word, mark: struct<tag, lemma>>>``.

    ``lexicon`` maps a lower-case word to ``(tag, lemma)``. With
    ``cased=True`` the tokens keep their case and a capitalised word outside
    the lexicon is a proper noun; by default tokens are lower case already.
    """

    def __init__(self, lexicon: Mapping[str, tuple[str, str]] | None = None, cased: bool = False):
        self.cased = cased
        self._lexicon = dict(tag_lexicon() if lexicon is None else lexicon)
        if any(" " in tag for tag, _ in self._lexicon.values()):
            raise ValueError("tags hold no blanks")

    def mark(self, word: str) -> tuple[str, str]:
        """(tag, lemma) of one word."""
        key = word.lower() if self.cased else word
        if key in self._lexicon:
            return self._lexicon[key]
        return ("NNP", _word_noun_lemma(key)) if self.cased and "A" <= word[:1] <= "Z" else word_mark(key)

    def annotate(self, tokens: Column) -> Column:
        mark = self.mark

        @F.arrow_udf("array<struct<word:string,mark:struct<tag:string,lemma:string>>>")
        def annotated(lists: pa.Array) -> pa.Array:
            offsets, words, at = _distinct_words(lists)
            marks = [mark(w) for w in words.to_pylist()]
            columns = [pa.array([m[i] for m in marks], pa.string()) for i in (0, 1)]
            entry = pa.StructArray.from_arrays([words, pa.StructArray.from_arrays(columns, names=["tag", "lemma"])], names=["word", "mark"])
            return pa.ListArray.from_arrays(offsets, entry.take(at), mask=lists.is_null())

        # so that no predicate on the result repeats the work, while unused results can go
        return annotated.asNondeterministic()(tokens)

    def tags(self, line: Column) -> Column:
        """The tags of a line's words, with blanks between them as in the line."""
        mark = self.mark
        return _joined(line, lambda word: mark(word)[0])

    def topic_text(self, words: Column, stop_words: list[str]) -> Column:
        """``topic_text`` of plain words: a list, or a line with blanks between them."""
        stops = frozenset(stop_words)
        return self._kept(words, lambda word, key, tag: len(word) > 2 and tag.startswith(("NN", "VB", "JJ")) and key not in stops)

    def sentiment_text(self, words: Column, stop_words: list[str], keep_words: Collection[str], mode: str = "batch") -> Column:
        """``sentiment_text`` of plain words: a list, or a line with blanks between them."""
        stops, keeps = frozenset(stop_words), frozenset(keep_words)

        def batch(word: str, key: str, tag: str) -> bool:
            return (tag.startswith("NN") and key not in stops) or always(tag) or key in keeps

        def serving(word: str, key: str, tag: str) -> bool:
            return key not in stops or always(tag)

        always = lambda tag: tag.startswith(("JJ", "RB", "VB")) or tag in PUNCTUATION
        return self._kept(words, {"batch": batch, "serving": serving}[mode])

    def _kept(self, words: Column, keep: Callable[[str, str, str], bool]) -> Column:
        """The lemmas of the words that ``keep`` (word, its lower case if cased, tag) accepts, in order."""
        mark, cased = self.mark, self.cased

        def kept_lemma(word: str) -> str | None:
            tag, lemma = mark(word)
            return lemma if keep(word, word.lower() if cased else word, tag) else None

        return _joined(words, kept_lemma)


def _joined(words: Column, choose: Callable[[str], str | None]) -> Column:
    """What ``choose`` gives for each word, with blanks between; words it gives nothing for are left out.

    A batch is worked on by stretches, so beside its texts a worker holds the words of one stretch only.
    """

    @F.arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        nested, texts = pa.types.is_nested(column.type), [pa.array([], pa.string())]
        sizes = (column.value_lengths() if nested else pc.add(pc.count_substring(column, " "), 1)).fill_null(0).to_numpy()
        for low, high in _stretches(np.concatenate([[0], np.cumsum(sizes)])):
            lists = column[low:high] if nested else pc.split_pattern(column[low:high], " ")
            offsets, distinct, at = _distinct_words(lists)
            # the one word of an empty line is empty, and none
            chosen = pa.array([choose(w) if w or nested else None for w in distinct.to_pylist()], pa.string())
            known = chosen.is_valid().to_numpy(zero_copy_only=False)
            stays = known[at.to_numpy()] if len(at) else np.zeros(0, bool)
            ends = np.concatenate([[0], np.cumsum(stays)])[offsets.to_numpy()]
            kept = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), chosen.take(at.filter(pa.array(stays))))
            texts.append(pc.binary_join(kept, " "))
        pa.default_memory_pool().release_unused()  # a worker waits for later tasks with what its pool holds
        return pc.if_else(column.is_null(), pa.scalar(None, pa.string()), pa.concat_arrays(texts))

    # so that no predicate on the result repeats the work, while unused results can go
    return text.asNondeterministic()(words)


def _stretches(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first list, end) of stretches of lists with at most TOKENS items, or one list, by the lists' offsets."""
    low = 0
    while low < len(bounds) - 1:
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + TOKENS, "right")) - 1)
        yield low, high
        low = high


def _distinct_words(lists: pa.ListArray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(offsets of the lists from 0, distinct words, the number of each item's word)."""
    coded = lists.flatten().dictionary_encode()
    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
    return pa.array(ends, pa.int32()), coded.dictionary, coded.indices


def words_of(line: Column) -> Column:
    """The words, or tags, of a line that has blanks between them; of an empty line an empty one."""
    return F.split(line, " ")


def tokens_of(line: Column, tags: Column) -> Column:
    """array<struct<word, mark: struct<tag>>> of a line and its tags."""
    return F.zip_with(words_of(line), words_of(tags), lambda w, t: F.struct(w.alias("word"), F.struct(t.alias("tag")).alias("mark")))


def tag_of(token: Column) -> Column:
    return token["mark"]["tag"]


def lemma_of(token: Column) -> Column:
    return token["mark"]["lemma"]


def tag_starts(token: Column, *prefixes: str) -> Column:
    test = F.startswith(tag_of(token), F.lit(prefixes[0]))
    for prefix in prefixes[1:]:
        test = test | F.startswith(tag_of(token), F.lit(prefix))
    return test


def topic_text(tokens: Column, stop_words: list[str], cased: bool = False) -> Column:
    """Lemmas of nouns, verbs and adjectives, longer than two letters, in order."""
    kept = F.filter(
        tokens,
        lambda t: (F.length(t["word"]) > 2)
        & tag_starts(t, "NN", "VB", "JJ")
        & ~_key(t, cased).isin(stop_words),
    )
    return F.array_join(F.transform(kept, lemma_of), " ")


def sentiment_text(
    tokens: Column, stop_words: list[str], keep_words: list[str], mode: str = "batch", cased: bool = False
) -> Column:
    """Text kept for sentiment scoring; ``mode`` picks the batch or serving rule."""

    def batch(t: Column) -> Column:
        return (
            (tag_starts(t, "NN") & ~_key(t, cased).isin(stop_words))
            | tag_starts(t, "JJ", "RB", "VB")
            | tag_of(t).isin(PUNCTUATION)
            | _key(t, cased).isin(keep_words)
        )

    def serving(t: Column) -> Column:
        return (
            ~_key(t, cased).isin(stop_words)
            | tag_starts(t, "JJ", "RB", "VB")
            | tag_of(t).isin(PUNCTUATION)
        )

    kept = F.filter(tokens, {"batch": batch, "serving": serving}[mode])
    return F.array_join(F.transform(kept, lemma_of), " ")


def _key(token: Column, cased: bool) -> Column:
    return F.lower(token["word"]) if cased else token["word"]


def pos_counts(tokens: Column, quotes: Column) -> Column:
    """Struct of the five tag-prefix counts and the quote count.

    The tags are joined into one text, in which a prefix is counted much faster
    than by filtering the array once per prefix.
    """
    return tag_counts(F.array_join(F.transform(tokens, tag_of), " "), quotes)


def tag_counts(tags: Column, quotes: Column) -> Column:
    """``pos_counts`` of a text's tags, which have blanks between them."""
    spaced = F.concat(F.lit(" "), tags)

    def count(prefix: str) -> Column:
        return F.regexp_count(spaced, F.lit(f" {prefix}"))

    return F.struct(
        count("JJ").alias("adj_count"),
        count("VB").alias("verb_count"),
        count("NN").alias("noun_count"),
        count("NNP").alias("proper_noun_count"),
        count("RB").alias("adv_count"),
        F.size(quotes).alias("quote_count"),
    )


def named_entities(tokens: Column) -> Column:
    """Maximal runs of proper nouns, each joined by a space."""
    marked = F.transform(
        tokens, lambda t: F.when(tag_starts(t, "NNP"), t["word"]).otherwise(F.lit(_BREAK))
    )
    text = F.regexp_replace(F.array_join(marked, " "), f"[{_BREAK} ]*{_BREAK}[{_BREAK} ]*", _BREAK)
    return F.filter(F.split(text, _BREAK), lambda run: run != "")


def entity_runs(tokens: Column) -> Column:
    """array<struct<start, entity>>: the named entities and where they start."""
    flags = F.transform(tokens, lambda t, i: F.struct(i.alias("at"), tag_starts(t, "NNP").alias("proper")))
    earlier = F.concat(F.array(F.lit(False)), F.transform(tokens, lambda t: tag_starts(t, "NNP")))
    starts = F.zip_with(flags, earlier, lambda f, e: F.when(f["proper"] & ~e, f["at"]))
    return F.arrays_zip(F.array_compact(starts).alias("start"), named_entities(tokens).alias("entity"))


def noun_pairs(tokens: Column, prefix: str) -> Column:
    """array<struct<pos, phrase>>: the pairs of ``followed_by_noun`` and where they start."""
    following = F.slice(tokens, F.lit(2), F.greatest(F.size(tokens), F.lit(1)))
    placed = F.transform(tokens, lambda t, i: F.struct(i.alias("at"), t.alias("token")))
    pairs = F.zip_with(placed, following, lambda a, b: F.when(
        tag_starts(a["token"], prefix) & tag_starts(b, "NN"),
        F.struct(a["at"].alias("pos"), F.concat_ws(" ", a["token"]["word"], b["word"]).alias("phrase"))))
    return F.array_compact(pairs)


def followed_by_noun(tokens: Column, prefix: str) -> Column:
    """'word next' pairs: a token of the given tag prefix and the noun after it."""
    following = F.slice(tokens, F.lit(2), F.greatest(F.size(tokens), F.lit(1)))
    pairs = F.zip_with(
        tokens, following,
        lambda a, b: F.when(
            tag_starts(a, prefix) & tag_starts(b, "NN"), F.concat_ws(" ", a["word"], b["word"])
        ),
    )
    return F.array_compact(pairs)
