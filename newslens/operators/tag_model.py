"""A hidden Markov model of part-of-speech tags, trained on tagged tokens.

Counts of neighbouring tags, of words by tag and of endings by tag come from three aggregations.
Tagging finds the likeliest sequence (Viterbi) for all articles of an Arrow batch at once, one
token of each at a time, so that a step is one numpy operation over articles x tags x tags. Words that training
has not seen are judged by their longest known ending.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

#: Words and endings that a model holds at most, as it is sent to the workers; the most frequent ones stay.
MOST_WORDS, MOST_ENDINGS = 200_000, 50_000
#: Longest ending looked at, and the count up to which a word is rare enough to speak for unknown ones.
ENDING, RARE = 3, 10
#: Cells of articles x tokens x tags that are worked on at once.
CELLS = 1 << 21


class TagModel:
    """``start`` and ``step`` are log probabilities of tags, ``words`` and ``endings`` log likelihoods by tag, with a row each."""

    def __init__(self, tags: Sequence[str], start: np.ndarray, step: np.ndarray, words: dict[str, np.ndarray], endings: dict[str, np.ndarray]):
        self.tags, self.start, self.step, self.words, self.endings = list(tags), start, step, words, endings

    @classmethod
    def fit(cls, df: DataFrame, words: str, tags: str, smoothing: float = 0.1) -> TagModel:
        """Train on rows with an array of words and the array of their tags; empty and null arrays say nothing."""
        rows = df.select(F.col(words).alias("w"), F.col(tags).alias("t")).where(F.size("t") > 0)
        earlier = F.concat(F.array(F.lit("")), F.col("t"))
        pairs = rows.select(F.explode(F.filter(F.arrays_zip(earlier.alias("a"), F.col("t").alias("b")), lambda p: p["b"].isNotNull())).alias("p"))
        pairs = pairs.groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n")).collect()  # tags x tags
        if not pairs:
            raise ValueError("no tagged tokens to train on")
        names = sorted({r["b"] for r in pairs})
        place = {t: i for i, t in enumerate(names)}
        step = np.full((len(names) + 1, len(names)), smoothing)
        for r in pairs:
            step[place.get(r["a"], len(names)), place[r["b"]]] += r["n"]
        step = np.log(step / step.sum(axis=1, keepdims=True))
        tokens = rows.select(F.explode(F.arrays_zip("w", "t")).alias("x"))
        counted = tokens.groupBy("x.w", "x.t").agg(F.count(F.lit(1)).alias("n"))
        by_word = counted.groupBy("w").agg(F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("t", "n"))).alias("tags"))
        total = np.array([sum(r["n"] for r in pairs if r["b"] == t) for t in names], float)

        def likelihood(row) -> np.ndarray:
            """By tag; ``smoothing`` occurrences of each tag are taken to be dealt out as all words are."""
            seen = np.full(len(names), smoothing * row["n"] / total.sum())
            for tag, n in row["tags"].items():
                seen[place[tag]] += n
            return np.log(seen / (total + smoothing))

        known = {r["w"]: likelihood(r) for r in by_word.orderBy(F.desc("n"), "w").limit(MOST_WORDS).collect()}
        ends = F.explode(F.array(*(F.when(F.length("w") >= n, F.substring("w", -n, n)) for n in range(ENDING + 1))))
        rare = by_word.where(F.col("n") <= RARE).select("w", F.explode("tags").alias("t", "n"))
        ended = rare.select(ends.alias("e"), "t", "n").where("e IS NOT NULL").groupBy("e", "t").agg(F.sum("n").alias("n"))
        by_end = ended.groupBy("e").agg(F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("t", "n"))).alias("tags"))
        endings = {r["e"]: likelihood(r) for r in by_end.orderBy(F.desc("n"), "e").limit(MOST_ENDINGS).collect()}
        endings.setdefault("", np.zeros(len(names)))
        return cls(names, step[-1], step[:-1], known, endings)

    def _of(self, word: str) -> np.ndarray:
        found = self.words.get(word)
        for n in range(min(ENDING, len(word)), -1, -1):
            if found is not None:
                break
            found = self.endings.get(word[len(word) - n:])
        return found

    def sequences(self, articles: Sequence[Sequence[str]]) -> list[list[str]]:
        """The likeliest tags of each article's words."""
        out: list[list[str]] = [[]] * len(articles)
        order = [i for i in sorted(range(len(articles)), key=lambda i: len(articles[i])) if len(articles[i])]
        low = 0
        while low < len(order):  # articles of like length, so many as fit the cells when padded to the longest
            high = low + 1
            while high < len(order) and (high - low + 1) * len(articles[order[high]]) * len(self.tags) <= CELLS:
                high += 1
            for i, tags in zip(order[low:high], self._together([articles[i] for i in order[low:high]])):
                out[i] = tags
            low = high
        return out

    def _together(self, articles: list[Sequence[str]]) -> list[list[str]]:
        sizes = np.array([len(a) for a in articles])
        longest, k = int(sizes.max()), len(self.tags)
        number: dict[str, int] = {}
        words = np.zeros((len(articles), longest), np.int64)
        for i, article in enumerate(articles):
            words[i, :len(article)] = [number.setdefault(w, len(number)) for w in article]
        emits = np.stack([self._of(w) for w in number])
        score, back = self.start + emits[words[:, 0]], np.zeros((longest, len(articles), k), np.int16)
        for at in range(1, longest):
            through = score[:, :, None] + self.step
            back[at] = through.argmax(axis=1)
            new = np.take_along_axis(through, back[at][:, None, :].astype(np.int64), axis=1)[:, 0, :] + emits[words[:, at]]
            score = np.where((at < sizes)[:, None], new, score)
        tag, rows, found = score.argmax(axis=1), np.arange(len(articles)), np.zeros((len(articles), longest), np.int64)
        for at in range(longest - 1, -1, -1):
            inside = at < sizes
            found[inside, at] = tag[inside]
            if at:
                tag = np.where(inside, back[at][rows, tag], tag)
        return [[self.tags[t] for t in found[i, :n]] for i, n in enumerate(sizes)]

    def tag(self, df: DataFrame, words: str, name: str = "tags") -> DataFrame:
        """Add the array of tags of an array of words; null stays null, empty stays empty."""
        sent = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("array<string>")
        def likeliest(rows: pd.Series) -> pd.Series:
            found = sent.value.sequences([() if r is None else r for r in rows])
            return pd.Series([None if r is None else tags for r, tags in zip(rows, found)], dtype=object)

        return df.withColumn(name, likeliest(words))


def agreement(one: Column, two: Column) -> Column:
    """How many places of two arrays of tags are equal."""
    return F.aggregate(F.zip_with(one, two, lambda a, b: (a == b).cast("int")), F.lit(0), lambda acc, x: acc + F.coalesce(x, F.lit(0)))
