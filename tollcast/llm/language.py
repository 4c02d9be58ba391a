"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent letter n-grams (one to
three characters, words set off by a blank).  A document's own list is held
against each profile: every n-gram adds the distance between its two ranks,
or the list's length where the profile lacks it.  The language of the
smallest sum is predicted; the score is 1 minus that sum over its largest
possible value.

An n-gram is one 64-bit number of up to three 21-bit code points, so a whole
document is counted by sorting an array.

Training takes a hash sample of labelled rows, expected to hold at most
``sample_rows`` documents of each language (all of a rarer one), counts the
n-grams of whole texts in the tasks and sums them in a shuffle.  What is kept
is ``profile_size`` n-grams for each language.

Defined cases: a text that is NULL or has no letter gets ``und`` and score 0;
languages of equal distance go by name; rows without a language label teach
nothing; with nothing learned every text is ``und``; repeated rows get equal
results.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep_probability, packed

UNKNOWN = "und"
PROFILE_SIZE = 400
SAMPLE_ROWS = 2000

_NO_LETTERS = re.compile(r"[\W\d_]+")
_BITS = 21


def ngram_keys(text: str) -> np.ndarray:
    """The 1- to 3-grams of a text's lower-case letters, blanks between words; none without a letter."""
    words = _NO_LETTERS.sub(" ", text.lower()).strip()
    if not any(map(str.isalpha, words)):  # signs like one half count as word characters
        return np.zeros(0, np.int64)
    c = np.frombuffer(f" {words} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    two = (c[:-1] << _BITS) | c[1:]
    three = (two[:-1] << _BITS) | c[2:]
    letters = c[c != 32]
    # a blank says where a word begins or ends; alone or in the middle it says nothing
    return np.concatenate([letters, two, three[c[1:-1] != 32]])


def top_ngrams(keys: np.ndarray, size: int) -> np.ndarray:
    """The most frequent keys, ties by key."""
    found, counts = np.unique(keys, return_counts=True)
    return found[np.argsort(-counts, kind="stable")[:size]]


@dataclass
class Profiles:
    """Ranked n-grams by language, as one sorted array of keys and a rank matrix."""

    languages: list[str]
    keys: np.ndarray
    ranks: np.ndarray
    size: int

    @classmethod
    def of(cls, ranked: dict[str, list[int]], size: int) -> Profiles:
        names = sorted(ranked)
        keys = np.unique(np.array([k for n in names for k in ranked[n]], np.int64))
        ranks = np.full((len(names), len(keys)), size, np.int64)
        for i, n in enumerate(names):
            ranks[i, np.searchsorted(keys, ranked[n])] = np.arange(len(ranked[n]))
        return cls(names, keys, ranks, size)

    def predict(self, text: str | None) -> tuple[str, float]:
        grams = top_ngrams(ngram_keys(text or ""), self.size)
        if not len(grams) or not len(self.keys):
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
        ranks = np.where(self.keys[at] == grams, self.ranks[:, at], self.size)
        apart = np.where(ranks < self.size, np.abs(ranks - np.arange(len(grams))), self.size)
        sums = apart.sum(axis=1)
        best = int(np.argmin(sums))
        return self.languages[best], float(1 - sums[best] / (self.size * len(grams)))


def _count_batches(batches):
    for pdf in batches:
        for lang, texts in pdf.groupby("lang")["text"]:
            # joined by a character that is no letter: no n-gram across texts
            keys, counts = np.unique(ngram_keys("\n".join(texts)), return_counts=True)
            yield pd.DataFrame({"lang": lang, "key": keys, "n": counts})


def learn_profiles(docs: DataFrame, profile_size: int = PROFILE_SIZE,
                   sample_rows: int = SAMPLE_ROWS, seed: int = 1, doc_id: str = "doc_id",
                   text: str = "text", lang: str = "lang") -> Profiles:
    """Profiles of the languages labelled in ``docs``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       F.col(lang).alias("lang")).filter("lang is not null")
    share = {r["lang"]: min(1.0, sample_rows / r["n"])  # a row for each language
             for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not share:
        return Profiles([], np.zeros(0, np.int64), np.zeros((0, 0), np.int64), profile_size)
    wanted = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])[F.col("lang")]
    sample = rows.filter((keep_probability(F.col("doc_id"), seed) < wanted) & F.col("text").isNotNull())
    counts = (sample.select("lang", "text").mapInPandas(_count_batches, "lang string, key long, n long")
              .groupBy("lang", "key").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "key")
    top = counts.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= profile_size)
    ranked: dict[str, list[int]] = {}
    for r in top.orderBy("lang", "r").collect():  # profile_size rows for each language
        ranked.setdefault(r["lang"], []).append(r["key"])
    return Profiles.of(ranked, profile_size)


def language_of(text: Column, profiles: Profiles) -> Column:
    """A struct (lang_pred, score) for a text column."""
    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([profiles.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predicted.asNondeterministic()(text)  # evaluated once, before any filter on it


def identify(docs: DataFrame, profiles: Profiles, doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) per row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), language_of(F.col(text), profiles).alias("p"))
    return rows.select("doc_id", "p.lang_pred", "p.score")


def keep_identified(docs: DataFrame, profiles: Profiles, languages: list[str] | None = None,
                    min_score: float = 0.0) -> DataFrame:
    """The rows whose text is in a learned language (of ``languages``, if given) with a
    score above ``min_score``; their columns as they were."""
    rows = docs.select(packed(docs).alias("row"), language_of(F.col("text"), profiles).alias("p"))
    good = (F.col("p.lang_pred") != UNKNOWN) & (F.col("p.score") > min_score)
    if languages is not None:
        good = good & F.col("p.lang_pred").isin(languages)
    return rows.filter(good).select("row.*")
