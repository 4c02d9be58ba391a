"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a whole text: densities of lexicon words (plain, and behind
digits, signs, dots or stretched letters), their weight, how near they stand
to a second-person word, capitals, punctuation and the rate of obfuscated
words.  The lexicon is a short fixed list and the words and word beginnings
that a bounded sample of labelled rows shows much more often in toxic texts.

What is learned from: a hash sample of the labelled rows, expected to hold
``sample_docs`` documents of each class, whole texts.  Three quarters of it
train the trees, the rest the isotonic curve; weights undo the sampling.

Defined cases: NULL and empty texts have all features 0 and the score of
such; labels that are NULL or have no row teach nothing; where a class is
missing, the score is the share of label 1 among what was seen (0.5 if
nothing was); repeated rows get equal results.
"""

from __future__ import annotations

import math
import re
import string

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_probability, written

SAMPLE_DOCS = 3000
LEXICON_WORDS = 200
#: Toxic documents an entry must stand in, and how many times likelier than in others, to be learned.
MIN_DOCS, MIN_RATIO = 5, 15.0
#: Letters of the word beginnings that may be entries (written with a star).
STEMS = (4, 5, 6)
TREES, DEPTH, LEAF_DOCS = 24, 3, 20
#: Words between a lexicon word and a second-person word that count as near.
NEAR = 5
#: Share of the trees' own probability in the score: it orders texts that the curve holds equal.
FINE = 0.02

#: Fixed short lexicon of insults.
SEED_LEXICON = ("clown", "disgusting", "dumb", "fool", "garbage", "idiot", "imbecile", "jerk", "loser",
                "moron", "pathetic", "scum", "stupid", "trash", "ugly", "vermin", "worthless")
#: Fixed second-person words of the languages at hand.
SECOND_PERSON = frozenset(("you", "your", "yours", "you're", "youre", "yourself", "ya", "u", "ur", "du",
                           "dich", "dir", "dein", "deine", "tu", "te", "toi", "ton", "vous", "votre",
                           "usted", "ti", "vos"))
#: Fixed look-alikes.
_LOOK_ALIKE = str.maketrans("013457@$!|", "oieastasil")

FEATURES = ("log_words", "lexicon_rate", "lexicon_weight", "lexicon_top", "lexicon_log", "hidden_rate",
            "near_rate", "second_person_rate", "capitals_rate", "shouted_rate", "exclamation_rate",
            "punctuation_rate", "obfuscation_rate", "stretched_rate")

_EDGE = string.punctuation + "«»“”„’…"
_MIXED = re.compile(r"[^\W\d_][\d@$!|*._-]+[^\W\d_]|^[\d@$!|]+[^\W\d_]|[^\W\d_][\d@$]+$")
_STRETCH = re.compile(r"(.)\1{2,}")
_NOT_LETTER = re.compile(r"[\W\d_]+")
_UPPER = re.compile(r"[^\W\d_a-zß-öø-ÿ]")
_PUNCTUATION = re.compile(r"[!-/:-@\[-`{-~]")


def plain_form(word: str) -> str:
    """A word without look-alikes, inner signs and stretched letters."""
    return _NOT_LETTER.sub("", _STRETCH.sub(r"\1", word.translate(_LOOK_ALIKE)))


class Lexicon:
    """Words and word beginnings with weights; remembers what it knows of a word, within a bound."""

    def __init__(self, weights: dict[str, float], entries: int = 300_000):
        self.weights, self.entries = weights, entries
        self._known: dict[str, tuple[float, int]] = {}

    def weight(self, core: str) -> float:
        """The greatest weight of the word and its beginnings."""
        get = self.weights.get
        return max(get(core, 0.0), *(get(core[:k] + "*", 0.0) for k in STEMS if len(core) > k), 0.0)

    def look(self, word: str) -> tuple[float, int]:
        """(weight, signs: 1 in the lexicon, 2 only in plain form, 4 obfuscated, 8 stretched)."""
        got = self._known.get(word)
        if got is None:
            if len(self._known) >= self.entries:
                self._known.clear()
            core = word.strip(_EDGE)
            weight = self.weight(core)
            signs = 1 if weight else 0
            odd, long = _MIXED.search(core) is not None, _STRETCH.search(core) is not None
            if not weight and (odd or long):
                weight = self.weight(plain_form(core))
                signs = 2 if weight else 0
            got = self._known[word] = (weight, signs | 4 * odd | 8 * (long and core.isalpha()))
        return got


def text_features(text: str | None, lexicon: Lexicon) -> tuple[float, ...]:
    text = text or ""
    words = text.lower().split()
    if not words:
        return (0.0,) * len(FEATURES)
    n, chars = len(words), len(text)
    looked = list(map(lexicon.look, words))
    hits = [(i, w, s) for i, (w, s) in enumerate(looked) if s]
    plain = [i for i, _, s in hits if s & 1]
    hidden = [i for i, _, s in hits if s & 2]
    toxic = [(i, w) for i, w, s in hits if s & 3]
    near = sum(any(words[j].strip(_EDGE) in SECOND_PERSON
                   for j in range(max(0, i - NEAR), min(n, i + NEAR + 1)) if j != i) for i, _ in toxic)
    second = sum(map(words.count, SECOND_PERSON)) if n < 50 else _count_in(words)
    return (math.log1p(n), len(plain) / n, sum(w for _, w in toxic) / n, max((w for _, w in toxic), default=0.0),
            math.log1p(len(toxic)), len(hidden) / n, near / n, second / n,
            len(_UPPER.findall(text)) / chars, sum(x.isupper() and len(x) > 2 for x in text.split()) / n,
            text.count("!") / chars, len(_PUNCTUATION.findall(text)) / chars,
            sum(1 for _, _, s in hits if s & 4) / n, sum(1 for _, _, s in hits if s & 8) / n)


def _count_in(words: list[str]) -> int:
    return sum(map(SECOND_PERSON.__contains__, words))


def _features(weights: dict[str, float]):
    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        lexicon = Lexicon(weights)
        return pd.Series([list(text_features(t, lexicon)) for t in texts], dtype=object)
    return features.asNondeterministic()


def learn_lexicon(sample: DataFrame, size: int = LEXICON_WORDS) -> dict[str, float]:
    """Weights of the fixed words, and of the words and word beginnings that a sample (text, y)
    shows far more in toxic texts."""
    def entries(word):
        stems = [F.when(F.length(word) > k, F.concat(F.substring(word, 1, k), F.lit("*"))) for k in STEMS]
        return F.array_compact(F.array(word, *stems))

    long = F.filter(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+")), lambda w: F.length(w) > 2)
    words = sample.select("y", F.explode(F.array_distinct(F.flatten(F.transform(long, entries)))).alias("word"))
    totals = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, fine = max(1, totals.get(1, 0)), max(1, totals.get(0, 0))
    counts = words.groupBy("word").agg(F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("fine"))
    ratio = ((F.col("bad") + 0.5) / bad) / ((F.col("fine") + 0.5) / fine)
    top = (counts.withColumn("ratio", ratio).filter((F.col("bad") >= MIN_DOCS) & (F.col("ratio") >= MIN_RATIO))
           .orderBy(F.desc(F.col("bad") * F.log("ratio")), "word").limit(size).collect())  # `size` rows
    weights = dict.fromkeys(SEED_LEXICON, 1.0)
    weights.update({r["word"]: min(8.0, math.log(r["ratio"])) for r in top})
    return weights


class ToxicityModel:
    """Lexicon, trees and isotonic curve; without trees, a constant score."""

    def __init__(self, weights, trees, curve, constant: float):
        self.weights, self.trees, self.curve, self.constant = weights, trees, curve, constant


def learn(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, seed: int = 3,
          doc_id: str = "doc_id", text: str = "text", label_id: str = "doc_id",
          label: str = "toxic") -> ToxicityModel:
    """A model of the rows of ``docs`` that ``labels`` marks 0 or 1."""
    marks = (labels.select(F.col(label_id).alias("doc_id"), F.col(label).cast("int").alias("y"))
             .filter("y in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("y").alias("y")))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter("text is not null")
    counts = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    seen = sum(counts.values())
    constant = counts.get(1, 0) / seen if seen else 0.5
    if len(counts) < 2:
        return ToxicityModel({}, None, None, constant)
    rate = {y: min(1.0, sample_docs / n) for y, n in counts.items()}
    share = F.when(F.col("y") == 1, rate[1]).otherwise(rate[0])
    # as many ids as the sample has documents: the bound of the broadcast
    chosen = marks.filter(keep_probability(F.col("doc_id"), seed) < share)
    sample = written(rows.join(F.broadcast(chosen), "doc_id"), "toxicity-sample")
    train = keep_probability(F.col("doc_id"), seed + 1) < 0.75
    weights = learn_lexicon(sample.filter(train))
    points = written(sample.select(
        "doc_id", F.col("y").cast("double").alias("y"), train.alias("train"),
        F.when(F.col("y") == 1, 1 / rate[1]).otherwise(1 / rate[0]).alias("w"),
        _features(weights)("text").alias("x")).repartition(4, "doc_id").sortWithinPartitions("doc_id"),
        "toxicity-points").withColumn("v", array_to_vector("x"))
    sides = {(r["train"], r["y"]) for r in points.select("train", "y").distinct().collect()}
    if len(sides) < 4:
        return ToxicityModel(weights, None, None, constant)
    trees = GBTClassifier(featuresCol="v", labelCol="y", weightCol="w", maxIter=TREES, maxDepth=DEPTH,
                          stepSize=0.2, maxBins=32, seed=seed, minInstancesPerNode=LEAF_DOCS)
    trees = trees.fit(points.filter("train").coalesce(4))
    raw = trees.transform(points.filter(~F.col("train"))).select(
        vector_to_array("probability")[1].alias("p"), "y", "w")
    curve = IsotonicRegression(featuresCol="p", labelCol="y", weightCol="w", predictionCol="calibrated").fit(raw)
    return ToxicityModel(weights, trees, curve, constant)


def score(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted) per row, and the features as ``features``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.select("doc_id", _features(model.weights)("text").alias("features"))
    if model.trees is None:
        rows = rows.withColumn("score", F.lit(float(model.constant)))
    else:
        raw = model.trees.transform(rows.withColumn("v", array_to_vector("features")))
        raw = raw.select("doc_id", "features", vector_to_array("probability")[1].alias("p"))
        rows = model.curve.transform(raw).withColumn(
            "score", (1 - FINE) * F.col("calibrated") + FINE * F.col("p"))
    return rows.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "features")
