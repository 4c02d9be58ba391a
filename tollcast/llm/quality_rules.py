"""Quality rules combined by weak supervision.

Each rule votes good (+1), bad (-1) or abstains (0) on a document.  Votes of
one pattern are alike, so one aggregate counts the patterns (at most 3 to the
number of rules, whatever the corpus), expectation-maximisation on these
counts estimates how right each rule's votes are, and every pattern
gets a posterior probability of good quality.  That probability replaces
"must pass all rules".

The statistics of all documents are written once to the shared checkpoint
folder and read twice, for the counts and for the verdicts.

Defined cases: a NULL text has no words and fails the base rules; repeated
rows get equal results; an empty table gives an empty result; votes that do
not occur leave a rule's accuracy where it started.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\v\f\r"
_WINDOW = 5

_STATS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, "
          "n_repeat_words long, n_upper long, n_letters long, n_ends long, n_letter_words long")


def repeated_words(words: list, window: int = _WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more, the first one included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for i in range(window):  # equal windows have equal numbers
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n]
    order = np.argsort(mixed, kind="stable")
    s = mixed[order]
    same = np.r_[False, s[1:] == s[:-1]]
    if not same.any():
        return 0
    maybe = order[same | np.r_[same[1:], False]].tolist()
    seen: dict[tuple, list[int]] = {}
    for i in maybe:  # and unequal ones with equal numbers are told apart here
        seen.setdefault(tuple(words[i:i + window]), []).append(i)
    covered = np.zeros(len(words) + 1, np.int64)
    for at in seen.values():
        if len(at) > 1:
            at = np.array(at)
            covered[at] += 1
            np.add.at(covered, at + window, -1)
    return int((np.cumsum(covered) > 0).sum())


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """By code point: 0 no letter, 1 a letter, 2 a capital."""
    return np.array([(2 if c.isupper() else 1) if c.isalpha() else 0
                     for c in map(chr, range(0x110000))], np.uint8)


def text_statistics(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = text.encode("utf-8").split()  # bytes: only \x20 and \x09-\x0D part words
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = _kinds()[points]
    letter = np.flatnonzero(kinds)
    space = (points == 32) | ((points >= 9) & (points <= 13))
    word = np.cumsum(space)[letter]  # letters with no space between them are in one word
    with_letter = int((np.diff(word) > 0).sum()) + 1 if len(letter) else 0
    return (len(words), len(text) - sum(map(text.count, _SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), len(lines), repeated_words(words), int((kinds == 2).sum()), len(letter),
            sum(x.rstrip(_SPACES)[-1] in ".!?\"')" for x in lines),
            with_letter)


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    @F.pandas_udf(_STATS)
    def stats(texts: pd.Series) -> pd.DataFrame:
        names = [x.split()[0] for x in _STATS.split(", ")]
        return pd.DataFrame([text_statistics(t) for t in texts], columns=names)

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.select("doc_id", stats.asNondeterministic()("text").alias("s")).select("doc_id", "s.*")


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def _share(part: str, whole: str) -> Column:
    return F.try_divide(F.col(part).cast("double"), F.col(whole))


def votes() -> dict[str, Column]:
    """The rules: name -> vote of a row of ``statistics`` (NULL counts as abstention)."""
    size, words = _share("word_chars", "n_words"), F.col("n_words")
    repeats, symbols = _share("n_repeat_words", "n_words"), _share("n_symbols", "n_words")
    lines, upper = _share("n_dup_lines", "n_lines"), _share("n_upper", "n_letters")
    letters, ends = _share("n_letters", "word_chars"), _share("n_ends", "n_lines")
    worded = _share("n_letter_words", "n_words")
    return {
        "length": _vote(words >= 30, words < 10),
        "word_size": _vote((size >= 3) & (size <= 9), (size < 2) | (size > 14)),
        "symbols": _vote(symbols < 0.02, symbols > 0.1),
        "duplicate_lines": _vote((lines < 0.05) & (F.col("n_lines") > 1), lines > 0.3),
        "repeats": _vote(repeats < 0.05, repeats > 0.2),
        "capitals": _vote(upper < 0.15, upper > 0.4),
        "letters": _vote(letters > 0.9, letters < 0.67),
        "letter_words": _vote(worded > 0.9, worded < 0.8),
        "line_ends": _vote(ends >= 0.7, (ends < 0.1) & (F.col("n_lines") >= 3)),
    }


class LabelModel:
    """Rules as voters of unknown accuracy, fitted by expectation-maximisation.

    For each rule and each vote, a rate for good and one for bad documents:
    how often it votes so.  A vote's weight is the logarithm of their ratio, an
    abstention says nothing.  The share of good documents is a parameter (where
    silence says nothing, votes alone do not tell it); ``strength`` documents'
    worth of the starting rates keep rules that seldom vote in place.
    """

    #: Starting rates of a good and of a bad vote, for good and for bad documents.
    START = {1: (0.9, 0.7), -1: (0.01, 0.4)}

    def __init__(self, rules: int, prior: float = 0.85, strength: float = 20):
        self.prior, self.strength = prior, strength
        self.rates = {v: [np.full(rules, r) for r in rates] for v, rates in self.START.items()}

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        odds = math.log(self.prior / (1 - self.prior))
        odds = odds + sum((patterns == v) @ np.log(good / bad) for v, (good, bad) in self.rates.items())
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))

    def accuracy(self, vote: int) -> np.ndarray:
        """How often each rule's vote of this kind is right."""
        good, bad = self.prior * self.rates[vote][0], (1 - self.prior) * self.rates[vote][1]
        return (good if vote == 1 else bad) / (good + bad)

    def fit(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 500) -> LabelModel:
        for _ in range(rounds):
            good = self.posterior(patterns)
            moved = 0.0
            for v, start in self.START.items():
                for k, weight in enumerate((good * counts, (1 - good) * counts)):
                    rate = ((weight @ (patterns == v) + self.strength * start[k])
                            / (weight.sum() + self.strength))
                    rate = np.clip(rate, 1e-4, 1 - 1e-4)
                    moved = max(moved, float(np.abs(rate - self.rates[v][k]).max()))
                    self.rates[v][k] = rate
            if moved < 1e-7:
                break
        return self


def judge(docs: DataFrame, min_posterior: float = 0.5, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """Per row: doc_id, the statistics, ``posterior``, ``base_failed`` and ``kept``."""
    rules = votes()
    names = list(rules)
    stats = written(statistics(docs, doc_id, text), "quality-statistics")
    pattern = F.array(*[F.coalesce(c, F.lit(0)).cast("int") for c in rules.values()])
    voted = stats.withColumn("pattern", F.array_join(pattern.cast("array<string>"), ","))
    found = voted.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()  # <= 3**rules
    base_failed = ((F.col("n_words") < 10)
                   | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    if found:
        seen = np.array([list(map(int, r["pattern"].split(","))) for r in found], float)
        model = LabelModel(len(names)).fit(seen, np.array([r["n"] for r in found], float))
        chance = list(zip((r["pattern"] for r in found), model.posterior(seen).tolist()))
    else:
        chance = []
    table = docs.sparkSession.createDataFrame(chance, "pattern string, posterior double")
    # at most 3**rules rows: a proven bound, so the broadcast is safe
    out = voted.join(F.broadcast(table), "pattern", "left").withColumn("base_failed", base_failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= min_posterior))
