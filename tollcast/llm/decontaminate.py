"""Benchmark decontamination by a BM25 index of test items and block-max WAND.

The test items are the indexed side, the training passages the queries.
An item's impacts are divided by the score that it gives itself, so a score
says how much of an item a passage holds and one threshold serves all items.
Every task runs over the whole text of its documents:

* the text is cut into passages, each twice as long as the longest item and
  half overlapping, and every passage is a query of its distinct terms;
* block-max WAND: items are cut into ranges, in which each term has a greatest
  impact; a range is skipped if the sum of the terms' maxima misses the
  threshold (summed for many passages at once in arrays), in the others the
  postings are walked from pivot to pivot and all items above the threshold
  are returned;
* each hit is verified: at least ``overlap`` of the five-word shingles of the
  item's question (all sentences but the last) and of its answer (the last
  one) must stand in the passage; a part of fewer words must stand there as
  it is, and so must a whole item of fewer words, question and answer as one
  run.

The index goes to the tasks in blocks of at most ``block_bytes`` of item text;
the documents are read once for each block.  Term statistics are those of all
items whatever the blocks.

Defined cases: NULL or empty texts and items without a word match nothing;
repeated items are matched each; repeated rows are reported each; empty tables
give an empty result; an item of one sentence is all question, with answer
overlap 1.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from functools import reduce
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, written

#: Usual BM25 constants.
K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.8
SHINGLE = 5
#: Items of a range.
BLOCK = 8
BLOCK_BYTES = 8_000_000
#: Words, and bounds of a passage in a range, that are held in arrays at once.
BATCH_WORDS, BATCH_BOUNDS = 500_000, 20_000_000

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_and_answer(text: str | None) -> tuple[list[str], list[str]]:
    """Words of all sentences but the last, and of the last; one sentence is all question."""
    parts = [w for w in map(words_of, _SENTENCE.split(text or "")) if w]
    if len(parts) < 2:
        return (parts[0] if parts else []), []
    return [w for p in parts[:-1] for w in p], parts[-1]


def shingles(words: list[str], n: int = SHINGLE) -> set[tuple[str, ...]]:
    return {tuple(words[i:i + n]) for i in range(max(0, len(words) - n + 1))}


def overlap(part: list[str], passage: list[str], held: set) -> float:
    """Share of the part's shingles in the passage (``held``: the passage's own)."""
    if not part:
        return 1.0
    if len(part) < SHINGLE:
        n = len(part)
        return float(any(passage[i:i + n] == part for i in range(len(passage) - n + 1)))
    own = shingles(part)
    return len(own & held) / len(own)


class ItemIndex:
    """Inverted index over some items, cut into ranges of ``BLOCK`` items of like length.

    Each term keeps its postings by item and its greatest impact in each range.
    """

    def __init__(self, items: list[tuple], df: dict[str, int], n_items: int, mean_words: float):
        parts = sorted(((question_and_answer(text), i) for i, text in items),
                       key=lambda x: len(x[0][0]) + len(x[0][1]))
        self.parts, self.ids = [p for p, _ in parts], [i for _, i in parts]
        every = [q + a for q, a in self.parts]
        self.span = max(map(len, every), default=1)
        found: dict[str, list[tuple[int, float]]] = {}
        for k, words in enumerate(every):
            tf = Counter(words)
            norm = K1 * (1 - B + B * len(words) / max(mean_words, 1e-9))
            score = {w: np.log1p((n_items - df[w] + 0.5) / (df[w] + 0.5)) * f * (K1 + 1) / (f + norm)
                     for w, f in tf.items()}
            own = sum(score.values())
            for w, s in score.items():
                found.setdefault(w, []).append((k, float(s / own)))
        self.terms = {w: i for i, w in enumerate(found)}
        self.ranges = -(-len(every) // BLOCK)
        self.postings: list[dict[int, list[tuple[int, float]]]] = []  # by term and range
        first, at, most = [0], [], []
        for pairs in found.values():
            cut: dict[int, list[tuple[int, float]]] = {}
            for k, s in pairs:
                cut.setdefault(k // BLOCK, []).append((k, s))
            self.postings.append(cut)
            at += list(cut)
            most += [max(s for _, s in p) for p in cut.values()]
            first.append(len(at))
        self.first, self.at, self.most = np.array(first), np.array(at, np.int64), np.array(most)

    def search(self, terms: list[int], block: int, floor: float) -> list[tuple[int, float]]:
        """All (item, score) of one range at or above the floor, by WAND with the range's maxima."""
        cursors = []  # [item, place, postings, greatest impact]
        for t in terms:
            p = self.postings[t].get(block)
            if p:
                cursors.append([p[0][0], 0, p, max(s for _, s in p)])
        out = []
        while cursors:
            cursors.sort(key=itemgetter(0))
            total, item = 0.0, None
            for c in cursors:
                total += c[3]
                if total >= floor:
                    item = c[0]  # the pivot: no smaller item can reach the floor
                    break
            if item is None:
                break
            if cursors[0][0] == item:
                score = sum(c[2][c[1]][1] for c in cursors if c[0] == item)
                if score >= floor:
                    out.append((item, score))
                goal = item + 1
            else:
                goal = item
            for c in cursors:
                while c[0] is not None and c[0] < goal:
                    c[1] += 1
                    c[0] = c[2][c[1]][0] if c[1] < len(c[2]) else None
            cursors = [c for c in cursors if c[0] is not None]
        return out

    def _candidates(self, known: list[np.ndarray], floor: float):
        """(text, passage, range, distinct terms) where the range's maxima reach the floor.

        A passage is two spans long and starts at each span, so whatever an
        item's length covers lies whole in one of them.
        """
        span, n_terms = self.span, len(self.terms)
        sizes = np.array([max(1, -(-len(k) // span) - 1) for k in known])
        offset = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(known)), sizes)
        pairs = []
        for k, p, o in zip(known, sizes.tolist(), offset.tolist()):
            at = np.flatnonzero(k < n_terms)
            q = at // span
            pairs.append((np.minimum(q, p - 1) + o) * n_terms + k[at])
            late = q > 0
            pairs.append((q[late] - 1 + o) * n_terms + k[at[late]])
        pair = np.unique(np.concatenate(pairs))
        passage, term = pair // n_terms, pair % n_terms
        count = self.first[term + 1] - self.first[term]
        places = np.repeat(self.first[term] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        bound = np.bincount(np.repeat(passage, count) * self.ranges + self.at[places], self.most[places],
                            minlength=len(owner) * self.ranges)
        for x in np.flatnonzero(bound >= floor).tolist():
            p, r = divmod(x, self.ranges)
            lo, hi = np.searchsorted(passage, [p, p + 1])
            t = int(owner[p])
            yield t, p - int(offset[t]), r, term[lo:hi].tolist()

    def _matches(self, words: list[list[str]], threshold: float, least: float) -> list[list[tuple]]:
        get, unknown, floor = self.terms.get, len(self.terms), threshold - 1e-9
        known = [np.array([get(w, unknown) for w in ws], np.int64) for ws in words]
        best: list[dict[int, tuple]] = [{} for _ in words]
        for t, p, r, terms in self._candidates(known, floor):
            hits = self.search(terms, r, floor)
            if not hits:
                continue
            a = p * self.span
            passage = words[t][a:a + 2 * self.span]
            held = shingles(passage)
            for k, score in hits:
                whole = self.parts[k][0] + self.parts[k][1]
                short = len(whole) < SHINGLE  # stands as one run of words or not at all
                q, ans = (overlap(whole if short else part, passage, held) for part in self.parts[k])
                if q >= least and ans >= least and score > best[t].get(k, (0, 0.0))[1]:
                    best[t][k] = (self.ids[k], min(score, 1.0), q, ans, a, len(passage))
        return [list(b.values()) for b in best]

    def matches(self, texts: Iterable[str | None], threshold: float, least: float) -> list[list[tuple]]:
        """Per text: (item_id, score, question overlap, answer overlap, first word, words) per item it holds."""
        out: list[list[tuple]] = []
        group: list[list[str]] = []
        room = max(1, min(BATCH_WORDS, BATCH_BOUNDS * self.span // max(1, self.ranges)))
        held = 0
        for text in texts:
            if self.terms:
                group.append(words_of(text))
                held += len(group[-1])
            else:
                out.append([])
            if held >= room:
                out += self._matches(group, threshold, least)
                group, held = [], 0
        return out + (self._matches(group, threshold, least) if group else [])


_WORDS = "array<string>"


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text",
                block_bytes: int = BLOCK_BYTES):
    """Indexes over all items, each of at most about ``block_bytes`` of text."""
    @F.pandas_udf(_WORDS)
    def distinct_words(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(set(words_of(t))) for t in texts], dtype=object)

    @F.pandas_udf("long")
    def word_count(texts: pd.Series) -> pd.Series:
        return pd.Series([len(words_of(t)) for t in texts], dtype="int64")

    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    rows = written(rows.filter("text is not null").withColumns(
        {"words": distinct_words("text"), "n": word_count("text")}).filter("n > 0"), "test-items")
    size = rows.agg(F.sum(F.octet_length("text")).alias("b"), F.count(F.lit(1)).alias("n"),
                    F.avg("n").alias("mean")).first()
    blocks = -(-int(size["b"] or 0) // block_bytes)
    counts = rows.select(F.explode("words").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    for k in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else rows
        own = part.select(F.explode("words").alias("w")).distinct()
        df = {r["w"]: r["df"] for r in counts.join(own, "w").collect()}  # the block's words
        held = [(r["item_id"], r["text"]) for r in part.select("item_id", "text").collect()]
        held.sort(key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        yield ItemIndex(held, df, size["n"], size["mean"])


_FOUND = ("doc_id long, item_id long, score double, question_overlap double, answer_overlap double, "
          "first_word long, n_words long")


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                 least: float = OVERLAP, block_bytes: int = BLOCK_BYTES, doc_id: str = "doc_id",
                 text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """A row for each document and test item that it holds."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def scan(index: ItemIndex):
        def run(batches):
            for pdf in batches:
                found = [(None if pd.isna(d) else int(d), *m)
                         for d, ms in zip(pdf["doc_id"], index.matches(pdf["text"], threshold, least))
                         for m in ms]
                if found:
                    out = pd.DataFrame(found, columns=[c.split()[0] for c in _FOUND.split(", ")])
                    yield out.astype({"doc_id": "Int64", "item_id": "Int64"})
        return rows.mapInPandas(run, _FOUND)

    parts = [scan(x) for x in item_blocks(items, item_id, item_text, block_bytes)]
    if not parts:
        return docs.sparkSession.createDataFrame([], _FOUND)
    return reduce(DataFrame.unionAll, parts)


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                      least: float = OVERLAP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold no test item, their columns as they were."""
    out = docs.select(packed(docs).alias("row"))
    for index in item_blocks(items, block_bytes=block_bytes):
        def clean(index=index):
            @F.pandas_udf("boolean")
            def none_found(texts: pd.Series) -> pd.Series:
                return pd.Series([not m for m in index.matches(texts, threshold, least)], dtype=bool)
            return none_found.asNondeterministic()
        out = out.select("row", clean()(F.col("row.text")).alias("clean")).filter("clean").select("row")
    return out.select("row.*")
