"""Quality classification by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled
text.  A text is compressed with each, chunk by chunk so that the dictionary
counts in every part of a long one.  The difference of the two sizes, over the
text's bytes, says which it is more like; ``PRIOR_BYTES`` of usual good text
are added to every text, as a few words say little.  An isotonic curve, with a
small part of a logistic one to order what it holds equal, makes that
difference a probability.

What is learned from is a bounded sample: of the labelled rows' texts, cut
into chunks, a hash sample expected to hold ``sample_chunks`` chunks of each
class, of ``CHUNK_CHARS`` characters at most.  Dictionaries come from three
quarters of the sampled documents, the curves from the whole texts of the
remaining quarter of up to ``2 * sample_docs`` of each class.

Defined cases: an empty or NULL text has the difference of usual good text; a
row with a NULL label, or an id without a row, teaches nothing; where a class
is missing the score is the share of label 1 among what was seen (0.5 if
nothing was); repeated rows get equal results.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_probability, written

CHUNK_CHARS = 2000
SAMPLE_CHUNKS = 1000
SAMPLE_DOCS = 4000
DICTIONARY_BYTES = 112 * 1024
LEVEL = 3
#: Bytes of usual good text that every text counts as having besides its own.
PRIOR_BYTES = 100
#: Share of the logistic curve in the score.
FINE = 0.02


@lru_cache(maxsize=4)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_AUTO)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data, write_checksum=False, write_content_size=False,
                                    write_dict_id=False)


def build_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or the text itself where there is too little to train on."""
    text = b"\n".join(samples)
    if len(samples) >= 8 and len(text) > 4 * size:
        try:
            return zstandard.train_dictionary(size, samples).as_bytes()
        except zstandard.ZstdError:
            pass
    return text[-size:].ljust(8, b"\n")


def size_difference(text: str | None, good: bytes, bad: bytes) -> tuple[int, int]:
    """(size with bad - size with good, UTF-8 bytes) of a whole text."""
    text = text or ""
    sizes, raw = [0, 0], 0
    for i in range(0, len(text), CHUNK_CHARS):
        chunk = text[i:i + CHUNK_CHARS].encode("utf-8")
        raw += len(chunk)
        for k, d in enumerate((good, bad)):
            sizes[k] += len(_compressor(d).compress(chunk))
    return sizes[1] - sizes[0], raw


def fit_curve(x: np.ndarray, y: np.ndarray, weights: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Weighted logistic regression of y on one x (scaled inside), lightly ridged: (slope, offset)."""
    scale = float(np.std(x)) or 1.0
    z = np.c_[x / scale, np.ones(len(x))]
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (weights * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, z.T @ (weights * (y - p)) - 1e-3 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[list[float], list[float]]:
    """Weighted pool-adjacent-violators: (x, rising value) points of the curve."""
    pools: list[list[float]] = []  # weighted sum, weight, first x, last x
    for a in np.argsort(x, kind="stable").tolist():
        pools.append([y[a] * w[a], w[a], x[a], x[a]])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            s, n, _, end = pools.pop()
            pools[-1][0] += s
            pools[-1][1] += n
            pools[-1][3] = end
    xs = [float(v) for p in pools for v in (p[2], p[3])]
    return xs, [float(p[0] / p[1]) for p in pools for _ in range(2)]


class CompressionModel:
    """Both dictionaries, the usual difference of good text and the curves.

    Without dictionaries, a constant score.
    """

    def __init__(self, good: bytes = b"", bad: bytes = b"", usual: float = 0.0, slope: float = 0.0,
                 offset: float = 0.0, curve: tuple[list[float], list[float]] | None = None):
        self.good, self.bad, self.usual = good, bad, usual
        self.slope, self.offset, self.curve = slope, offset, curve

    def normalised(self, difference, raw):
        return (difference + PRIOR_BYTES * self.usual) / (raw + PRIOR_BYTES)

    def scores(self, x: np.ndarray) -> np.ndarray:
        smooth = 1 / (1 + np.exp(-np.clip(self.slope * x + self.offset, -30, 30)))
        if self.curve is None:
            return smooth
        return (1 - FINE) * np.interp(x, *self.curve) + FINE * smooth

    def score_texts(self, texts) -> pd.DataFrame:
        pairs = np.array([size_difference(t, self.good, self.bad) for t in texts], float).reshape(-1, 2)
        x = self.normalised(pairs[:, 0], pairs[:, 1])
        return pd.DataFrame({"difference": x, "score": self.scores(x)})


def _labelled(docs, labels, doc_id, text, label_id, label):
    marks = (labels.select(F.col(label_id).alias("doc_id"), F.col(label).cast("int").alias("y"))
             .filter("y in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("y").alias("y")))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return marks, rows.filter("text is not null")


def learn(docs: DataFrame, labels: DataFrame, sample_chunks: int = SAMPLE_CHUNKS,
          sample_docs: int = SAMPLE_DOCS, dictionary_bytes: int = DICTIONARY_BYTES, seed: int = 2,
          doc_id: str = "doc_id", text: str = "text", label_id: str = "doc_id",
          label: str = "quality") -> CompressionModel:
    """A model of the rows of ``docs`` that ``labels`` marks 0 or 1."""
    marks, rows = _labelled(docs, labels, doc_id, text, label_id, label)
    counts = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    seen = sum(counts.values())
    if len(counts) < 2:
        share = min(max(counts.get(1, 0) / seen, 1e-6), 1 - 1e-6) if seen else 0.5
        return CompressionModel(offset=float(np.log(share / (1 - share))))
    # of each class, so many documents are looked at that the chunks' sample can be filled
    rate = {y: min(1.0, 2 * sample_docs / n) for y, n in counts.items()}
    wanted = F.when(F.col("y") == 1, rate[1]).otherwise(rate[0])
    # as many ids as the sample has documents: the bound of the broadcast
    chosen = marks.filter(keep_probability(F.col("doc_id"), seed) < wanted)
    some = written(rows.join(F.broadcast(chosen), "doc_id"), "quality-sample")
    to_build = keep_probability(F.col("doc_id"), seed + 1) < 0.75
    starts = F.sequence(F.lit(1), F.greatest(F.length("text"), F.lit(1)), F.lit(CHUNK_CHARS))
    chunks = some.filter(to_build).select("doc_id", "y", "text", F.posexplode(starts).alias("k", "at"))
    sizes = {r["y"]: r["n"] for r in chunks.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.when(F.col("y") == 1, min(1.0, sample_chunks / max(1, sizes.get(1, 0)))).otherwise(
        min(1.0, sample_chunks / max(1, sizes.get(0, 0))))
    picked = (chunks.filter(F.pmod(F.xxhash64("doc_id", "k"), F.lit(1 << 30)) < share * (1 << 30))
              .select("y", "doc_id", "k", F.col("text").substr(F.col("at"), F.lit(CHUNK_CHARS)).alias("c"))
              .orderBy("doc_id", "k").collect())  # about sample_chunks of each class
    good, bad = (build_dictionary([r["c"].encode("utf-8") for r in picked if r["y"] == y],
                                  dictionary_bytes) for y in (1, 0))
    @F.pandas_udf("difference long, raw long")
    def sizes_of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([size_difference(t, good, bad) for t in texts], columns=["difference", "raw"])

    fitted = (some.filter(~to_build).select("y", sizes_of.asNondeterministic()("text").alias("s"))
              .select("y", "s.*").toPandas())  # three numbers a document of a bounded sample
    y = fitted["y"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return CompressionModel(good, bad, 0.0, 100.0, 0.0)
    plain = fitted["difference"].to_numpy(float) / np.maximum(1, fitted["raw"].to_numpy(float))
    model = CompressionModel(good, bad, float(np.median(plain[y == 1])))
    x = model.normalised(fitted["difference"].to_numpy(float), fitted["raw"].to_numpy(float))
    # the classes were sampled at their own rates, weights undo that
    w = np.where(y == 1, 1 / rate[1], 1 / rate[0])
    model.slope, model.offset = fit_curve(x, y, w)
    model.curve = isotonic(x, y, w)
    return model


def score(docs: DataFrame, model: CompressionModel, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """(doc_id, difference, score, predicted) per row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    @F.pandas_udf("difference double, score double")
    def scored(texts: pd.Series) -> pd.DataFrame:
        if not model.good:
            return pd.DataFrame({"difference": 0.0, "score": model.scores(np.zeros(len(texts)))})
        return model.score_texts(texts)

    rows = rows.select("doc_id", scored.asNondeterministic()("text").alias("s")).select("doc_id", "s.*")
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
