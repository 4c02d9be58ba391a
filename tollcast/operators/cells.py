"""Rows that no tree can tell apart, as one row with a weight.

A tree sees a row by its features' bins (at most ``maxBins`` each) only, so all
rows of one combination of bins, a cell, go the same way in every tree.  A
split's gain by variance needs the cells' counts and label sums: what the
labels vary within a cell adds the same to both sides.  One pass over the rows
gives the cells, and a fit on them, weighted by their rows, is the fit on all
rows, whatever their number.  Validation needs no rows either: a cell's squared
error is its own deviation plus that of its mean.

The bins are equally filled ones by the library's rule, from the values of all
rows: exactly for few rows, else from quantiles (the library itself would
take some ten thousand sampled rows).

It pays as long as there are few cells (a few features); ``binning`` gives None
for more than ``MAX_CELLS``, and the caller fits on rows.

A forest draws every row again for each tree.  How often the ``m`` rows of a
cell are drawn in all is Poisson(``m`` times the rate), and which ones is even,
which is the same as a Poisson draw for each row.  So ``drawn`` gives for each
tree and cell the rows drawn and their labels' sum, drawn row by row; a tree
then grows from its cells alone, at most ``MAX_CELLS`` of them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from . import models

#: Cells that a fit may have.
MAX_CELLS = 1 << 16
#: Up to this many rows, every row's values make the bins (and a forest is the library's own).
FEW_ROWS = 10_000
#: Quantiles for a bin, for more rows.
POINTS = 100
#: Parts of a cell's rows that are drawn in tasks of their own.
SALTS = 4


def thresholds(counts: dict, max_bins: int) -> list[float]:
    """The library's equally filled bins of counted values: midpoints between neighbours."""
    values = sorted(counts)
    middle = [(a + b) / 2.0 for a, b in zip(values, values[1:])]
    if len(middle) < max_bins:
        return middle
    stride = sum(counts.values()) / max_bins
    out, target, now = [], stride, counts[values[0]]
    for value, mid in zip(values[1:], middle):
        before, now = now, now + counts[value]
        if abs(before - target) < abs(now - target):
            out.append(mid)
            target += stride
    return out


@dataclass
class Binning:
    """Thresholds of each feature of a vector column."""

    cuts: list
    features: str = "features"

    @property
    def sizes(self) -> tuple:
        # one more for NaN
        return tuple(len(c) + 2 if c else 1 for c in self.cuts)

    def bins(self, df: DataFrame) -> DataFrame:
        """``df`` with each feature's bin as ``_bin0``, ``_bin1`` and so on."""
        values = vector_to_array(F.col(self.features))
        out = df.withColumns({f"_x{i}" if c else f"_bin{i}": values[i] if c else F.lit(0.0)
                              for i, c in enumerate(self.cuts)})
        cut = [i for i, c in enumerate(self.cuts) if c]
        if cut:
            out = Bucketizer(splitsArray=[[-math.inf, *self.cuts[i], math.inf] for i in cut], handleInvalid="keep",
                             inputCols=[f"_x{i}" for i in cut], outputCols=[f"_bin{i}" for i in cut]).transform(out)
        return out.drop(*[f"_x{i}" for i in cut])

    def vectors(self, df: DataFrame, out: str) -> DataFrame:
        """``df`` with the bins as a vector; counted from one, so that a bin is never an unstored zero."""
        names = [f"_bin{i}" for i in range(len(self.cuts))]
        df = self.bins(df).withColumns({n: F.col(n) + 1 for n in names})
        return VectorAssembler(inputCols=names, outputCol=out).transform(df).drop(*names)

    def numbered(self, df: DataFrame) -> DataFrame:
        """``df`` with the cell's number as ``cell``."""
        names, number = [f"_bin{i}" for i in range(len(self.cuts))], F.lit(0)
        for name, size in zip(names, self.sizes):
            number = number * F.lit(size) + F.col(name).cast("long")
        return self.bins(df).withColumn("cell", number.cast("long")).drop(*names)

    def cells(self, df: DataFrame, label: str) -> DataFrame:
        """(cell, bins as columns, rows, label's mean, squared deviations from it): one pass over the rows."""
        y = F.col(label).cast("double")
        names = [f"_bin{i}" for i in range(len(self.cuts))]
        rows = self.numbered(df).select("cell", y.alias("y"))
        out = rows.groupBy("cell").agg(F.count("y").cast("double").alias("n"), F.avg("y").alias("mean"),
                                       (F.var_pop("y") * F.count("y")).alias("ss")).filter("n > 0")
        at, step = {}, 1
        for name, size in reversed(list(zip(names, self.sizes))):
            at[name] = (F.floor(F.col("cell") / F.lit(step)) % F.lit(size)).cast("double") + 1
            step *= size
        return out.select(*out.columns, *[at[name].alias(name) for name in names])


def binning(df: DataFrame, max_bins: int, features: str = "features", few: int = FEW_ROWS) -> Binning | None:
    """The bins of a frame's features; None if they make more than ``MAX_CELLS`` cells (or there are no rows)."""
    first = df.select(features).first()
    if first is None:
        return None
    k = len(first[0])
    if 2 ** k > MAX_CELLS:
        return None
    values = vector_to_array(F.col(features))
    x = [F.when(~F.isnan(values[i]), values[i]) for i in range(k)]
    if len(df.select(F.lit(1)).head(few + 1)) <= few:
        rows = df.select(*[c.alias(f"x{i}") for i, c in enumerate(x)]).collect()
        found = [[r[i] for r in rows if r[i] is not None] for i in range(k)]
    else:
        n = POINTS * max_bins
        places = [(i + 0.5) / n for i in range(n)]
        row = df.agg(*[F.percentile_approx(c, places, 10 * n).alias(f"x{i}") for i, c in enumerate(x)]).first()
        found = [row[i] or [] for i in range(k)]
    out = Binning([thresholds(Counter(v), max_bins) if v else [] for v in found], features)
    return out if math.prod(out.sizes) <= MAX_CELLS else None


# ------------------------------------------------------------------- fits

def fit_weighted(estimator, cells: DataFrame, k: int, label: str, features: str):
    """The library's fit on cells, weighted by their rows; its features are the bins."""
    names = [f"_bin{i}" for i in range(k)]
    frame = VectorAssembler(inputCols=names, outputCol=features).transform(
        cells.withColumnRenamed("mean", label)).select("cell", features, label, "n")
    # few and small rows: a fit has hundreds of jobs, each with as many tasks as partitions
    frame = frame.coalesce(1).sortWithinPartitions("cell").persist()
    try:
        return estimator.copy({estimator.weightCol: "n"}).fit(frame)
    finally:
        frame.unpersist()


def by_weights(estimator) -> bool:
    """Whether a fit on weighted rows is that on all rows: nothing is drawn, no node counts its rows."""
    return (estimator.getMinInstancesPerNode() == 1 and estimator.getMinInfoGain() == 0.0
            and estimator.getSubsamplingRate() == 1.0 and not estimator.isSet("validationIndicatorCol"))


def boosted(estimator, df: DataFrame, label: str = "label", features: str = "features", frame=None) -> DataFrame:
    """``df`` with ``prediction``: boosted trees fitted on its cells where these are few, else on
    ``frame`` of its rows (default: as they are)."""
    b = binning(df, estimator.getMaxBins(), features) if by_weights(estimator) else None
    if b is None:
        return models.fit(estimator, frame(df) if frame else df).transform(df)
    e = estimator.copy({estimator.maxBins: max(estimator.getMaxBins(), *b.sizes), estimator.featuresCol: "_bins"})
    model = fit_weighted(e, b.cells(df, label), len(b.cuts), label, "_bins")
    return model.transform(b.vectors(df, "_bins")).drop("_bins")


# ----------------------------------------------------------------- forests

def drawn(rows: DataFrame, binning_: Binning, label: str, trees: int, rate: float, seed: int) -> DataFrame:
    """(tree, cell, n, s): rows drawn for each tree and their labels' sum, in parts of a cell's rows."""
    spark = rows.sparkSession
    y = F.col(label).cast("double")
    dealt = binning_.numbered(rows).select("cell", y.alias("y")).filter("y IS NOT NULL")
    dealt = dealt.repartition(shuffle_partitions(spark), F.col("cell"), F.pmod(F.xxhash64("y"), F.lit(SALTS)))

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        sums: dict[int, np.ndarray] = {}
        for pdf in batches:
            cell, y = pdf["cell"].to_numpy(), pdf["y"].to_numpy()
            starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else []
            for a, b in zip(starts, np.r_[starts[1:], len(cell)].astype(int)):
                times = rng.poisson(rate * (b - a), trees)
                picked = np.append(y[rng.integers(0, b - a, times.sum(), dtype=np.int32) + a], 0.0)
                begin = np.cumsum(times) - times
                both = sums.setdefault(int(cell[a]), np.zeros((2, trees)))
                both[0] += times
                both[1] += np.where(times > 0, np.add.reduceat(picked, begin), 0.0)
        for c, (n, s) in sums.items():
            there = np.flatnonzero(n)
            yield pd.DataFrame({"tree": there.astype("int32"), "cell": c, "n": n[there], "s": s[there]})

    # in order, so that a task that runs again draws the same
    return dealt.sortWithinPartitions("cell", "y").mapInPandas(draw, "tree int, cell long, n double, s double")


def grown(sizes, depths, per_node: int, seed: int):
    """Of one tree's drawn cells: every cell's prediction at each depth of ``depths`` (ascending)."""
    def best_splits(node, n, s, at, sizes, chosen):
        """For each node the feature and the last bin to the left of its best split (feature -1: none)."""
        nodes = len(chosen)
        total, both = np.bincount(node, n, nodes), np.bincount(node, s, nodes)
        whole = both ** 2 / total
        best, feature, last = 1e-12 * whole, np.full(nodes, -1), np.zeros(nodes, int)
        for f, size in enumerate(sizes):
            if size == 1:
                continue
            key = node * size + at[f]
            ln, ls = (np.bincount(key, v, nodes * size).reshape(nodes, size).cumsum(1)[:, :-1] for v in (n, s))
            rn, rs = total[:, None] - ln, both[:, None] - ls
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where((ln > 0) & (rn > 0), ls ** 2 / ln + rs ** 2 / rn - whole[:, None], -1.0)
            j = gain.argmax(1)
            g = gain[np.arange(nodes), j]
            better = chosen[:, f] & (g > best)
            best[better], feature[better], last[better] = g[better], f, j[better]
        return feature, last

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        tree, cells = int(pdf["tree"].iloc[0]), math.prod(sizes)
        rng = np.random.default_rng([seed, tree])
        n, s = (np.bincount(pdf["cell"], pdf[c], cells) for c in ("n", "s"))
        at = np.array(np.unravel_index(np.arange(cells), sizes))
        live, node = np.arange(cells), np.zeros(cells, int)  # cells of nodes that may split, and their nodes
        value, cuts = np.full(cells, s.sum() / n.sum()), []
        for depth in range(depths[-1] + 1):
            if depth in depths:
                cuts.append(value.copy())
            if len(live) and depth < depths[-1]:
                nodes = node.max() + 1
                chosen = rng.random((nodes, len(sizes))).argsort(1).argsort(1) < per_node
                feature, last = best_splits(node, n[live], s[live], at[:, live], sizes, chosen)
                go = feature[node] >= 0
                live, node = live[go], node[go]
                right = at[feature[node], live] > last[node]
                _, node = np.unique(node * 2 + right, return_inverse=True)
                value[live] = (np.bincount(node, s[live]) / np.bincount(node, n[live]))[node] if len(live) else 0.0
        return pd.DataFrame({"tree": tree, "cell": np.arange(cells), "cuts": list(np.stack(cuts, 1))})
    return run


def per_node(estimator, k: int) -> int | None:
    """Features tried at a node of a forest for regression; None for a rule not known here."""
    rule = estimator.getFeatureSubsetStrategy()
    return {"auto": math.ceil(k / 3), "onethird": math.ceil(k / 3), "all": k}.get(rule)


def by_draws(estimator) -> bool:
    """Whether trees grown from drawn cells are those of the estimator."""
    return (estimator.getMinInstancesPerNode() == 1 and estimator.getMinInfoGain() == 0.0
            and estimator.getBootstrap() and estimator.getMinWeightFractionPerNode() == 0.0
            and estimator.getFeatureSubsetStrategy() in ("auto", "onethird", "all"))


def forest(estimator, rows: DataFrame, binning_: Binning, trees: int, depths, label: str) -> DataFrame:
    """(tree, cell, cuts): every tree's prediction of every cell at each depth."""
    seed = estimator.getSeed() & 0xFFFFFFFF
    draws = drawn(rows, binning_, label, trees, estimator.getSubsamplingRate(), seed)
    grow = grown(binning_.sizes, list(depths), per_node(estimator, len(binning_.cuts)) if trees > 1
                 else len(binning_.cuts), seed)
    return draws.groupBy("tree").applyInPandas(grow, "tree int, cell long, cuts array<double>")
