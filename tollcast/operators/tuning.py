"""Parameter grids whose points share fits.

A grid point that is a part of a larger fit needs no fit of its own:

* linear points need the moments of the two parts only, which one pass over
  the rows gives; every point is then coordinate descent on that matrix;
* boosted trees of k iterations are the first k trees of a longer fit, and one
  pass over the validation rows gives the error after every tree;
* of a forest, the first k trees are a forest of k trees, and a tree cut at
  depth d is a tree grown to depth d (each node keeps the mean of its rows), so
  one forest of the most and deepest trees serves all points that share the
  other parameters.  (A forest fitted for such a point alone would draw other
  rows and columns; it has the same distribution.)

Where all rows fall into few cells, trees are fitted on these (``operators.cells``).

The number of fits is the product of the other parameters' values: none for a
linear grid, one per depth for boosted trees, one per ``maxBins`` for forests.
``refit`` fits the best point on all rows, as a train/validation split does.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, shuffle_partitions
from ..sources.tables import written
from . import cells, models
from .profile import array_moments, pair_moments

#: Sweeps of coordinate descent in one iteration of the declared ``maxIter``.
SWEEPS = 10


def holdout(df: DataFrame, number: Column, train_tenths: int = 8) -> tuple[DataFrame, DataFrame]:
    """(train, validation) by a whole number made of the rows' keys; rows without one validate."""
    train = F.coalesce(F.pmod(number, F.lit(10)) < train_tenths, F.lit(False))
    return df.filter(train), df.filter(~train)


def points(grid: dict) -> list[dict]:
    """Every combination of the named values."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def table(spark: SparkSession, grid: dict, errors: list[tuple[dict, float]]) -> DataFrame:
    """One row per grid point: its values as text and the validation error."""
    rows = [(*[str(p[k]) for k in grid], float(e)) for p, e in errors]
    return spark.createDataFrame(rows, ", ".join([f"{k} string" for k in grid] + ["rmse double"]))


def refit(estimator, grid: dict, errors: DataFrame, frame: DataFrame):
    """The estimator with the values of the least error, fitted on all of ``frame``."""
    best = errors.orderBy("rmse", *grid).first()
    chosen = next(p for p in points(grid) if all(str(p[k]) == best[k] for k in grid))
    return models.fit(estimator.copy({estimator.getParam(k): v for k, v in chosen.items()}), frame)


# ------------------------------------------------------------------ linear

def moments(df: DataFrame, cols, vector: Column | None = None) -> tuple[float, np.ndarray, np.ndarray]:
    """(rows, means, centred products) of columns without NULLs; one pass, columns² numbers
    to the driver.  ``vector``: an array of doubles that holds the columns."""
    k = len(cols)
    n, mean, products = 0.0, np.zeros(k), np.zeros((k, k))
    for r in (pair_moments(df, cols) if vector is None else array_moments(df, vector)).collect():
        products[r["i"], r["j"]] = r["xy"]
        if r["i"] == r["j"]:
            n, mean[r["i"]] = r["n"], r["sx"] / r["n"]
    return n, mean, products


def descend(gram: np.ndarray, target: np.ndarray, l1: float, l2: float, sweeps: int) -> np.ndarray:
    """Coordinate descent for 1/2 b'Gb - t'b + l1 |b| + l2/2 |b|²."""
    b = np.zeros(len(target))
    for _ in range(sweeps):
        for j in range(len(b)):
            if gram[j, j] + l2 > 0:
                rest = target[j] - gram[j] @ b + gram[j, j] * b[j]
                b[j] = np.sign(rest) * max(abs(rest) - l1, 0.0) / (gram[j, j] + l2)
    return b


def linear_point(train, reg: float, alpha: float, intercept: bool, max_iter: int) -> tuple[np.ndarray, float]:
    """(coefficients, intercept) of an elastic net from the moments of features and label.

    The objective is that of the library's estimator: the squared error over
    2n, with columns and label scaled by their sample deviation.  A column that
    does not vary gets no weight.  Without an L1 part it is solved at once,
    otherwise by ``max_iter`` times ``SWEEPS`` sweeps.
    """
    n, mean, c = train
    dev = np.sqrt(np.diag(c) / max(n - 1, 1))
    sums = c if intercept else c + n * np.outer(mean, mean)
    k = len(mean) - 1
    use = dev[:k] > 1e-12 * np.maximum(np.abs(mean[:k]), 1e-300)
    coef = np.zeros(k)
    if use.any() and dev[k] > 0:
        i = np.flatnonzero(use)
        d, y = dev[i], dev[k]
        gram = sums[np.ix_(i, i)] / np.outer(d, d) / n
        target = sums[i, k] / d / y / n
        l1, l2 = alpha * reg / y, (1 - alpha) * reg / y
        if l1:
            b = descend(gram, target, l1, l2, max_iter * SWEEPS)
        else:
            b = np.linalg.solve(gram + l2 * np.eye(len(i)), target)
        coef[i] = b * y / d
    return coef, float(mean[k] - coef @ mean[:k]) if intercept else 0.0


def linear_error(part, coef: np.ndarray, intercept: float) -> float:
    """Root mean squared error of a linear model on rows known by their moments."""
    n, mean, c = part
    w = np.append(-coef, 1.0)
    return float(np.sqrt(max(w @ c @ w, 0.0) / n + (w @ mean - intercept) ** 2))


def linear_grid(train: DataFrame, valid: DataFrame, features, label: str, grid: dict,
                vector: str | None = None) -> list[tuple[dict, float]]:
    """(point, error) of every point of a linear regression's grid, from one pass over each part.

    ``vector``: the column of an array of doubles that holds all ``features``.
    """
    cols = [*features, label]
    values = F.concat(vector, F.array(F.col(label).cast("double"))) if vector else None
    a, b = moments(train, cols, values), moments(valid, cols, values)
    return [(p, linear_error(b, *linear_point(a, p["regParam"], p["elasticNetParam"], p["fitIntercept"],
                                              p["maxIter"]))) for p in points(grid)]


# ------------------------------------------------------------------- trees

def _fits(grid: dict, shared) -> list[dict]:
    """The values of the parameters that need fits of their own."""
    return points({k: v for k, v in grid.items() if k not in shared})


def _with(estimator, values: dict):
    return estimator.copy({estimator.getParam(k): v for k, v in values.items()})


class _Parts:
    """The cells of both parts for each ``maxBins``: a pass over the rows of each, made once."""

    def __init__(self, train: DataFrame, valid: DataFrame, label: str, features: str):
        self.train, self.valid, self.label, self.features, self.known = train, valid, label, features, {}

    def binning(self, max_bins: int):
        if max_bins not in self.known:
            self.known[max_bins] = [cells.binning(self.train, max_bins, self.features)]
        return self.known[max_bins][0]

    def cells(self, max_bins: int) -> tuple[DataFrame, DataFrame]:
        binning = self.binning(max_bins)
        if len(self.known[max_bins]) == 1:
            self.known[max_bins] += [written(binning.cells(part, self.label), "cells") for part in (self.train, self.valid)]
        return tuple(self.known[max_bins][1:])


def _squared(prediction: Column) -> Column:
    """Of cells and their predictions: the root mean squared error of their rows."""
    return F.sqrt(F.sum(F.col("ss") + F.col("n") * F.pow(F.col("mean") - prediction, F.lit(2))) / F.sum("n"))


def _boosted_errors(model, valid: DataFrame, iterations, features: str) -> list[float]:
    """The error on weighted cells after each of ``iterations``, by the predictions of the cells' leaves."""
    spark, weights = valid.sparkSession, [float(w) for w in model.treeWeights]
    own = _nodes(model, spark).groupBy("tree").applyInPandas(
        _cut_tree([model.getMaxDepth()]), "tree int, leaf long, cuts array<double>")
    names = [c for c in valid.columns if c.startswith("_bin")]
    rows = VectorAssembler(inputCols=names, outputCol=features).transform(valid)
    leaves = model.setLeafCol("leaves").transform(rows).select(
        "cell", F.posexplode(vector_to_array(F.col("leaves"))).alias("tree", "leaf"))
    found = leaves.withColumn("leaf", F.col("leaf").cast("long")).join(own, ["tree", "leaf"])
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("tree") + 1)
    sums = found.groupBy("cell").agg(*[F.sum(F.when(F.col("tree") < k, weight * F.col("cuts")[0])).alias(f"p{k}")
                                       for k in iterations])
    return list(valid.join(sums, "cell").agg(*[_squared(F.col(f"p{k}")) for k in iterations]).first())


def boosted_grid(estimator, train: DataFrame, valid: DataFrame, grid: dict, label: str = "label",
                 features: str = "features", frame=None) -> list[tuple[dict, float]]:
    """(point, error) of boosted trees: one fit of the most iterations for the other values.

    Fitted on the rows' cells where these are few (``operators.cells``), else on
    ``frame`` of the rows (default: as they are).
    """
    most, out, parts = max(grid["maxIter"]), [], _Parts(train, valid, label, features)
    for own in _fits(grid, ("maxIter",)):
        e = _with(estimator, {**own, "maxIter": most})
        binning = parts.binning(e.getMaxBins()) if cells.by_weights(e) else None
        if binning:
            fitted, seen = parts.cells(e.getMaxBins())
            # a bin holds a whole number: as many splits as the rows' bins have
            e = e.copy({e.maxBins: max(e.getMaxBins(), *binning.sizes)})
            model = cells.fit_weighted(e, fitted, len(binning.cuts), label, features)
            after = _boosted_errors(model, seen, grid["maxIter"], features)
        else:
            model = models.fit(e, frame(train) if frame else train)
            each = model.evaluateEachIteration(valid, "squared")
            after = [np.sqrt(each[k - 1]) for k in grid["maxIter"]]
        out += [({**own, "maxIter": k}, float(x)) for k, x in zip(grid["maxIter"], after)]
    return out


def _nodes(model, spark: SparkSession) -> DataFrame:
    """(tree, id, prediction, left, right) of a fitted forest, from its stored form."""
    path = scratch_path(spark, "forest")
    model.write().save(path)
    n = spark.read.parquet(f"{path}/data")
    return n.select(F.col("treeID").alias("tree"), F.col("nodeData.id").alias("id"),
                    F.col("nodeData.prediction").alias("prediction"), F.col("nodeData.leftChild").alias("left"),
                    F.col("nodeData.rightChild").alias("right"))


def _cut_tree(depths):
    """Of one tree, for each leaf (in order) the prediction at every depth of ``depths``."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        left, right = pdf["left"].to_numpy(), pdf["right"].to_numpy()
        value = pdf["prediction"].to_numpy()
        at = np.tile(value[:, None], (1, len(depths)))  # a node's prediction at each cut
        level, depth = np.array([0]), 0
        while len(level):
            inner = level[left[level] >= 0]
            for side in (left, right):
                child = side[inner]
                for c, d in enumerate(depths):
                    if depth >= d:
                        at[child, c] = at[inner, c]
            level, depth = np.concatenate((left[inner], right[inner])), depth + 1
        leaf = np.flatnonzero(left < 0)
        return pd.DataFrame({"tree": int(pdf["tree"].iloc[0]), "leaf": np.arange(len(leaf)),
                             "cuts": list(at[leaf])})
    return run


def _forest_cells(estimator, parts: _Parts, binning, trees, depths) -> list[tuple[int, int, float]]:
    """(trees, depth, error) of a forest grown from the draws of cells."""
    _, seen = parts.cells(estimator.getMaxBins())
    own = cells.forest(estimator, parts.train, binning, trees[-1], depths, parts.label)
    points_ = [(t, d) for t in trees for d in depths]
    sums = own.join(seen.select("cell"), "cell").groupBy("cell").agg(*[
        (F.sum(F.when(F.col("tree") < t, F.col("cuts")[depths.index(d)])) / t).alias(f"p{i}")
        for i, (t, d) in enumerate(points_)])
    error = seen.join(sums, "cell").agg(*[_squared(F.col(f"p{i}")) for i in range(len(points_))]).first()
    return [(t, d, e) for (t, d), e in zip(points_, error)]


def _forest_rows(estimator, train: DataFrame, rows: DataFrame, trees, depths) -> list[tuple[int, int, float]]:
    """(trees, depth, error) of the library's forest, fitted on rows."""
    spark = train.sparkSession
    # node ids are kept beside the rows, so a level costs no walk from the root
    model = models.fit(_with(estimator, {"cacheNodeIds": True}), train)
    cuts = written(_nodes(model, spark).groupBy("tree").applyInPandas(
        _cut_tree(depths), "tree int, leaf long, cuts array<double>"), "forest-cuts")
    leaves = model.setLeafCol("leaves").transform(rows).select(
        "row", F.posexplode(vector_to_array(F.col("leaves"))).alias("tree", "leaf"))
    found = leaves.withColumn("leaf", F.col("leaf").cast("long")).join(cuts, ["tree", "leaf"])
    points_ = [(t, d) for t in trees for d in depths]
    sums = found.groupBy("row").agg(*[
        F.sum(F.when(F.col("tree") < t, F.col("cuts")[depths.index(d)])).alias(f"s{i}")
        for i, (t, d) in enumerate(points_)])
    error = sums.join(rows.select("row", "label"), "row").agg(*[
        F.sqrt(F.avg(F.pow(F.col("label") - F.col(f"s{i}") / t, F.lit(2)))).alias(f"e{i}")
        for i, (t, _) in enumerate(points_)]).first()
    return [(t, d, e) for (t, d), e in zip(points_, error)]


def forest_grid(estimator, train: DataFrame, valid: DataFrame, grid: dict, label: str = "label",
                features: str = "features", frame=None, few: int = cells.FEW_ROWS) -> list[tuple[dict, float]]:
    """(point, error) of forests: one fit of the most and deepest trees for the other values.

    More than ``few`` rows of few cells are drawn and grown by cells
    (``operators.cells``); else the library fits on ``frame`` of the rows.
    """
    spark, out, rows = train.sparkSession, [], None
    trees, depths = sorted(grid["numTrees"]), sorted(grid["maxDepth"])
    many = len(train.select(F.lit(1)).head(few + 1)) > few
    parts = _Parts(train, valid, label, features)
    for own in _fits(grid, ("numTrees", "maxDepth")):
        e = _with(estimator, {**own, "numTrees": trees[-1], "maxDepth": depths[-1]})
        binning = parts.binning(e.getMaxBins()) if many and cells.by_draws(e) else None
        if binning:
            errors = _forest_cells(e, parts, binning, trees, depths)
        else:
            if rows is None:
                rows = written(valid.select(features, F.col(label).alias("label"),
                                            F.monotonically_increasing_id().alias("row"))
                               .repartition(shuffle_partitions(spark), "row"), "validation")
            errors = _forest_rows(e, frame(train) if frame else train, rows, trees, depths)
        out += [({**own, "numTrees": t, "maxDepth": d}, x) for t, d, x in errors]
    return out
