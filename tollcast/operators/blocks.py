"""Trees on blocks of binned rows (M6, M7): boosted trees and forests of any number of rows.

A tree sees a row by its features' bins only.  The features of a row are lags of
its own, those of its window and those of its key, so a row is stored as the
bins of its lags and two numbers, that of its window and that of its key's
combination of bins: some 30 bytes, whatever the number of features, and many
rows to a block.  A level of a tree is one pass over the blocks: counts and label
sums by (node, bin) for each lag, by (node, window) and by (node, combination);
those of a window's and a key's features are sums of these.  The driver gets the
splits only.

The bins are equally filled ones by the library's rule, of all values where these
are few, else of quantiles of each chunk of rows, weighted by its rows (the
library itself would take some ten thousand sampled rows).  Boosted trees are the
library's steps: the first tree fits the labels, each further one twice the
residuals, weighted by the step size.  A forest draws every row for every tree
from a Poisson distribution, seeded by tree and block, so a task that runs again
draws the same.

Functions that run in workers are made by functions, so that they are sent whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from . import cells

#: Rows that are summed up together, rows of a block, and rows that a pass works on at once.
CHUNK, BLOCK, UNIT = 1 << 18, 1 << 14, 1 << 17
#: Points that tell of a feature's values in a chunk.
POINTS = 2048
#: Bytes of a row group of blocks: a reader holds one.
GROUP_BYTES = 16 << 20
#: Boosted trees after which the rows' predictions are written anew.
HELD_TREES = 3

_BLOCK = "id long, early boolean, lags binary, window binary, combination binary, combinations binary, y binary, linear binary"


def known(boosted, forest) -> bool:
    """Whether the fits here are those of the estimators."""
    return (cells.by_weights(boosted) and boosted.getLossType() == "squared" and boosted.getMaxBins() < 256
            and boosted.getFeatureSubsetStrategy() == "all" and cells.by_draws(forest) and forest.getMaxBins() < 256
            and boosted.getMaxBins() == forest.getMaxBins() and forest.getMinInfoGain() == 0.0
            and boosted.getMinWeightFractionPerNode() == 0.0)


# ------------------------------------------------------------- in workers

def _tools() -> SimpleNamespace:
    def chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            while b.num_rows:
                part = b.slice(0, size - n)
                held, n, b = [*held, part], n + part.num_rows, b.slice(part.num_rows)
                if n == size:
                    yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    held, n = [], 0
        if n:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    def raw(b: pa.RecordBatch, n_lags: int) -> tuple:
        """Lags, window numbers, and each run of rows with the same features of their key: its number, its features."""
        lags = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(n_lags)])
        window = b.column(n_lags).to_numpy(zero_copy_only=False)
        if (window < 0).any():
            raise ValueError("a row's window is not in the table of windows")
        keyed = b.column(n_lags + 1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
        begins = np.r_[True, (keyed[1:] != keyed[:-1]).any(1)]
        return lags, window, begins.cumsum() - 1, keyed[begins]

    def points(values, weights, most: int) -> tuple:
        """Distinct values and their weights; of more than ``most``, as many of equal weight."""
        there = ~np.isnan(values)
        if weights is None:
            u, c = np.unique(values[there], return_counts=True)
        else:
            u, at = np.unique(values[there], return_inverse=True)
            c = np.bincount(at, weights[there], len(u))
        c = c.astype(float)
        if len(u) > most:
            upto = c.cumsum()
            places = (np.arange(most) + 0.5) * upto[-1] / most
            u, c = np.unique(u[np.minimum(upto.searchsorted(places), len(u) - 1)], return_counts=True)
            c = c * (upto[-1] / most)
        return u, c

    def binned(values, cuts):
        return np.searchsorted(cuts, values).astype(np.uint8)

    def units(batches: Iterator[pa.RecordBatch], size: int, n_lags: int, n_key: int):
        """Blocks put together to about ``size`` rows."""
        def joined(held):
            u = SimpleNamespace(blocks=[(r["id"], len(r["y"]) // 8) for r in held])
            u.n = sum(n for _, n in u.blocks)
            u.lags = np.concatenate([np.frombuffer(r["lags"], np.uint8).reshape(n_lags, -1) for r in held], 1)
            u.window = np.concatenate([np.frombuffer(r["window"], np.int32) for r in held])
            u.combinations = np.concatenate([np.frombuffer(r["combinations"], np.uint8).reshape(-1, n_key) if n_key else
                                             np.zeros((1, 0), np.uint8) for r in held])
            sizes = [len(r["combinations"]) // n_key if n_key else 1 for r in held]
            u.combination = np.concatenate([np.frombuffer(r["combination"], np.int32) + at
                                            for r, at in zip(held, np.r_[0, np.cumsum(sizes)[:-1]])])
            for c in ("y", "linear", "boosted"):
                if c in held[0]:
                    setattr(u, c, np.concatenate([np.frombuffer(r[c]) for r in held]))
            u.early = np.repeat([r["early"] for r in held], [n for _, n in u.blocks])
            return u

        held, n = [], 0
        for b in batches:
            for i in range(b.num_rows):
                held += b.slice(i, 1).to_pylist()
                n += len(held[-1]["y"]) // 8
                if n >= size:
                    yield joined(held)
                    held, n = [], 0
        if held:
            yield joined(held)

    def places(u, used, n_lags: int, of_window) -> np.ndarray:
        """Bins of the features ``used``, a row of the matrix for each."""
        out = np.empty((len(used), u.n), np.uint8)
        for i, f in enumerate(used):
            if f < n_lags:
                out[i] = u.lags[f]
            elif f < n_lags + len(of_window):
                of_window[f - n_lags].take(u.window, out=out[i])
            else:
                out[i] = u.combinations[:, f - n_lags - len(of_window)].take(u.combination)
        return out

    def walk(bins: np.ndarray, feature, cut, depth: int) -> np.ndarray:
        """Every row's node at a depth, numbered as a heap; ``feature`` numbers the rows of ``bins``."""
        n = bins.shape[1]
        flat, here = bins.reshape(-1), np.arange(n)
        node = np.ones(n, np.int64)
        at = feature.astype(np.int64) * n
        for _ in range(depth):
            node = 2 * node + (flat.take(at.take(node) + here) > cut.take(node))
        return node

    def renumbered(trees) -> tuple:
        """The features that trees split by, and the trees with these numbered."""
        used = sorted({int(f) for t in trees for f in np.unique(t["feature"])})
        number = np.zeros(max(used, default=0) + 1, np.int64)
        number[used] = np.arange(len(used))
        return used, [number[t["feature"]] for t in trees]

    return SimpleNamespace(chunks=chunks, raw=raw, points=points, binned=binned, units=units, places=places, walk=walk,
                           renumbered=renumbered)


def _best_split():
    def best(n, s, sizes, chosen) -> tuple:
        """(feature, last bin to the left, rows and sum there, rows and sum in all) of one node; feature -1: none."""
        first = np.r_[0, np.cumsum(sizes)]
        f0 = slice(0, sizes[0])
        total, both = n[f0].sum(), s[f0].sum()
        out, gained = (-1, 0, 0.0, 0.0, float(total), float(both)), 1e-12 * (both ** 2 / total if total else 0.0)
        for f in chosen:
            if sizes[f] < 2 or not total:
                continue
            ln, ls = (v[first[f]:first[f + 1]].cumsum()[:-1] for v in (n, s))
            rn, rs = total - ln, both - ls
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where((ln > 0) & (rn > 0), ls ** 2 / ln + rs ** 2 / rn - both ** 2 / total, -1.0)
            j = int(gain.argmax())
            if gain[j] > gained:
                gained, out = gain[j], (int(f), j, float(ln[j]), float(ls[j]), float(total), float(both))
        return out
    return best


# ------------------------------------------------------------------ blocks

@dataclass
class Blocks:
    """Rows as blocks, early ones and others apart.  Features are those of lags, then of windows, then of keys.

    ``cuts``: each feature's thresholds; ``means``: each feature's mean over the early rows;
    ``of_window``: bins of the windows' features, a row for each feature.
    """

    df: DataFrame
    cuts: list
    means: np.ndarray
    n_lags: int
    n_key: int
    of_window: np.ndarray

    @property
    def sizes(self) -> list:
        return [len(c) + 1 for c in self.cuts]

    @property
    def early(self) -> DataFrame:
        return self.df.filter("early").drop("linear")

    @property
    def shape(self) -> dict:
        return {"n_lags": self.n_lags, "n_key": self.n_key}


def _frame(rows: DataFrame, windows: DataFrame, lags, label: str, early: Column) -> tuple[DataFrame, np.ndarray]:
    """Rows with their window's number, and the windows' features: a row for each window of time, whatever the keys."""
    listed = windows.orderBy("bin_start").collect()
    found = np.array([r["_of_window"] for r in listed], dtype=float).reshape(len(listed), -1)
    numbers = rows.sparkSession.createDataFrame([(r["bin_start"], i) for i, r in enumerate(listed)],
                                                rows.select("bin_start").schema.add("_window", T.IntegerType()))
    held = rows.join(F.broadcast(numbers), "bin_start", "left")
    return held.select(*[F.col(c).cast("double") for c in lags], F.coalesce("_window", F.lit(-1)).alias("_window"),
                       "_of_key", F.col(label).cast("double").alias("_y"),
                       F.coalesce(early, F.lit(False)).alias("_early")), found


def _summary(frame: DataFrame, n_lags: int, most: int, chunk: int) -> dict:
    """By number: values and weights of each feature of lags and keys (from 0), of the windows' numbers
    (-1), the sums of lags and keys (from -2 downwards)."""
    t = _tools()

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}

        def add(number: int, values, weights, room: int | None) -> None:
            before = held.get(number, ((), ()))
            both = np.r_[before[0], values], np.r_[before[1], weights]
            held[number] = t.points(*both, room // 2) if room and len(both[0]) > room else both

        for b in t.chunks(batches, chunk):
            lags, window, run, keyed = t.raw(b, n_lags)
            rows = np.bincount(run).astype(float)
            counts = np.bincount(window)
            add(-1, np.flatnonzero(counts), counts[counts > 0], None)
            held[-1] = t.points(*held[-1], len(held[-1][0]))
            for i, (v, w) in enumerate([(v, None) for v in lags] + [(v, rows) for v in keyed.T]):
                add(i, *t.points(v, w, most), 16 * most)
                total, n = held.get(-2 - i, (0.0, 0.0))
                held[-2 - i] = total + (v if w is None else v * w).sum(), n + b.num_rows
        for number, (values, weights) in held.items():
            values, weights = np.atleast_1d(values).astype(float), np.atleast_1d(weights).astype(float)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), number, np.int32)), pa.array(values),
                                              pa.array(weights)], ["number", "value", "weight"])

    def settled(pdf: pd.DataFrame) -> pd.DataFrame:
        number = int(pdf["number"].iloc[0])
        if number < -1:
            a, b = np.array([pdf["value"].sum()]), np.array([pdf["weight"].sum()])
        else:
            a, b = t.points(pdf["value"].to_numpy(), pdf["weight"].to_numpy(), 16 * most if number >= 0 else len(pdf))
        return pd.DataFrame({"number": [number], "a": [a], "b": [b]})

    points = frame.mapInArrow(told, "number int, value double, weight double")
    found = points.groupBy("number").applyInPandas(settled, "number int, a array<double>, b array<double>")
    return {r["number"]: (np.array(r["a"], float), np.array(r["b"], float)) for r in found.collect()}


def blocked(rows: DataFrame, windows: DataFrame, lags, label: str, early: Column, max_bins: int,
            linear: tuple | None = None, most: int = POINTS, chunk: int = CHUNK, block: int = BLOCK) -> Blocks:
    """The rows as blocks, written once; fits use those that are ``early``.

    ``rows``: ``bin_start``, lags and label, and ``_of_key``, the key's features as an array;
    ``windows``: (``bin_start``, ``_of_window``), a row for each window.  ``linear``: coefficients
    and intercept of a linear model on all features, whose predictions the blocks then hold.
    """
    frame, found = _frame(rows, windows, lags, label, early)
    n_lags, n_window = len(lags), found.shape[1]
    told = _summary(frame.filter("_early"), n_lags, most, chunk)
    if -1 not in told:
        raise ValueError("no rows to fit on")
    n_key = max(-1 - i for i in told) - n_lags
    at, counts = told[-1]
    weight = np.zeros(len(found))
    weight[at.astype(int)] = counts

    def rule(values, weights) -> np.ndarray:
        return np.array(cells.thresholds(dict(zip(values.tolist(), weights.tolist())), max_bins) if len(values) else [])

    t = _tools()
    own = [rule(*told.get(i, (np.zeros(0),) * 2)) for i in range(n_lags + n_key)]
    cuts = [rule(*t.points(v[weight > 0], weight[weight > 0], len(v))) for v in found.T]
    cuts = [*own[:n_lags], *cuts, *own[n_lags:]]
    total = weight.sum()
    mean = [told[-2 - i][0][0] / total for i in range(n_lags + n_key)]
    means = np.array([*mean[:n_lags], *(weight @ found / total), *mean[n_lags:]])
    of_window = np.array([t.binned(v, c) for v, c in zip(found.T, cuts[n_lags:])], np.uint8).reshape(n_window, -1)
    coef, intercept = (np.zeros(len(cuts)), 0.0) if linear is None else (np.asarray(linear[0], float), float(linear[1]))
    by_window = found @ coef[n_lags:n_lags + n_window] + intercept

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        names = ["id", "early", "lags", "window", "combination", "combinations", "y", "linear"]
        for i, b in enumerate(t.chunks(batches, block)):
            lags_, window, run, keyed = t.raw(b, n_lags)
            of_key = [t.binned(v, c) for v, c in zip(keyed.T, cuts[n_lags + n_window:])]
            if of_key:
                each, to = np.unique(np.stack(of_key, 1), axis=0, return_inverse=True)
            else:
                each, to = np.zeros((1, 0), np.uint8), np.zeros(len(keyed), int)
            y, is_early = (b.column(n_lags + j).to_numpy(zero_copy_only=False) for j in (2, 3))
            score = coef[:n_lags] @ lags_ + by_window[window] + (keyed @ coef[n_lags + n_window:])[run]
            values = [np.stack([t.binned(v, c) for v, c in zip(lags_, cuts)]), window.astype(np.int32),
                      to.reshape(-1)[run].astype(np.int32), None, y, score]
            for part in (True, False):
                own = np.flatnonzero(is_early == part)
                if len(own):
                    data = [each if v is None else np.ascontiguousarray(v[..., own]) for v in values]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([(TaskContext.get().partitionId() << 32) + 2 * i + part]), pa.array([part]),
                         *[pa.array([v.tobytes()], pa.binary()) for v in data]], names)

    spark = rows.sparkSession
    path = scratch_path(spark, "row-blocks")
    frame.mapInArrow(cut, _BLOCK).write.option("parquet.block.size", GROUP_BYTES).parquet(path)
    return Blocks(spark.read.schema(_BLOCK).parquet(path), cuts, means, n_lags, n_key, of_window)


# -------------------------------------------------------------------- fits

def _grown(blocks: Blocks, df: DataFrame, trees: int, depth: int, per_node: int, seed: int, rate: float | None,
           before: tuple = ()) -> list:
    """Trees of as many levels on the blocks of ``df``, a pass for each level.

    ``rate``: of the draws of a row for each tree (None: every row once).  ``before``: what a
    tree's labels are, as (step size, boosted trees not yet in the rows' predictions); empty: as given.
    """
    t, best, sizes, heap = _tools(), _best_split(), blocks.sizes, 1 << (depth + 1)
    k, first, shape, of_window = len(sizes), np.r_[0, np.cumsum(sizes)], blocks.shape, blocks.of_window
    n_lags, n_window = blocks.n_lags, len(of_window)
    grown = [{"feature": np.zeros(heap, np.int64), "cut": np.full(heap, 255, np.uint8), "value": np.zeros(heap),
              "dead": np.arange(heap) != 1} for _ in range(trees)]
    rng = np.random.default_rng([seed, 1])
    upto = np.cumsum([math.exp(-rate) * rate ** i / math.factorial(i) for i in range(60)]) if rate else None
    low, high = (np.searchsorted(upto, (np.arange(65536) + e) / 65536, "right") for e in (0, 1)) if rate else (None, None)
    unit = UNIT
    pairs = [tuple(range(i, min(i + 2, n_lags))) for i in range(0, n_lags, 2)]

    hot_windows = [(np.arange(sizes[n_lags + f])[:, None] == of_window[f]).astype(float) for f in range(n_window)]

    def level(d: int, now: list, chosen: dict):
        """Counts and sums of each open node's chosen features, added up in a task."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nodes, sums = 1 << d, {}
            pending = before[1] if before else []
            used, numbered = t.renumbered([*now, *pending])
            for u in t.units(batches, unit, **shape):
                bins = t.places(u, used, n_lags, of_window)
                target = u.y
                if before:
                    done = getattr(u, "boosted", 0.0)
                    for tree, f in zip(pending, numbered[len(now):]):
                        done = done + tree["step"] * tree["value"].take(t.walk(bins, f, tree["cut"], tree["depth"]))
                    target = 2.0 * (u.y - done)
                codes = [(u.lags[p[0]].astype(np.int64) * sizes[p[1]] + u.lags[p[1]], sizes[p[0]] * sizes[p[1]]) if len(p) == 2
                         else (u.lags[p[0]].astype(np.int64), sizes[p[0]]) for p in pairs]
                codes.append((u.window.astype(np.int64), of_window.shape[1]))
                codes.append((u.combination.astype(np.int64), len(u.combinations)))
                onehot = [(np.arange(sizes[n_lags + n_window + j])[:, None] == u.combinations[:, j]).astype(float)
                          for j in range(shape["n_key"])]
                for i, tree in enumerate(now):
                    node = t.walk(bins, numbered[i], tree["cut"], d) - nodes
                    dead = tree["dead"][nodes:2 * nodes]
                    if dead.all():
                        continue
                    weight = None
                    if rate:
                        drawn = []
                        for b, n in u.blocks:
                            r = np.random.default_rng([seed, 2, i, b])
                            w = r.integers(0, 65536, n, np.uint16)
                            unsure = np.flatnonzero(low[w] != high[w])
                            c = low[w]
                            c[unsure] = np.searchsorted(upto, (w[unsure] + r.random(len(unsure))) / 65536, "right")
                            drawn.append(c)
                        weight = np.concatenate(drawn).astype(float)
                    live = None if not dead.any() else np.flatnonzero(~dead[node])
                    if live is not None:
                        node, weight = node[live], None if weight is None else weight[live]
                    goal = target if live is None else target[live]
                    goal = goal if weight is None else goal * weight
                    held = sums.setdefault(i, [[np.zeros((2, nodes, size)) for _, size in codes[:-2]],
                                               [np.zeros((2, nodes, s)) for s in sizes[n_lags:]]])
                    for j, (code, size) in enumerate(codes):
                        at = node * size
                        at += code if live is None else code[live]
                        both = (np.bincount(at, v, nodes * size).reshape(nodes, size) for v in (weight, goal))
                        for x, v in enumerate(both):
                            if j < len(pairs):
                                held[0][j][x] += v
                            elif j == len(pairs):
                                for a, hot in zip(held[1], hot_windows):
                                    a[x] += v @ hot.T
                            else:
                                for a, hot in zip(held[1][n_window:], onehot):
                                    a[x] += v @ hot.T
            for i, (held, of_rest) in sums.items():
                every = np.zeros((2, nodes, first[-1]))
                for p, a in zip(pairs, held):
                    if len(p) == 2:
                        a = a.reshape(2, nodes, sizes[p[0]], sizes[p[1]])
                        every[:, :, first[p[0]]:first[p[0] + 1]] = a.sum(3)
                        every[:, :, first[p[1]]:first[p[1] + 1]] = a.sum(2)
                    else:
                        every[:, :, first[p[0]]:first[p[0] + 1]] = a
                for f, a in enumerate(of_rest, n_lags):
                    every[:, :, first[f]:first[f + 1]] = a
                mine = [h for (tree, h) in chosen if tree == i]
                wanted = [np.r_[tuple(np.arange(first[f], first[f + 1]) for f in chosen[i, h])] for h in mine]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(mine), i, np.int32)), pa.array(np.array(mine, np.int32)),
                    *[pa.array([every[x, h - nodes][w].tobytes() for h, w in zip(mine, wanted)], pa.binary()) for x in (0, 1)]],
                    ["tree", "node", "n", "s"])
        return run

    def split(chosen: dict):
        def of_node(pdf: pd.DataFrame) -> pd.DataFrame:
            i, h = int(pdf["tree"].iloc[0]), int(pdf["node"].iloc[0])
            n, s = (np.sum([np.frombuffer(x) for x in pdf[c]], 0) for c in ("n", "s"))
            mine = chosen[i, h]
            f, cut, *rest = best(n, s, [sizes[f] for f in mine], range(len(mine)))
            return pd.DataFrame([(i, h, mine[f] if f >= 0 else -1, cut, *rest)],
                                columns=["tree", "node", "feature", "cut", "ln", "ls", "n", "s"])
        return of_node

    for d in range(depth):
        chosen = {(i, int(h)): sorted(rng.permutation(k)[:per_node].tolist()) for i, tree in enumerate(grown)
                  for h in range(1 << d, 2 << d) if not tree["dead"][h]}
        if not chosen:
            break
        found = df.mapInArrow(level(d, grown, chosen), "tree int, node int, n binary, s binary")
        if len(chosen) > 64:  # many nodes: summed up in tasks, the driver gets the splits
            splits = found.groupBy("tree", "node").applyInPandas(
                split(chosen), "tree int, node int, feature int, cut int, ln double, ls double, n double, s double").collect()
        else:
            parts = pd.DataFrame([tuple(r) for r in found.collect()], columns=["tree", "node", "n", "s"])
            splits = [r for _, pdf in parts.groupby(["tree", "node"]) for r in split(chosen)(pdf).itertuples(index=False)]
        for r in splits:
            tree, h = grown[r.tree], r.node
            if d == 0:
                tree["value"][1] = r.s / r.n if r.n else 0.0
            if r.feature >= 0:
                tree["feature"][h], tree["cut"][h] = r.feature, r.cut
                tree["value"][2 * h], tree["value"][2 * h + 1] = r.ls / r.ln, (r.s - r.ls) / (r.n - r.ln)
                tree["dead"][[2 * h, 2 * h + 1]] = False
        for tree in grown:  # a leaf's rows go on to its left, with its value
            for h in range(1 << d, 2 << d):
                if tree["dead"][2 * h]:
                    tree["value"][[2 * h, 2 * h + 1]] = tree["value"][h]
    for tree in grown:
        for h in range(1, heap // 2):
            if tree["dead"][2 * h]:
                tree["value"][[2 * h, 2 * h + 1]] = tree["value"][h]
        tree["depth"] = depth
    return grown


def forest(blocks: Blocks, estimator) -> list:
    """The trees of a random forest; a prediction is their mean."""
    trees, k = estimator.getNumTrees(), len(blocks.cuts)
    drawn = estimator.getSubsamplingRate() if estimator.getBootstrap() else None
    return _grown(blocks, blocks.early, trees, estimator.getMaxDepth(), cells.per_node(estimator, k) if trees > 1 else k,
                  estimator.getSeed() & 0xFFFFFFFF, drawn)


def boosted(blocks: Blocks, estimator) -> list:
    """Boosted trees, each with its ``step``: a prediction is the sum of theirs, by their steps."""
    depth, seed, step, k = estimator.getMaxDepth(), estimator.getSeed() & 0xFFFFFFFF, estimator.getStepSize(), len(blocks.cuts)
    df, trees, pending, held = blocks.early, [], [], None
    try:
        for i in range(estimator.getMaxIter()):
            if len(pending) == HELD_TREES:
                df = blocks.early if held is None else held
                df = df.mapInArrow(_predicted(blocks, pending), df.drop("boosted").schema.add("boosted", T.BinaryType()))
                before, held, pending = held, df.persist(StorageLevel.DISK_ONLY), []
                held.count()
                if before is not None:
                    before.unpersist()
            tree = _grown(blocks, df, 1, depth, k, seed, None, (step, pending) if i else ())[0]
            tree["step"] = step if i else 1.0
            trees, pending = [*trees, tree], [*pending, tree]
    finally:
        if held is not None:
            held.unpersist()
    return trees


def _predicted(blocks: Blocks, trees: list):
    """Adds the trees' predictions, by their steps, to those of the blocks' rows."""
    t, shape, of_window, n_lags = _tools(), blocks.shape, blocks.of_window, blocks.n_lags

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, numbered = t.renumbered(trees)
        for b in batches:
            for i in range(b.num_rows):
                one = b.slice(i, 1)
                u = next(t.units(iter([one]), 1, **shape))
                bins, done = t.places(u, used, n_lags, of_window), getattr(u, "boosted", 0.0)
                for tree, f in zip(trees, numbered):
                    done = done + tree["step"] * tree["value"].take(t.walk(bins, f, tree["cut"], tree["depth"]))
                kept = [c for c in one.schema.names if c != "boosted"]
                yield pa.RecordBatch.from_arrays([*[one.column(c) for c in kept], pa.array([done.tobytes()], pa.binary())],
                                                 [*kept, "boosted"])
    return run


def predictions(blocks: Blocks, trees: list, windows: np.ndarray, linear: dict, name: str):
    """``predict(model, lags, windows, of_key)`` of raw features: linear models by name as
    (coefficients, intercept), and a forest; ``windows`` are the features of the windows, a row
    for each.  What is missing (NaN) is filled with the means of the rows fitted on.
    """
    t, n_lags, n_window, cuts = _tools(), blocks.n_lags, windows.shape[1], blocks.cuts
    means = np.split(blocks.means, [n_lags, n_lags + n_window])
    windows = np.where(np.isnan(windows), means[1], windows)
    used, numbered = t.renumbered(trees)

    def predict(model: str, lags: np.ndarray, window: np.ndarray, of_key: np.ndarray) -> np.ndarray:
        lags = np.where(np.isnan(lags), means[0][:, None], lags)
        if model != name:
            coef, intercept = linear[model]
            out = coef[:n_lags] @ lags + (windows @ coef[n_lags:n_lags + n_window])[window] + intercept
            if coef[n_lags + n_window:].any():
                keyed = of_key if of_key.shape[1] else np.full((len(window), len(means[2])), np.nan)
                out = out + np.where(np.isnan(keyed), means[2], keyed) @ coef[n_lags + n_window:]
            return out
        bins = np.empty((len(used), len(window)), np.uint8)
        for i, f in enumerate(used):
            if f < n_lags:
                bins[i] = t.binned(lags[f], cuts[f])
            elif f < n_lags + n_window:
                bins[i] = t.binned(windows[:, f - n_lags], cuts[f])[window]
            else:
                j = f - n_lags - n_window
                x = of_key[:, j] if of_key.shape[1] else np.full(len(window), np.nan)
                bins[i] = t.binned(np.where(np.isnan(x), means[2][j], x), cuts[f])
        return sum(tree["value"].take(t.walk(bins, f, tree["cut"], tree["depth"])) for tree, f in zip(trees, numbered)) / len(trees)
    return predict


# ----------------------------------------------------------------- reports

def errors(blocks: Blocks, boosted_trees: list, forest_trees: list) -> dict:
    """(model, early) -> metrics of the blocks' linear predictions, of boosted trees and of a forest: one
    pass over all rows."""
    t, shape, of_window, n_lags, unit = _tools(), blocks.shape, blocks.of_window, blocks.n_lags, UNIT
    share = [(tree["step"], "boosted_trees") for tree in boosted_trees] + [(1.0 / len(forest_trees), "random_forest")] * len(forest_trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, numbered = t.renumbered([*boosted_trees, *forest_trees])
        for u in t.units(batches, unit, **shape):
            bins = t.places(u, used, n_lags, of_window)
            scored = {"linear": u.linear, "boosted_trees": np.zeros(u.n), "random_forest": np.zeros(u.n)}
            for tree, f, (weight, name) in zip([*boosted_trees, *forest_trees], numbered, share):
                scored[name] += weight * tree["value"].take(t.walk(bins, f, tree["cut"], tree["depth"]))
            out = []
            for name, p in scored.items():
                for part in (True, False):
                    y, e = u.y[u.early == part], (u.y - p)[u.early == part]
                    if len(y):
                        there = y != 0
                        out.append((name, part, float(len(y)), float(y.sum()), float(((y - y.mean()) ** 2).sum()),
                                    float(np.abs(e).sum()), float((e * e).sum()), float(np.abs(e[there] / y[there]).sum()),
                                    float(there.sum())))
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*out)],
                                             ["model", "early", "n", "sum", "m2", "ae", "se", "pe", "np"])

    found: dict = {}
    for r in blocks.df.mapInArrow(run, "model string, early boolean, n double, sum double, m2 double, ae double, "
                                       "se double, pe double, np double").collect():
        found.setdefault((r["model"], r["early"]), []).append(r)
    out = {}
    for at, rs in found.items():
        n, sums, m2, ae, se, pe, there = (np.array([r[c] for r in rs]) for c in ("n", "sum", "m2", "ae", "se", "pe", "np"))
        total, label_sum = n.sum(), float(sums.sum())
        spread = float(m2.sum() + (n * (sums / n - label_sum / total) ** 2).sum())
        out[at] = {"n": int(total), "label_sum": label_sum, "mae": float(ae.sum() / total),
                   "rmse": float(np.sqrt(se.sum() / total)), "r2": None if spread == 0 else float(1.0 - se.sum() / spread),
                   "mape": float(pe.sum() / there.sum()) if there.sum() else None}
    return out
