"""Recursive multi-step forecasts of listed windows (M8; Q8 with real lags, Q11).

The windows of a forecast come in blocks of consecutive windows.  The first
window of a block has real lags: the last values observed before the block.
Every further one has the prediction before it as lag 1, and the others move
back by one.  A step is one model application to all keys and all blocks, and
one join of its windows with the state of the step before (a row per key and
block, its lags as an array), so a job has as many steps as the longest block,
whatever the keys.  The state is written at every step: no step is computed
twice, and a lost executor costs a part of one step.

``forecast_in_place`` is the same where the models are functions of arrays: all
steps of a block are made where its key's row lies, without a join between them.

A key with fewer observed values than lags has NULL lags, which the caller
fills like those of the training rows; NULL keys are keys; a block without any
observation before it has NULL lags throughout; observed rows after the last
block are not used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timefns as tf
from ..sources.tables import written
from .lags import add_lags

_FORMAT = "%Y-%m-%d %H:%M:%S"


def blocks(windows, minutes: int = 20) -> list[tuple[str, int, str]]:
    """(window, step in its block from 1, block start) of window texts, in order of time."""
    out: list[tuple[str, int, str]] = []
    for w in sorted(set(windows)):
        at = datetime.strptime(w, _FORMAT)
        follows = out and datetime.strptime(out[-1][0], _FORMAT) + timedelta(minutes=minutes) == at
        out.append((w, out[-1][1] + 1, out[-1][2]) if follows else (w, 1, w))
    return out


def _time(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def forecast_grid(key_table: DataFrame, keys, windows, minutes: int = 20, bin_col: str = "bin_start") -> DataFrame:
    """(keys, bin, step, block): every key with every listed window; the list is a parameter."""
    rows = F.array(*[F.struct(_time(w).alias(bin_col), F.lit(s).alias("step"), _time(b).alias("block"))
                     for w, s, b in blocks(windows, minutes)])
    return key_table.select(*keys).distinct().select(*keys, F.inline(rows))


def _key(keys) -> Column:
    return F.struct(*[F.col(k) for k in keys])


def last_values(observed: DataFrame, keys, value: str, block_starts, n: int, bin_col: str = "bin_start",
                **buckets) -> DataFrame:
    """(_key, block, lags): the last ``n`` observed values before each block's start, latest first.

    Observed rows are put to the first block that starts after them; the latest
    of each block is an aggregate (partial in every task), and a block without
    one of its own takes that of the blocks before it, among at most as many
    rows a key as there are blocks.
    """
    starts = sorted(block_starts)
    history = add_lags(observed, value, max(n - 1, 1), partition_by=list(keys), order=[bin_col], **buckets)
    lags = F.array(F.col(value).cast("double"), *[F.col(f"lag{i}").cast("double") for i in range(1, n)])
    started = F.size(F.filter(F.array(*map(_time, starts)), lambda s: s <= F.col(bin_col)))
    rows = history.select(_key(keys).alias("_key"), F.col(bin_col).alias("at"), lags.alias("lags"),
                          started.alias("next")).filter(F.col("next") < len(starts))
    latest = rows.groupBy("_key", "next").agg(F.max(F.struct("at", "lags")).alias("x"))
    per_key = latest.groupBy("_key").agg(F.collect_list(F.struct("next", "x.lags")).alias("own"))
    each = F.array(*[F.struct(F.lit(i).alias("i"), _time(s).alias("block")) for i, s in enumerate(starts)])
    out = per_key.select("_key", "own", F.inline(each))
    found = F.array_max(F.filter("own", lambda x: x["next"] <= F.col("i")))
    return out.select("_key", "block", found["lags"].alias("lags")).filter("lags IS NOT NULL")


def recursive_forecast(grid: DataFrame, origins: DataFrame, predict: Callable[[DataFrame], DataFrame], keys,
                       n_lags: int, lag_prefix: str = "lag", prediction: str = "prediction") -> DataFrame:
    """``grid`` with its lags and predictions.

    ``grid`` has keys, block, step and whatever else the model needs; ``predict``
    adds ``prediction`` to rows with lag columns (and may fill these).
    """
    steps = grid.agg(F.max("step")).first()[0] or 0
    cols, state, out = grid.columns, origins, []
    lags = [f"{lag_prefix}{i}" for i in range(1, n_lags + 1)]
    for step in range(1, steps + 1):
        now = grid.filter(F.col("step") == step).withColumn("_key", _key(keys))
        now = now.join(state, ["_key", "block"], "left")
        now = now.withColumns({c: F.col("lags")[i] for i, c in enumerate(lags)})
        done = written(predict(now).select(*cols, "_key", "lags", *lags, prediction), f"forecast-{step}")
        before = F.coalesce("lags", F.array_repeat(F.lit(None).cast("double"), n_lags))
        state = done.select("_key", "block", F.slice(F.concat(F.array(F.col(prediction).cast("double")), before),
                                                     1, n_lags).alias("lags"))
        out.append(done.select(*cols, *lags, prediction))
    if not out:
        empty = grid.withColumns({c: F.lit(None).cast("double") for c in [*lags, prediction]})
        return empty
    return reduce(DataFrame.unionAll, out)


def listed_windows(spark: SparkSession, listed, bin_col: str = "bin_start") -> DataFrame:
    """A row for each of the listed windows (``blocks``)."""
    return spark.range(1).select(F.explode(F.array(*[_time(w) for w, _, _ in listed])).alias(bin_col))


def forecast_in_place(key_table: DataFrame, origins: DataFrame, predict: Callable, keys, listed, models, n_lags: int,
                      label: str, minutes: int = 20) -> DataFrame:
    """(model, keys, time_window, ``label``): the listed windows (``blocks``) of every key by each model.

    ``key_table``: keys and ``_of_key``, an array of what a model knows of a key (or NULL).
    ``predict(model, lags, windows, of_key)``: predictions of rows by their lags (a row of the
    array for each lag, NaN where missing), their windows' places in the list, and their keys.
    """
    keys, models = list(keys), list(models)
    starts = list(dict.fromkeys(b for _, _, b in listed))
    steps = [[i for i, (_, _, b) in enumerate(listed) if b == start] for start in starts]
    label_of = F.array(*[tf.window_label(_time(w), minutes) for w, _, _ in listed])
    blocks_ = F.array(*[F.struct(F.lit(i).alias("_at"), _time(b).alias("block")) for i, b in enumerate(starts)])
    rows = key_table.withColumn("_key", _key(keys)).select("*", F.inline(blocks_))
    rows = rows.join(origins, ["_key", "block"], "left").select(*keys, "_at", "lags", "_of_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def matrix(column, size: int) -> np.ndarray:
            """An array of each row, NaN where it or a value is missing."""
            out = np.full((len(column), size), np.nan)
            there = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
            if len(there):
                values = column.flatten().to_numpy(zero_copy_only=False)
                out[there] = values.astype(float).reshape(len(there), -1)
            return out

        for b in batches:
            at, n = b.column("_at").to_numpy(zero_copy_only=False), b.num_rows
            first = matrix(b.column("lags"), n_lags).T
            held = b.column("_of_key")
            size = len(held.flatten()) // max(held.is_valid().sum().as_py(), 1)
            of_key = matrix(held, size)
            columns = []
            for model in models:
                out = np.full((n, max(map(len, steps))), np.nan)
                for i, own in enumerate(steps):
                    here = np.flatnonzero(at == i)
                    lags = first[:, here]
                    for step, window in enumerate(own if len(here) else []):
                        z = predict(model, lags, np.full(len(here), window), of_key[here])
                        out[here, step] = z
                        lags = np.concatenate([z[None], lags[:-1]])
                ends = np.arange(n + 1, dtype=np.int32) * out.shape[1]
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(out.reshape(-1))))
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keys], b.column("_at"), *columns],
                                             [*keys, "_at", *[f"_p{i}" for i in range(len(models))]])

    types = {f.name: f.dataType.simpleString() for f in key_table.schema.fields}
    schema = ", ".join([*[f"`{k}` {types[k]}" for k in keys], "_at int", *[f"_p{i} array<double>" for i in range(len(models))]])
    done = rows.mapInArrow(run, schema)
    places = F.array(*[F.array(*[F.lit(i) for i in own]) for own in steps])

    def listed_of(model: str, predictions: Column) -> Column:
        return F.transform(places[F.col("_at")], lambda w, i: F.struct(
            F.lit(model).alias("model"), w.alias("w"), predictions[i].alias(label)))

    each = F.explode(F.flatten(F.array(*[listed_of(m, F.col(f"_p{i}")) for i, m in enumerate(models)]))).alias("x")
    return done.select(*keys, each).select(F.col("x")["model"].alias("model"), *keys,
                                           label_of[F.col("x")["w"]].alias("time_window"), F.col("x")[label].alias(label))
