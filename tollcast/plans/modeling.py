"""Features to models and forecasts in one job per task.

``fit_and_report`` takes a feature frame with train rows, encodes it, fits
linear regression, gradient-boosted trees and a random forest, and returns one
row of metrics per model for the rows it was fitted on and for a time holdout.
The feature frame is written once to the shared checkpoint folder, since
every fit and every report reads it.  ``fit_and_report_vectors`` is the same for many
rows, whose features are vectors (``features.travel_time_rows``); its trees are fitted on
blocks of binned rows (``operators.blocks``).  ``forecast`` fits one model on all train
rows and predicts the listed windows of every key, each from the predictions
before it; ``forecast_vectors`` is the same for many rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import timefns as tf
from ..operators import blocks, fill, joins, metrics, models
from ..operators import forecast as fc
from ..sources.tables import written
from .features import FeatureRows

METRICS = ("n", "label_sum", "mae", "rmse", "r2", "mape")


@dataclass
class ModelOptions:
    """``categories``: columns of a fixed, small domain to index and one-hot;
    open domains (window labels, ids) are left out by default.  ``linear_subset``:
    numeric columns of a further linear model, reported under that name."""

    categories: tuple = ()
    partitions: int | None = None
    max_categories: int = models.MAX_CATEGORIES
    linear_subset: list | None = None
    lr: dict | None = None
    gbt: dict | None = None
    rf: dict | None = None


def numeric_columns(df: DataFrame, without=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if f.dataType.typeName() in ("double", "float", "integer", "long", "short", "byte")
            and f.name not in without]


def training_rows(features: DataFrame, keys, label: str) -> DataFrame:
    """The train rows with a label, their window start, missing numbers as 0; written once."""
    rows = features.filter((F.col("split") == "train") & F.col(label).isNotNull())
    rows = rows.withColumn("window_start", tf.parse_window_start("time_window"))
    return written(rows.fillna(0), "model-rows")


def report(name: str, part: str, scored: DataFrame, label: str) -> DataFrame:
    """One row of metrics of a scored frame (all NULL but the count if it is empty)."""
    m = metrics.regression_metrics(scored, label)
    total = scored.agg(F.sum(label).cast("double").alias("label_sum"))
    return m.withColumn("label_sum", total.scalar()).select(
        F.lit(name).alias("model"), F.lit(part).alias("part"), *METRICS)


def _estimators(o: ModelOptions, label: str) -> dict:
    return {
        "linear": models.linear_regression(label, **(o.lr or {})),
        "boosted_trees": models.gradient_boosted(label, **(o.gbt or {})),
        "random_forest": models.random_forest(label, **(o.rf or {}))}


def fit_and_report(features: DataFrame, keys, label: str, cutoff: str,
                   numbers: list | None = None, options: ModelOptions | None = None) -> DataFrame:
    """Metrics of three models fitted on the train rows before ``cutoff``, on
    those rows (``in_sample``) and on the train rows after it (``holdout``)."""
    o = options or ModelOptions()
    rows = training_rows(features, keys, label)
    before, after = models.time_split(rows, "window_start", cutoff)
    numbers = numbers or numeric_columns(rows, without=(label, *keys))
    frame = models.training_frame(before, [*keys, "time_window"], o.partitions)
    encoder = models.fit_encoder(before, list(o.categories), numbers, max_categories=o.max_categories)
    estimators = _estimators(o, label)
    fits = {name: (encoder, e) for name, e in estimators.items()}
    if o.linear_subset:
        fits["linear_subset"] = (models.fit_encoder(before, [], o.linear_subset), estimators["linear"])
    out = []
    for name, (enc, estimator) in fits.items():
        model = models.fit(estimator, enc.transform(frame))
        for part, df in (("in_sample", frame), ("holdout", after)):
            out.append(report(name, part, model.transform(enc.transform(df)), label))
    return reduce(DataFrame.unionAll, out)


def fit_and_report_vectors(features: FeatureRows, keys, label: str, cutoff: str,
                           options: ModelOptions | None = None) -> DataFrame:
    """``fit_and_report`` of rows with their features as vectors.

    The linear model is the library's, from two passes over vectors built as they are read; trees are fitted on blocks
    of binned rows, and one pass over these scores every model on both parts.  Estimators with
    parameters that ``blocks`` does not know are fitted by the library, on rows held on disk.
    """
    o, rows = options or ModelOptions(), features.rows
    before, _ = models.time_split(rows, "bin_start", cutoff)

    def encoded(df: DataFrame) -> DataFrame:
        return features.vectors(df).withColumn("features", array_to_vector("features"))

    estimators = _estimators(o, label)
    early = F.col("bin_start") < F.lit(cutoff).cast(dict(rows.dtypes)["bin_start"])
    if blocks.known(estimators["boosted_trees"], estimators["random_forest"]):
        linear = estimators["linear"].fit(encoded(before).select("features", label))
        made = blocks.blocked(rows, features.windows, features.lags, label, early, estimators["random_forest"].getMaxBins(),
                              (linear.coefficients.toArray(), linear.intercept))
        found = blocks.errors(made, blocks.boosted(made, estimators["boosted_trees"]),
                              blocks.forest(made, estimators["random_forest"]))
        empty = {"n": 0} | dict.fromkeys(METRICS[1:])
        reports = [(m, p, *[found.get((m, p == "in_sample"), empty)[c] for c in METRICS])
                   for m in estimators for p in ("in_sample", "holdout")]
        return rows.sparkSession.createDataFrame(
            reports, "model string, part string, n bigint, " + ", ".join(f"{c} double" for c in METRICS[1:]))

    frame = encoded(models.training_frame(before, [*keys, "bin_start"], o.partitions)).persist(StorageLevel.DISK_ONLY)
    try:
        fitted = {name: e.fit(frame) for name, e in estimators.items()}
    finally:
        frame.unpersist()
    scored = encoded(rows).withColumn("part", F.when(early, "in_sample").otherwise("holdout"))
    for name, model in fitted.items():
        scored = model.copy({model.predictionCol: name}).transform(scored)
    each = scored.select("part", label, F.inline(F.array(*[
        F.struct(F.lit(name).alias("model"), F.col(name).alias("prediction")) for name in fitted])))
    found = each.groupBy("model", "part").agg(*metrics.aggregates(label), F.sum(label).cast("double").alias("label_sum"))
    listed = rows.sparkSession.createDataFrame([(m, p) for m in fitted for p in ("in_sample", "holdout")],
                                               "model string, part string")
    return listed.join(found, ["model", "part"], "left").fillna(0, ["n"]).select("model", "part", *METRICS)


def forecast(features: DataFrame, keys, label: str, windows, exogenous: Callable[[DataFrame], DataFrame],
             fits: dict[str, tuple[list, object]], key_table: DataFrame | None = None, n_lags: int = 7,
             minutes: int = 20, options: ModelOptions | None = None, **buckets) -> DataFrame:
    """(model, keys, time_window, ``label``): predictions of the listed windows for every key.

    ``fits`` gives each model's numeric columns and estimator, fitted on all
    train rows.  Lags are real: the train rows' last labels before a block of
    windows, then the block's own predictions.  ``exogenous`` adds to rows of
    ``bin_start`` what is known of a window beforehand (calendar, weather,
    features of the key).  What is missing is filled with the train rows' means.
    """
    o, keys = options or ModelOptions(), list(keys)
    rows = training_rows(features, keys, label)
    frame = models.training_frame(rows, [*keys, "time_window"], o.partitions)
    observed = rows.select(*keys, F.col("window_start").alias("bin_start"), label)
    starts = {b for _, _, b in fc.blocks(windows, minutes)}
    origins = written(fc.last_values(observed, keys, label, starts, n_lags, **buckets), "forecast-origins")
    grid = fc.forecast_grid(rows if key_table is None else key_table, keys, windows, minutes)
    grid = written(exogenous(grid), "forecast-windows")
    out = []
    for name, (numbers, estimator) in fits.items():
        encoder = models.fit_encoder(rows, list(o.categories), numbers, max_categories=o.max_categories)
        model = models.fit(estimator, encoder.transform(frame))
        means = fill.column_means(rows, numbers)

        def predict(df: DataFrame, encoder=encoder, model=model, means=means, numbers=numbers) -> DataFrame:
            return model.transform(encoder.transform(fill.apply_means(df, means, numbers)))

        done = fc.recursive_forecast(grid, origins, predict, keys, n_lags)
        out.append(done.select(F.lit(name).alias("model"), *keys,
                               tf.window_label("bin_start", minutes).alias("time_window"),
                               F.col("prediction").alias(label)))
    return reduce(DataFrame.unionAll, out)


def forecast_vectors(features: FeatureRows, keys, label: str, windows, exogenous: Callable[[DataFrame], DataFrame],
                     key_features: DataFrame | None, linear: tuple[list, object], forest: tuple[str, object],
                     key_table: DataFrame, n_lags: int = 7, minutes: int = 20, **buckets) -> DataFrame:
    """``forecast`` by a linear model and a forest on rows with their features as vectors.

    ``linear``: the model's columns and estimator; ``forest``: the name and estimator of a forest on all
    features, grown on blocks of binned rows.  ``exogenous`` adds to rows of ``bin_start`` what is known
    of a window, ``key_features`` are those of a key.  All steps of a block of windows are made
    where its key's row lies: nothing is joined or written between them.
    """
    keys, spark = list(keys), features.rows.sparkSession
    numbers, estimator = linear
    name, grower = forest
    at = [features.names.index(c) for c in numbers]
    vectors = features.vectors(features.rows).select(
        array_to_vector(F.array(*[F.col("features")[i] for i in at])).alias("features"), label)
    fitted = estimator.fit(vectors)
    made = blocks.blocked(features.rows, features.windows, features.lags, label, F.lit(True), grower.getMaxBins())
    trees = blocks.forest(made, grower)

    coef = np.zeros(len(features.names))
    coef[at] = fitted.coefficients.toArray()
    listed = fc.blocks(windows, minutes)
    starts = {b for _, _, b in listed}
    origins = fc.last_values(features.rows.select(*keys, "bin_start", label), keys, label, starts, n_lags, **buckets)
    known = exogenous(fc.listed_windows(spark, listed))
    n_window, of_window = made.of_window.shape[0], features.names[n_lags:n_lags + made.of_window.shape[0]]
    rows = known.select("bin_start", *[F.col(f"`{c}`").cast("double") for c in of_window]).collect()
    by_time = {str(r["bin_start"])[:19]: [np.nan if v is None else v for v in r[1:]] for r in rows}
    found = np.array([by_time[w] for w, _, _ in listed]).reshape(len(listed), n_window)
    of_key = features.names[n_lags + n_window:]
    table = key_table.select(*keys).distinct()
    if of_key:
        table = joins.feature_join(table, key_features.select(
            *keys, F.array(*[F.col(f"`{c}`").cast("double") for c in of_key]).alias("_of_key")), keys)
    else:
        table = table.withColumn("_of_key", F.lit(None).cast("array<double>"))
    predict = blocks.predictions(made, trees, found, {"linear": (coef, float(fitted.intercept))}, name)
    return fc.forecast_in_place(table, origins, predict, keys, listed, ["linear", name], n_lags, label, minutes)
