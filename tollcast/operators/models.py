"""Encoding and regression models (M1-M8, M12, M13) on Spark ML.

A fit makes many passes over its frame, so ``fit`` and ``tune`` hold it cached
for as long as they run and no longer.  ``training_frame`` fixes the number of
partitions and which rows they hold, so forests and random splits, which draw
per partition, do not depend on the cluster's cores.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Parameter grids of the traffic job (travel-time task).
LR_GRID = {"maxIter": [10, 20], "regParam": [0.9, 0.7, 0.5, 0.3, 0.1],
           "fitIntercept": [False, True], "elasticNetParam": [0.0, 0.5, 1.0]}
GBT_GRID = {"maxDepth": [2, 4, 6, 10, 20], "maxIter": [10, 20, 40]}
RF_GRID = {"maxDepth": [2, 4, 6, 8], "maxBins": [20, 60], "numTrees": [5, 20, 50, 100]}
# Parameter grids of the volume task.
LR_GRID_VOLUME = {"maxIter": [10, 20], "regParam": [0.9, 0.7, 0.5, 0.3, 0.1],
                  "fitIntercept": [False, True], "elasticNetParam": [0.0, 0.3, 0.5, 0.8]}
GBT_GRID_VOLUME = {"maxDepth": [2, 4, 6, 10, 20], "maxIter": [10, 20, 40]}
RF_GRID_VOLUME = {"maxDepth": [4, 8, 12, 20], "maxBins": [10, 20, 60],
                  "numTrees": [100, 500, 1000]}


#: Partitions of a training frame, at least: a property of the fit, not of the cluster.
TRAIN_PARTITIONS = 16
#: Rows that one of them may hold on average, where their number is left open.
TRAIN_ROWS = 1_000_000
#: Distinct values that a categorical column may have.
MAX_CATEGORIES = 1000


def training_partitions(rows: int) -> int:
    """As many partitions as keep a task's share of the rows bounded."""
    return max(TRAIN_PARTITIONS, -(-rows // TRAIN_ROWS))


def training_frame(df: DataFrame, keys, partitions: int | None = None) -> DataFrame:
    """Rows dealt by the hash of ``keys`` (which tell rows apart) into a number
    of partitions that only the rows' number decides (or ``partitions``),
    sorted in each."""
    partitions = partitions or training_partitions(df.count())
    return df.repartition(partitions, *keys).sortWithinPartitions(*keys)


def fit(estimator, frame: DataFrame):
    """The fitted model; the frame is cached for the fit's passes only."""
    cached = frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return estimator.fit(cached)
    finally:
        cached.unpersist()


def index_stage(col: str, out: str | None = None, handle_invalid: str = "keep") -> StringIndexer:
    """M1: category -> index by descending frequency (ties: ascending value)."""
    return StringIndexer(inputCol=col, outputCol=out or f"{col}_index",
                         handleInvalid=handle_invalid, stringOrderType="frequencyDesc")


def encoder_stages(cat_cols, num_cols, features_col: str = "features",
                   handle_invalid: str = "keep") -> list:
    """M1-M3: index + one-hot (last category dropped) per categorical column,
    then one assembled vector with the numeric columns."""
    stages, vec_cols = [], []
    for c in cat_cols:
        stages.append(index_stage(c, f"{c}_index", handle_invalid))
        stages.append(OneHotEncoder(inputCol=f"{c}_index", outputCol=f"{c}_vec",
                                    dropLast=True, handleInvalid="keep"
                                    if handle_invalid == "keep" else "error"))
        vec_cols.append(f"{c}_vec")
    stages.append(VectorAssembler(inputCols=vec_cols + list(num_cols), outputCol=features_col,
                                  handleInvalid="error"))
    return stages


def fit_encoder(df: DataFrame, cat_cols, num_cols, features_col: str = "features",
                handle_invalid: str = "keep", max_categories: int = MAX_CATEGORIES) -> PipelineModel:
    """M4: fit the encoding pipeline.

    Indexing brings a column's distinct values to the driver, so a column with
    more than ``max_categories`` of them (a window label, an id: an open
    domain) is refused.
    """
    if cat_cols:
        row = df.agg(*[F.approx_count_distinct(f"`{c}`", 0.02).alias(c) for c in cat_cols]).first()
        wide = [c for c in cat_cols if row[c] > 1.1 * max_categories]
        if wide:
            raise ValueError(f"more than {max_categories} categories in {', '.join(wide)}")
    return Pipeline(stages=encoder_stages(cat_cols, num_cols, features_col,
                                          handle_invalid)).fit(df)


def vector_columns(df: DataFrame, vec_col: str, n: int, prefix: str = "f_") -> DataFrame:
    """Flatten an ML vector into ``n`` double columns (for SQL-side checks)."""
    arr = vector_to_array(F.col(vec_col))
    return df.withColumns({f"{prefix}{i}": arr[i] for i in range(n)})


def linear_regression(label: str = "label", features: str = "features", **params):
    """M5: least squares (defaults as Spark ML)."""
    return LinearRegression(labelCol=label, featuresCol=features, **params)


def random_forest(label: str = "label", features: str = "features", seed: int = 42, **params):
    """M7."""
    return RandomForestRegressor(labelCol=label, featuresCol=features, seed=seed, **params)


def gradient_boosted(label: str = "label", features: str = "features", seed: int = 42,
                     **params):
    """M6."""
    return GBTRegressor(labelCol=label, featuresCol=features, seed=seed, **params)


def score(model, df: DataFrame, keep=(), label: str = "label",
          prediction: str = "prediction") -> DataFrame:
    """M8: predictions with the label and the chosen id columns."""
    return model.transform(df).select(*keep, label, prediction)


def time_split(df: DataFrame, ts_col: str, cutoff: str):
    """Q11: time-based holdout: rows before ``cutoff`` train, the rest
    validate (metrics on rows the model has not seen, next to the in-sample
    figure).  Two filters on the same frame; no random sampling."""
    cut = F.lit(cutoff).cast(dict(df.dtypes)[ts_col])
    return df.filter(F.col(ts_col) < cut), df.filter(F.col(ts_col) >= cut)


def param_grid(estimator, grid: dict) -> list:
    """Every combination of the named parameter values."""
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(estimator.getParam(name), values)
    return b.build()


def tune(estimator, grid: dict, train: DataFrame, label: str = "label",
         metric: str = "rmse", train_ratio: float = 0.8, seed: int = 42,
         parallelism: int = 4):
    """train/validation split over the grid, really fitted; returns the
    fitted ``TrainValidationSplitModel`` (best model refit on all of ``train``)."""
    tvs = TrainValidationSplit(
        estimator=estimator, estimatorParamMaps=param_grid(estimator, grid),
        evaluator=RegressionEvaluator(labelCol=label, metricName=metric),
        trainRatio=train_ratio, seed=seed, parallelism=parallelism)
    return fit(tvs, train)


def tuning_table(spark, tvs_model, grid: dict, metric: str = "rmse") -> DataFrame:
    """One row per grid point with its validation metric."""
    maps = tvs_model.getEstimatorParamMaps()
    rows = []
    for pm, m in zip(maps, tvs_model.validationMetrics):
        vals = {p.name: pm[p] for p in pm}
        rows.append(tuple([str(vals.get(k)) for k in grid] + [float(m)]))
    cols = [f"{k} string" for k in grid] + [f"{metric} double"]
    return spark.createDataFrame(rows, ", ".join(cols))
