"""Regression metrics in one distributed aggregate.

MAE, RMSE, R² and MAPE come from a single pass: no ``collect`` of label and
prediction columns, no positional zip on the driver.  MAPE skips rows whose
label is 0 (``try_divide`` gives NULL there and ``avg`` ignores it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mape(label: Column, prediction: Column) -> Column:
    """Mean absolute percentage error, as an aggregate expression."""
    return F.avg(F.abs(F.try_divide(label - prediction, label)))


def aggregates(label: str = "label", prediction: str = "prediction") -> list[Column]:
    """The metrics as aggregate expressions."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    err = y - p
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        # try_divide: a constant label gives NULL instead of an ANSI error
        (F.lit(1.0) - F.try_divide(F.sum(err * err), F.var_pop(y) * F.count(y))).alias("r2"),
        mape(y, p).alias("mape"),
    ]


def regression_metrics(pred: DataFrame, label: str = "label",
                       prediction: str = "prediction") -> DataFrame:
    return pred.agg(*aggregates(label, prediction))
