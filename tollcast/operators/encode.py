"""Encoding of open domains (M1, M2; Q10 by option).

A window label or an id has more values the longer history gets, so its values
never come to the driver: they are counted in a shuffle, ranked by the
balanced sequence, and kept as a table.  The ``top`` most frequent values (a
parameter, so the broadcast of that part of the table is bounded) have an
index of their own, every other value, NULL and unseen values share the last
one.  Vectors are sparse.
"""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequence import add_sequence


def frequency_dictionary(df: DataFrame, col: str, num_partitions: int | None = None) -> DataFrame:
    """(value, n, index): every non-NULL value by descending frequency (ties: ascending value)."""
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n")).filter("value IS NOT NULL")
    order = [F.col("n").desc(), F.col("value")]
    return add_sequence(counts, order, num_partitions, seq_col="index")


def index_open(df: DataFrame, col: str, dictionary: DataFrame, top: int, out: str | None = None) -> DataFrame:
    """M1 for an open domain: a double index below ``top``, and ``top`` for all other values."""
    own = dictionary.filter(F.col("index") < top).select(F.col("value").alias("_value"), F.col("index").alias("_index"))
    # at most `top` rows: a proven bound, so the broadcast is safe
    rows = df.join(F.broadcast(own), F.col(col) == F.col("_value"), "left")
    index = F.coalesce(F.col("_index"), F.lit(top)).cast("double")
    return rows.withColumn(out or f"{col}_index", index).drop("_value", "_index")


def onehot_open(df: DataFrame, col: str, dictionary: DataFrame, top: int, out: str | None = None) -> DataFrame:
    """M2 for an open domain: sparse vectors of ``top`` places, empty for the shared rest (the
    last category is dropped)."""
    index = f"{col}_index"
    rows = index_open(df, col, dictionary, top, index)
    # the size comes from the column's metadata, so fitting reads no rows
    size = {"ml_attr": {"type": "nominal", "num_vals": top + 1}}
    rows = rows.withColumn(index, F.col(index).alias(index, metadata=size))
    encoder = OneHotEncoder(inputCols=[index], outputCols=[out or f"{col}_vec"], dropLast=True)
    return encoder.fit(rows).transform(rows)
