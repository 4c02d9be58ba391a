"""Profiles as states that are merged.

One state row per (part, column), say a day's, holds the count, mean, sum of
squared deviations, least and greatest value and a quantile sketch of bounded
size.  A profile over any set of parts merges their states; a new day costs
that day's rows only, and no raw row is read again.

Count, mean, deviation, least and greatest value are exact (up to rounding).
Quantiles come from KLL sketches: with ``k`` the rank of an answer differs
from the asked one by less than ``rank_error(k)`` of the rows in at least 99
of 100 cases, whatever the number of rows and merges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Accuracy of the quantile sketches.
SKETCH_K = 800


def rank_error(k: int = SKETCH_K) -> float:
    """The sketch's normalised rank error at 99 % (its library's fitted bound)."""
    return 2.296 / k ** 0.9021


def partial_states(df: DataFrame, part, cols, k: int = SKETCH_K) -> DataFrame:
    """(part, col_name, n, mean, m2, low, high, sketch) of the non-NULL values of each part."""
    pairs = F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(f"`{c}`").cast("double").alias("val")) for c in cols])
    long = df.select(part.alias("part"), F.inline(pairs)).filter(F.col("val").isNotNull())
    return long.groupBy("part", "col_name").agg(
        F.count("val").alias("n"), F.avg("val").alias("mean"), (F.var_pop("val") * F.count("val")).alias("m2"),
        F.min("val").alias("low"), F.max("val").alias("high"), F.kll_sketch_agg_double("val", F.lit(k)).alias("sketch"))


def merge_states(states: DataFrame, quantiles=(0.25, 0.5, 0.75), k: int = SKETCH_K) -> DataFrame:
    """One row per column: count, mean, std (sample), min, quartiles, max of all parts' rows.

    Deviations add up to those within the parts and those of the parts' means
    from the mean of all, which is the same whatever the order of merging.
    """
    total = states.groupBy("col_name").agg(F.sum(F.col("n") * F.col("mean")).alias("_s"), F.sum("n").alias("_n"))
    far = states.join(total.select("col_name", (F.col("_s") / F.col("_n")).alias("_mean")), "col_name")
    between = F.col("n") * (F.col("mean") - F.col("_mean")) * (F.col("mean") - F.col("_mean"))
    merged = far.groupBy("col_name").agg(
        F.sum("n").alias("count"), F.first("_mean").alias("mean"), F.sum(F.col("m2") + between).alias("_m2"),
        F.min("low").alias("min"), F.max("high").alias("max"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("_sketch"))
    qs = [F.kll_sketch_get_quantile_double("_sketch", F.lit(float(q))).alias(f"q{int(round(q * 100))}")
          for q in quantiles]
    std = F.when(F.col("count") > 1, F.sqrt(F.col("_m2") / (F.col("count") - 1)))
    return merged.select("col_name", "count", "mean", std.alias("std"), "min", *qs, "max")
