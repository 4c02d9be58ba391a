"""Daily tables that can be written again day by day.

A table lies in one folder per day.  Writing replaces the days that the rows
hold and leaves all other files as they are, so a run can be repeated, and a
late day costs that day.  What looks back over rows (lags) reads the days it
needs besides: a filter on the day column that prunes folders, not rows.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tasks that write one day.
LOTS = 8


def write_days(df: DataFrame, path: str, day: str = "day") -> None:
    """Replace the days of ``df`` (a date column) in the table at ``path``.

    Rows are dealt out by day and a part of it, so a day's files are few and a
    large day is still many tasks' work.
    """
    lot = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(LOTS))
    dealt = df.withColumn("_lot", lot).repartition(day, "_lot").drop("_lot")
    (dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path))


def read_days(spark: SparkSession, path: str, first: date, last: date, day: str = "day") -> DataFrame:
    """The rows of the days from ``first`` to ``last``: only their folders are read."""
    return spark.read.parquet(path).filter(F.col(day).between(F.lit(first), F.lit(last)))


def refresh(spark: SparkSession, source: str, target: str, first: date, last: date,
            compute: Callable[[DataFrame], DataFrame], look_back_days: int = 0, day: str = "day") -> None:
    """Compute the days from ``first`` to ``last`` of ``target`` again from ``source``.

    A row may look back on ``look_back_days`` days: so many days before are read
    besides, and so many after are computed again too, as they look back on the
    asked ones.
    """
    reach = timedelta(days=look_back_days)
    rows = compute(read_days(spark, source, first - reach, last + reach, day))
    write_days(rows.filter(F.col(day).between(F.lit(first), F.lit(last + reach))), target, day)
