"""Schema listing, shape and peek (S6-S8, A11) as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def schema_frame(df: DataFrame) -> DataFrame:
    """One row per column: position, name, Spark type name, non-null count.

    Types come from the analysed schema; the non-null counts are one
    distributed aggregate (partial counts per task), unpivoted with ``stack``.
    """
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    parts = []
    for i, f in enumerate(fields):
        parts += [F.lit(i).cast("bigint"), F.lit(f.name), F.lit(f.dataType.simpleString()),
                  F.col(f"c{i}")]
    return counts.select(F.inline(F.array(*[
        F.struct(parts[4 * i].alias("col_pos"), parts[4 * i + 1].alias("col_name"),
                 parts[4 * i + 2].alias("data_type"), parts[4 * i + 3].alias("non_null"))
        for i in range(len(fields))])))


def shape_frame(df: DataFrame, name: str) -> DataFrame:
    """(table, rows, cols).  The count is a distributed aggregate."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), F.col("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_cols"))


def head(df: DataFrame, n: int, order: list[str | Column]) -> DataFrame:
    """First ``n`` rows under an explicit order.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top ``n`` and only those reach the final merge (no full sort).
    """
    if not order:
        raise ValueError("head() needs an explicit order; file order is not stable")
    return df.orderBy(*order).limit(n)
