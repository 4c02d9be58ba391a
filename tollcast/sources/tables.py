"""Parquet table loading and session views."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a scale-factor folder (column pruning and filter
    pushdown happen at this scan)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_views(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> None:
    """Register each table as a session temp view under its own name."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def sql(spark: SparkSession, text: str) -> DataFrame:
    """SQL text over registered views; Catalyst plans it like the DataFrame API."""
    return spark.sql(text)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back: later
    reads neither compute it again nor depend on cached blocks."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
