"""Shared helpers: table access, written intermediate tables, hold-out folds."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where it lies at the driver's path (a
    local session started elsewhere); a cluster installs it or takes --py-files."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table; the path goes to Spark's reader as it is, so any
    file system Spark knows will do."""
    return importable(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Cuts the lineage: a lost executor costs the files' rereading only, and all
    later reads see the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that columns put beside it clash with
    none of them; ``select("row.*")`` gives them back if it is named ``row``."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id's text modulo ``parts``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % F.lit(parts)


def keep_probability(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on ``key`` and ``seed`` only."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
