"""Column housekeeping and appends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequence import add_sequence


def key_first(df: DataFrame, keys) -> DataFrame:
    """Key columns first, the rest in their current order."""
    keys = list(keys)
    return df.select(*keys, *[c for c in df.columns if c not in keys])


def drop_rename(df: DataFrame, drop=(), rename: dict | None = None) -> DataFrame:
    """Drop columns, then rename ``old -> new``."""
    out = df.drop(*drop)
    if rename:
        out = out.withColumnsRenamed(rename)
    return out


def align_schema(test: DataFrame, train_columns, fill=0) -> DataFrame:
    """Give ``test`` exactly ``train_columns``, in that order.

    Columns missing from ``test`` become the constant ``fill``; columns only
    in ``test`` are dropped.
    """
    have = set(test.columns)
    return test.select(*[F.col(f"`{c}`") if c in have else F.lit(fill).alias(c)
                         for c in train_columns])


def append_sources(frames: dict, order, source_col: str = "source",
                   index_col: str = "index", old_index_col: str | None = "old_index",
                   num_partitions: int | None = None) -> DataFrame:
    """Bag union of named frames (columns matched by name, missing ones
    NULL), tagged with their source, renumbered 0..n-1 over (source order,
    ``order``).  ``old_index_col`` keeps each row's number within its own frame.

    Numbers come from the balanced dense sequence, not a global window.
    """
    names = list(frames)
    parts = []
    for i, name in enumerate(names):
        parts.append(frames[name].withColumns({source_col: F.lit(name),
                                               "_src_rank": F.lit(i)}))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    seq = add_sequence(u, ["_src_rank", *order], num_partitions, seq_col=index_col)
    if old_index_col:
        # a frame's first position = number of rows in the frames before it; a row per frame
        first = seq.groupBy("_src_rank").agg(F.min(index_col).alias("_first"))
        seq = seq.join(F.broadcast(first), "_src_rank").withColumn(
            old_index_col, F.col(index_col) - F.col("_first")).drop("_first")
    return seq.drop("_src_rank")
