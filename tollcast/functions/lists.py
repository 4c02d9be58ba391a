"""Comma-list columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .timefns import _c


def split_list(col, sep: str = ",") -> Column:
    """``'a,b,c'`` -> ``['a','b','c']``; NULL or empty text -> empty array."""
    c = _c(col)
    return F.when(F.coalesce(F.length(c), F.lit(0)) == 0, F.array().cast("array<string>")) \
        .otherwise(F.split(c, sep))


def explode_list(df: DataFrame, col: str, out_col: str, pos_col: str | None = "pos",
                 sep: str = ",") -> DataFrame:
    """one row per list element, with its 0-based position."""
    keep = [c for c in df.columns if c != col]
    if pos_col:
        return df.select(*keep, F.posexplode(split_list(col, sep)).alias(pos_col, out_col))
    return df.select(*keep, F.explode(split_list(col, sep)).alias(out_col))


def has_many(col, sep: str = ",") -> Column:
    """1 if the list text holds a separator (two or more items), else 0."""
    return F.coalesce(_c(col).contains(sep), F.lit(False)).cast("int")
