"""Fixed-width time bins.

``groupBy(bin_start, *keys)`` plans as partial aggregation per task, one hash
exchange on (bin, keys) and a final merge: a hot key is still split across
bins and pre-aggregated before it is shuffled.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefns import bin_start, shift


def _binned(df: DataFrame, ts: str, minutes: int, offset_minutes: int, label: str,
            bin_col: str) -> DataFrame:
    start = bin_start(ts, minutes, offset_minutes)
    if label == "right":
        start = shift(start, minutes=minutes)
    elif label != "left":
        raise ValueError("label must be 'left' or 'right'")
    return df.withColumn(bin_col, start)


def bin_mean(df: DataFrame, ts: str, keys, value: str, minutes: int = 20,
             out: str = "avg_value", count_col: str | None = None,
             offset_minutes: int = 0, label: str = "left",
             bin_col: str = "bin_start") -> DataFrame:
    """A1: mean of ``value`` per (bin, keys); only observed groups appear."""
    b = _binned(df, ts, minutes, offset_minutes, label, bin_col)
    aggs = [F.avg(value).alias(out)]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    return b.groupBy(bin_col, *keys).agg(*aggs)


def bin_count(df: DataFrame, ts: str, keys, minutes: int = 20, out: str = "volume",
              offset_minutes: int = 0, label: str = "left",
              bin_col: str = "bin_start") -> DataFrame:
    """A2/A3: row count per (bin, keys); any number of keys.

    A4 (shifted, right- or left-labelled bins) is the same call with
    ``offset_minutes`` and ``label``.
    """
    b = _binned(df, ts, minutes, offset_minutes, label, bin_col)
    return b.groupBy(bin_col, *keys).agg(F.count(F.lit(1)).alias(out))


def _minutes(ts: Column, kind: str) -> Column:
    """Whole minutes since 1970 of a time at a full minute."""
    if kind == "timestamp":
        return F.floor(F.unix_seconds(ts) / 60)
    return F.timestamp_diff("MINUTE", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def bin_count_augmented(df: DataFrame, ts: str, keys, shifts, minutes: int = 20,
                        out: str = "volume", bin_col: str = "bin_start") -> DataFrame:
    """A4 augmentation: the plain bins plus one shifted binning per
    ``(offset_minutes, label)`` pair, with a ``shift`` tag column.

    Rows are scanned and shuffled once, to counts on panes as wide as the
    common divisor of the width and all offsets; every pane lies in one bin of
    each shift, so its count is copied to that bin and added up.
    """
    wanted = [(0, "left"), *shifts]
    if any(label not in ("left", "right") for _, label in wanted):
        raise ValueError("label must be 'left' or 'right'")
    pane = gcd(minutes, *[abs(off) for off, _ in wanted])
    panes = bin_count(df, ts, keys, pane, "_n", bin_col="_pane")
    at = _minutes(F.col("_pane"), df.schema[ts].dataType.typeName())

    def start(off: int, label: str) -> Column:
        back = F.pmod(at - F.lit(off), F.lit(minutes)).cast("int") - F.lit(minutes if label == "right" else 0)
        return F.col("_pane") - F.make_dt_interval(F.lit(0), F.lit(0), back)

    copies = F.array(*[F.struct(start(off, label).alias(bin_col), F.lit(f"{off}/{label}").alias("shift"))
                       for off, label in wanted])
    return (panes.select(*keys, "_n", F.inline(copies)).groupBy(bin_col, *keys, "shift")
            .agg(F.sum("_n").alias(out)).select(bin_col, *keys, out, "shift"))
