"""Expected-window grids, gap fill and imputation.

The expected grid is generated per key with ``sequence`` + ``explode`` between
a start and an end (the key's own first and last bin, or fixed bounds), or is
every key of a given table with every window of a given list: no cross join.
Missing windows are an anti join of the grid with the observed bins.  Gap fill
walks back to the last filled value of the same key with the balanced scan of
``sequence.ordered_scan``; filled rows are produced in one union, not appended
one at a time.

A window is missing if no row was observed for it; an observed row whose value
is NULL is observed.  NULL keys are keys: joins compare key structs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefns import interval
from .sequence import ordered_scan


GRID_CHUNK = 1024


def expected_grid(observed: DataFrame, keys, bin_col: str = "bin_start", minutes: int = 20,
                  start=None, end=None, hours=None) -> DataFrame:
    """(keys, bin) for every bin from ``start`` to ``end`` inclusive per key.

    ``start``/``end`` default to the key's first and last observed bin; pass
    timestamp strings to use fixed bounds (e.g. a forecast horizon).
    ``hours`` keeps only bins starting in those hours of the day (e.g. the
    blocks before the forecast windows).
    """
    lo = F.min(bin_col) if start is None else F.lit(start).cast("timestamp_ntz")
    hi = F.max(bin_col) if end is None else F.lit(end).cast("timestamp_ntz")
    bounds = observed.groupBy(*keys).agg(lo.alias("_lo"), hi.alias("_hi"))
    # two levels, so no generated array exceeds GRID_CHUNK elements however
    # long a key lives: chunk starts first, then the windows of each chunk
    step = interval(minutes=minutes)
    chunks = bounds.select(*keys, "_hi", F.explode(F.sequence(
        "_lo", "_hi", interval(minutes=minutes * GRID_CHUNK))).alias("_c"))
    last = F.least(F.col("_c") + interval(minutes=minutes * (GRID_CHUNK - 1)), F.col("_hi"))
    grid = chunks.select(*keys, F.explode(F.sequence("_c", last, step)).alias(bin_col))
    if hours is not None:
        grid = grid.filter(F.hour(bin_col).isin(list(hours)))
    return grid


def listed_grid(key_table: DataFrame, keys, windows, bin_col: str = "bin_start",
                position_col: str = "position") -> DataFrame:
    """Every key of ``key_table`` with every window of a list, in the list's order.

    ``windows``: timestamp texts (a parameter, not data); ``position_col`` is
    a window's place in the list.  A key without any observation is there too.
    """
    listed = F.array(*[F.lit(w).cast("timestamp_ntz") for w in windows])
    return key_table.select(*keys).distinct().select(
        *keys, F.posexplode(listed).alias(position_col, bin_col))


def _identity(keys, bin_col: str) -> Column:
    return F.struct(*[F.col(k) for k in [*keys, bin_col]])


def missing_windows(observed: DataFrame, keys, bin_col: str = "bin_start", minutes: int = 20,
                    start=None, end=None, hours=None, grid: DataFrame | None = None) -> DataFrame:
    """Grid rows with no observation (left anti join)."""
    if grid is None:
        grid = expected_grid(observed, keys, bin_col, minutes, start, end, hours)
    seen = observed.select(_identity(keys, bin_col).alias("_id"))
    return grid.withColumn("_id", _identity(keys, bin_col)).join(seen, "_id", "left_anti").drop("_id")


def locf_fill(observed: DataFrame, keys, value: str, bin_col: str = "bin_start",
              minutes: int = 20, start=None, end=None, order=None, hours=None,
              filled_col: str = "filled", grid: DataFrame | None = None, method: str = "scan",
              **buckets) -> DataFrame:
    """All observed rows as they are, plus one row per expected window with
    no observation, valued with the last value found walking back over the
    expected windows of the same key (NULL if none).

    ``grid`` gives the expected windows (default ``expected_grid``); ``order``
    is the walk-back order over its rows (default: time), e.g. the position
    column of ``listed_grid`` for all mornings, then all afternoons.
    ``buckets``: how that order is cut, see ``ordered_scan``.
    ``method="window"`` is for keys known to be small, in time order: observed
    and expected rows meet in one window per key, by one shuffle and no join.
    """
    if method not in ("scan", "window"):
        raise ValueError("method must be scan or window")
    if method == "window" and (order or not keys):
        raise ValueError("method='window' walks back in time, and needs keys; a global window is one task")
    if grid is None:
        grid = expected_grid(observed, keys, bin_col, minutes, start, end, hours)
    if method == "window":
        return _fill_by_window(observed, grid, list(keys), value, bin_col, filled_col)
    seen = observed.select(_identity(keys, bin_col).alias("_id"), F.col(value).alias("_v"),
                           F.lit(1).alias("_seen"))
    joined = grid.withColumn("_id", _identity(keys, bin_col)).join(seen, "_id", "left").drop("_id")
    walked = ordered_scan(joined, list(keys), list(order) if order else [bin_col],
                          ffill={"_last": ("_v", True)}, **buckets)
    fills = (walked.filter(F.col("_seen").isNull()).withColumn(value, F.col("_last"))
             .withColumn(filled_col, F.lit(1)).drop("_v", "_seen", "_last"))
    # other columns of either side are NULL in the rows of the other
    return observed.withColumn(filled_col, F.lit(0)).unionByName(fills, allowMissingColumns=True)


def _fill_by_window(observed: DataFrame, grid: DataFrame, keys, value: str, bin_col: str,
                    filled_col: str) -> DataFrame:
    """``locf_fill`` where a task may hold a whole key: an expected row comes after the
    observed rows of its window, and takes the value of the last expected one that has any."""
    rows = observed.withColumn(filled_col, F.lit(0)).unionByName(
        grid.withColumn(filled_col, F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(bin_col, filled_col, value).rowsBetween(Window.unboundedPreceding, 0)
    expected = F.col(filled_col) == 1
    here = F.struct(F.col(bin_col).alias("b"))
    rows = rows.withColumn("_near", F.last(F.when(~expected, F.struct(here.alias("at"), F.col(value).alias("v"))),
                                           ignorenulls=True).over(w))
    rows = rows.withColumn("_seen", expected & F.col("_near").isNotNull() & F.col("_near")["at"].eqNullSafe(here))
    rows = rows.withColumn("_last", F.last(F.when(F.col("_seen"), F.col("_near")["v"]), ignorenulls=True).over(w))
    return (rows.filter(~F.col("_seen")).withColumn(value, F.when(expected, F.col("_last")).otherwise(F.col(value)))
            .drop("_near", "_seen", "_last"))


def zero_impute(df: DataFrame, cols=None) -> DataFrame:
    """NULL -> 0 in the given (default: all numeric) columns."""
    return df.fillna(0, subset=list(cols) if cols else None)


def column_means(df: DataFrame, cols) -> DataFrame:
    """A10: one row of the columns' means, as doubles, from one distributed aggregate."""
    return df.agg(*[F.avg(F.col(f"`{c}`")).cast("double").alias(c) for c in cols])


def mean_impute(df: DataFrame, cols, fit: DataFrame | None = None) -> DataFrame:
    """NULL -> column mean.

    Means come from ``fit`` (e.g. the training frame) or, by default, from
    ``df`` itself.  Every named column becomes double, whatever it holds; one
    without any value stays NULL.
    """
    cols = list(cols)
    return apply_means(df, column_means(fit if fit is not None else df, cols), cols)


def apply_means(df: DataFrame, means: DataFrame, cols) -> DataFrame:
    """Fill NULLs with the means of a one-row frame (columns become double).

    The means are a scalar subquery of the plan: nothing runs before the action.
    """
    present = [c for c in cols if c in df.columns]
    if not present:
        return df
    row = means.select(F.struct(*[F.col(f"`{c}`") for c in present])).scalar()
    # one column, named once: every mention of the subquery would be a plan of its own
    held = df.withColumn("_means", row)
    return held.select(*[
        (F.coalesce(F.col(f"`{c}`").cast("double"), F.col("_means").getField(c)) if c in present
         else F.col(f"`{c}`")).alias(c) for c in df.columns])
