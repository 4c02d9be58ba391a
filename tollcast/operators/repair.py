"""Sequential value repair.

A NULL or NaN is a missing reading: it stays as it is and is passed over, so
"previous" and "next" mean the nearest readings that are there.

Outlier repair (W2), per key in ``order``, threshold ``T``:

* ``x <= T``: kept.
* ``x > T`` and the previous *repaired* value ``y' < T``: ``(y' + next raw) / 2``.
* ``x > T`` and ``y' >= T``: ``y'`` (sticky).
* a leading run of outliers (no good row before it in the key) is kept;
  an outlier with no next row copies ``y'``.

The recurrence only reaches back to the last good row ("anchor"), so the key
splits into islands (anchor + following outliers).  Anchors and positions in
the island come from the balanced scan.  Inside a run every next value is
above T, so as long as the repaired value is below T its distance to T at
least halves with each step.  Doubles span fewer than ``FOLD_STEPS`` halvings,
hence a finite start has reached T by then and stays: the first positions of
an island, folded with ``aggregate``, decide all others.  The one start that
cannot halve its distance, minus infinity, has a form of its own: it stays
until a next value of plus infinity makes it NaN.

Every row goes through one join and keeps its place (with ``stage``, only the
outliers are joined); NULL keys are keys.

Sentinel repair (W5) has a closed form: with ``p`` the last non-sentinel
before the row, ``q`` the first after and ``n`` the next raw value,
sentinel rows become ``(p + n) / 2`` when ``n`` is not a sentinel, else ``p``;
a run with only one side uses that side.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequence import ordered_scan

# Fixed values of the traffic job: travel-time outlier threshold (seconds) and
# the wind-direction sentinel.
TRAVEL_TIME_THRESHOLD = 600.0
WIND_SENTINEL = 999017.0

# Halvings from the greatest distance of two doubles down to below the least one.
FOLD_STEPS = (sys.float_info.max_exp + 1) - (sys.float_info.min_exp - sys.float_info.mant_dig) + 2


def present(x: Column) -> Column:
    """The reading, NULL where it is missing (NULL or NaN)."""
    x = x.cast("double")
    return F.when(~F.isnan(x), x)


def sentinel_repair(df: DataFrame, col: str, sentinel: float = WIND_SENTINEL, keys=(),
                    order=(), out: str | None = None, **buckets) -> DataFrame:
    """``buckets``: how the order is cut, see ``ordered_scan``."""
    out = out or col
    x = F.col(col)
    there = present(x)
    scanned = ordered_scan(
        df.withColumns({"_x": there, "_good": F.when(there != F.lit(sentinel), there)}),
        list(keys), list(order), ffill={"_p": ("_good", False)},
        bfill={"_q": ("_good", False), "_next": ("_x", False)}, **buckets)
    p, q, n = F.col("_p"), F.col("_q"), F.col("_next")
    fixed = (F.when(F.col("_x").isNull() | (F.col("_x") != F.lit(sentinel)), x)
             .when(p.isNull() & q.isNull(), x)
             .when(p.isNull(), q)
             .when(q.isNull(), p)
             .when(n != F.lit(sentinel), (p + n) / 2.0)
             .otherwise(p))
    return scanned.withColumn(out, fixed).drop("_x", "_good", "_p", "_q", "_next")


def _fold_island(arr, a0, threshold: float):
    """ys for the first outliers of one island, appended until the value sticks."""
    t = F.lit(threshold)
    init = F.struct(F.array().cast("array<double>").alias("ys"), a0.alias("cur"))

    def step(acc, e):
        nxt = e["n"]
        y = F.when(nxt.isNull(), acc["cur"]).otherwise((acc["cur"] + nxt) / 2.0)
        grow = F.struct(F.concat(acc["ys"], F.array(y)).alias("ys"), y.alias("cur"))
        return F.when(acc["cur"] >= t, acc).otherwise(grow)

    return F.aggregate(arr, init, step)


def outlier_repair(df: DataFrame, col: str, threshold: float = TRAVEL_TIME_THRESHOLD,
                   keys=(), order=(), out: str | None = None, passes: int = 1,
                   stage: Callable[[DataFrame], DataFrame] | None = None, **buckets) -> DataFrame:
    """W2 (``passes=1``) and W3 (``passes=2``: the repair applied again to its output).

    ``stage`` writes the scanned rows and reads them back: the scan then runs
    once, and only the outliers are joined with their islands.
    ``buckets``: how the order is cut, see ``ordered_scan``.
    """
    out = out or col
    cur = df if out == col else df.withColumn(out, F.col(col))
    return _repair(cur, out, threshold, list(keys), list(order), passes, stage, buckets)


def _again(folded: DataFrame, threshold: float) -> DataFrame:
    """One more pass over the islands, on their repaired values.

    After a pass an island's values lie below T up to the place where they
    stick, and are ``cur`` from there on.  If ``cur`` is above T, that rest is
    the next pass's run: it starts from the value before it, its next values
    are ``cur``, and the last one's is what follows the island.
    """
    ys, cur, last = F.col("_f")["ys"], F.col("_f")["cur"], F.col("_last")
    stuck = F.size(ys)
    places = F.sequence(stuck.cast("long"), F.greatest(F.least(last, stuck + F.lit(FOLD_STEPS)), stuck.cast("long")))
    nexts = F.transform(places, lambda j: F.struct(j.alias("p"), F.when(j < last, cur).otherwise(F.col("_after")).alias("n")))
    start = F.when(stuck > 1, F.element_at(ys, F.greatest(stuck - 1, F.lit(1)))).otherwise(F.col("_start"))
    rest = folded.withColumn("_rest", F.when(cur > F.lit(threshold), _fold_island(nexts, start, threshold)))
    new = F.struct(F.concat(F.slice(ys, F.lit(1), F.greatest(stuck - 1, F.lit(0))), F.col("_rest")["ys"]).alias("ys"),
                   F.col("_rest")["cur"].alias("cur"))
    return rest.withColumn("_f", F.when(F.col("_rest").isNotNull(), new).otherwise(F.col("_f"))).drop("_rest")


def _repair(df: DataFrame, col: str, threshold: float, keys, order, passes: int, stage, buckets) -> DataFrame:
    """All passes in one scan: a pass changes values inside islands only, so they are the same for each."""
    cols = df.columns
    there, t = present(F.col(col)), F.lit(threshold)
    good = F.coalesce(there <= t, F.lit(False))
    base = df.withColumns({"_x": there, "_mark": good, "_av": F.when(good, there),
                           "_ao": F.when(good, F.struct(*[F.col(c) for c in order]))})
    s = ordered_scan(base, keys, order, ffill={"_a0": ("_av", True), "_isle": ("_ao", True)},
                     bfill={"_next": ("_x", False)}, since={"_pos": ("_mark", "_x")}, **buckets)
    s = s.withColumn("_fix", F.coalesce((F.col("_x") > t) & F.col("_isle").isNotNull(), F.lit(False)))
    s = stage(s.drop("_x", "_mark", "_av", "_ao")) if stage else s
    s = s.withColumn("_in", F.struct(*[F.col(k) for k in keys], F.col("_isle")))
    pos, nxt = F.col("_pos"), F.col("_next")
    first = F.when(pos <= FOLD_STEPS, F.struct(pos.alias("p"), nxt.alias("n")))
    islands = s.filter("_fix").groupBy("_in").agg(
        F.first("_a0").alias("_start"), F.sort_array(F.collect_list(first)).alias("_xs"),
        F.min(F.when(nxt == F.lit(float("inf")), pos)).alias("_inf"),
        F.max(pos).alias("_last"), F.max_by(nxt, pos).alias("_after"))
    folded = islands.select("_in", "_start", "_inf", "_last", "_after", _fold_island(
        F.col("_xs"), F.col("_start"), threshold).alias("_f"))
    for _ in range(passes - 1):
        folded = _again(folded, threshold)
    rows = s.filter("_fix") if stage else s
    j = rows.join(folded.select("_in", "_start", "_inf", "_f"), "_in", "left")
    ys = F.col("_f")["ys"]
    steps = F.when(pos <= F.size(ys), F.element_at(ys, F.greatest(pos, F.lit(1)).cast("int"))).otherwise(
        F.col("_f")["cur"])
    low = F.lit(float("-inf"))
    y = F.when(F.col("_start") > low, steps).when(pos >= F.col("_inf"), F.lit(float("nan"))).otherwise(low)
    fixed = j.select(*[(F.when(F.col("_fix"), y).otherwise(F.col(f"`{c}`")) if c == col
                        else F.col(f"`{c}`")).alias(c) for c in cols])
    return fixed.unionByName(s.filter(~F.col("_fix")).select(*[F.col(f"`{c}`") for c in cols])) if stage else fixed
