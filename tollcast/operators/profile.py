"""Column profile and correlation matrix.

Exact quartiles never gather a column into one buffer: all columns are
unpivoted into (column, value) rows and counted per distinct value, with
partial counts in every task, so a frequent value is one row before anything
is sorted; the distinct values get a weighted dense position by the balanced
range-partitioned sequence, and only those at the needed ranks are kept.
``exact=False`` uses ``percentile_approx`` (bounded sketch per task).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sequence import add_sequence

QUANTILES = (0.25, 0.5, 0.75)


def _long(df: DataFrame, cols) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("col_name"),
                               F.col(f"`{c}`").cast("double").alias("val")) for c in cols])
    return df.select(F.inline(pairs)).filter(F.col("val").isNotNull())


def profile(df: DataFrame, cols, exact: bool = True, quantiles=QUANTILES,
            num_partitions: int | None = None) -> DataFrame:
    """One row per column: count, mean, std (sample), min, quartiles, max.

    Quantiles interpolate linearly between the two nearest ranks.
    """
    long = _long(df, cols)
    qnames = [f"q{int(round(q * 100))}" for q in quantiles]
    base = long.groupBy("col_name").agg(
        F.count("val").alias("count"), F.avg("val").alias("mean"),
        F.stddev_samp("val").alias("std"), F.min("val").alias("min"),
        F.max("val").alias("max"))
    if not exact:
        approx = long.groupBy("col_name").agg(
            F.percentile_approx("val", list(quantiles), 100000).alias("_q"))
        approx = approx.select("col_name", *[F.col("_q")[i].alias(n)
                                             for i, n in enumerate(qnames)])
        return base.join(approx, "col_name")
    counts = long.groupBy("col_name", "val").agg(F.count(F.lit(1)).alias("_times"))
    ranked = add_sequence(counts, ["col_name", "val"], num_partitions, seq_col="_pos", weight="_times")
    # per-column first position and size: one row per column (schema-bounded)
    firsts = ranked.groupBy("col_name").agg(F.min("_pos").alias("_first"),
                                            F.sum("_times").alias("_n"))
    # a value holds the ranks from _rank to _rank + _times - 1
    r = ranked.join(F.broadcast(firsts), "col_name").withColumn(
        "_rank", F.col("_pos") - F.col("_first"))

    def holds(rank):
        return (F.col("_rank") <= rank) & (rank < F.col("_rank") + F.col("_times"))

    need = F.lit(False)
    for q in quantiles:
        pos = F.lit(q) * (F.col("_n") - 1)
        need = need | holds(F.floor(pos)) | holds(F.ceil(pos))
    picked = r.filter(need)
    qaggs = []
    for q, name in zip(quantiles, qnames):
        pos = F.lit(q) * (F.col("_n") - 1)
        lo = F.max(F.when(holds(F.floor(pos)), F.col("val")))
        hi = F.max(F.when(holds(F.ceil(pos)), F.col("val")))
        frac = F.first(pos - F.floor(pos))
        qaggs.append((lo + frac * (hi - lo)).alias(name))
    qs = picked.groupBy("col_name").agg(*qaggs)
    return base.join(qs, "col_name")


#: What a task tells of a pair of columns.
_MOMENTS = "i int, j int, n double, sx double, sy double, cxx double, cyy double, cxy double"


def _pair_moments(k: int):
    """Per task, for each pair of columns: rows where both are there, sums, and centred products.

    Arrays are matrix products over Arrow batches, shifted by the task's first
    batch means; what a task returns is ``k * k`` rows, whatever it read.
    """
    def run(batches):
        total, shift = None, None
        for pdf in batches:
            x = pdf.to_numpy(dtype=float, na_value=np.nan)
            there = ~np.isnan(x)
            if shift is None and len(x):
                n = there.sum(axis=0)
                shift = np.where(n > 0, np.where(there, x, 0.0).sum(axis=0) / np.maximum(n, 1), 0.0)
            if not len(x):
                continue
            m, x = there.astype(float), np.where(there, x - shift, 0.0)
            part = np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
            total = part if total is None else total + part
        if total is None:
            return
        n, s, q, c = total  # s[i, j]: sum of column i over the pair's rows, q: of its squares
        some = np.maximum(n, 1)
        i, j = np.divmod(np.arange(k * k), k)
        yield pd.DataFrame({
            "i": i, "j": j, "n": n.ravel(), "sx": (s + n * shift[:, None]).ravel(),
            "sy": (s.T + n * shift[None, :]).ravel(), "cxx": (q - s * s / some).ravel(),
            "cyy": (q.T - s.T * s.T / some).ravel(), "cxy": (c - s * s.T / some).ravel()})
    return run


def pair_moments(df: DataFrame, cols) -> DataFrame:
    """(i, j, n, sx, sy, xx, yy, xy) for every ordered pair of columns, over the rows where both
    are there: row count, sums, and centred sums of squares and products.

    One pass over the data for any number of columns: tasks return the moments
    of all pairs, which are added up in one small aggregate.
    """
    cols = list(cols)
    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    return _added_moments(numbers.mapInPandas(_pair_moments(len(cols)), _MOMENTS))


def _array_moments():
    """``_pair_moments`` of arrays of equal length without missing values: rows of a matrix as they come."""
    def run(batches):
        n, total, shift, k = 0, None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
            if shift is None:
                shift, k = x.mean(axis=0), x.shape[1]
                total = np.zeros((k + 1, k))
            x = x - shift
            n, total = n + len(x), total + np.vstack([x.sum(axis=0), x.T @ x])
        if not n:
            return
        s, c = total[0], total[1:] - np.outer(total[0], total[0]) / n
        i, j = np.divmod(np.arange(k * k), k)
        own, sums = np.diag(c), s + n * shift
        out = pd.DataFrame({"i": i, "j": j, "n": float(n), "sx": sums[i], "sy": sums[j],
                            "cxx": own[i], "cyy": own[j], "cxy": c.ravel()}).astype({"i": "int32", "j": "int32"})
        yield pa.RecordBatch.from_pandas(out, preserve_index=False)
    return run


def array_moments(df: DataFrame, values: Column) -> DataFrame:
    """``pair_moments`` of the places of an array of doubles, equally long in all rows and without NULLs."""
    return _added_moments(df.select(values.alias("x")).mapInArrow(_array_moments(), _MOMENTS))


def _added_moments(parts: DataFrame) -> DataFrame:
    """The moments of all tasks as one."""
    parts = parts.filter("n > 0")
    pair = Window.partitionBy("i", "j")  # a row a task
    parts = parts.withColumns({f"m{a}": F.col(f"s{a}") / F.col("n") - F.sum(f"s{a}").over(pair) / F.sum("n").over(pair)
                               for a in "xy"})

    def spread(a: str, b: str):  # within the tasks, and between their means
        return F.sum(F.col(f"c{a}{b}") + F.col("n") * F.col(f"m{a}") * F.col(f"m{b}")).alias(f"{a}{b}")

    return parts.groupBy("i", "j").agg(
        F.sum("n").alias("n"), F.sum("sx").alias("sx"), F.sum("sy").alias("sy"), spread("x", "x"), spread("y", "y"),
        spread("x", "y"), F.max(F.abs("sx")).alias("largest_x"), F.max(F.abs("sy")).alias("largest_y"))


def corr_matrix(df: DataFrame, cols, by_pairs: bool = True) -> DataFrame:
    """Pearson correlation of every ordered column pair (pairwise-complete
    rows; NULL without variance), as (col_a, col_b, corr).

    One pass in both forms: ``by_pairs`` is one aggregate of built-in variances
    and covariances, for up to some dozen columns; otherwise tasks return the
    moments of all pairs from matrix products, for many columns.
    """
    cols = list(cols)
    if by_pairs:
        pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
        def corr_of(a: str, b: str):
            x, y = F.col(f"`{a}`").cast("double"), F.col(f"`{b}`").cast("double")
            there = x.isNotNull() & y.isNotNull()
            r = F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(F.when(there, x)) * F.var_pop(F.when(there, y))))
            # greatest and least pass over NULLs
            return F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))

        aggs = [corr_of(a, b).alias(f"r{k}") for k, (a, b) in enumerate(pairs)]
        rows = [F.struct(F.lit(x).alias("col_a"), F.lit(y).alias("col_b"), F.col(f"r{k}").alias("corr"))
                for k, (a, b) in enumerate(pairs) for x, y in ({(a, b), (b, a)})]
        return df.agg(*aggs).select(F.inline(F.array(*rows)))
    sums = pair_moments(df, cols)
    flat = F.lit(1e-24)  # rounding of the sums, not variance
    varies = (F.col("xx") > flat * F.col("largest_x") * F.col("largest_x")) & \
        (F.col("yy") > flat * F.col("largest_y") * F.col("largest_y"))
    names = F.array(*[F.lit(c) for c in cols])
    corr = F.when(varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("xy") / F.sqrt(F.col("xx") * F.col("yy")))))
    return sums.select(F.element_at(names, F.col("i") + 1).alias("col_a"),
                       F.element_at(names, F.col("j") + 1).alias("col_b"), corr.alias("corr"))
