"""Lag features.

``partition_by`` keys (default) gives per-series lags; an empty tuple gives
the positional shift over the whole table's order (the traffic job's
behaviour, where rows sorted by (bin, route) are shifted across routes).

The plan is ``sequence.ordered_scan``: no task ever holds a whole key, even
for a global order or a key with a third of the rows.  ``method="window"`` is
a parameter for keys that the caller knows to be many and small: the plain
``Window.partitionBy(keys)``, one shuffle and no join.  It refuses an empty
key list, which would be one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sequence import ordered_scan


def add_lags(df: DataFrame, value: str, k: int = 7, partition_by=(), order=("bin_start",),
             prefix: str = "lag", method: str = "scan", **buckets) -> DataFrame:
    """``buckets``: how the order is cut, see ``ordered_scan``."""
    names = {f"{prefix}{i}": (value, i) for i in range(1, k + 1)}
    if method == "window":
        if not partition_by:
            raise ValueError("method='window' needs keys; a global window is one task")
        w = Window.partitionBy(*partition_by).orderBy(*order)
        return df.withColumns({n: F.lag(F.col(v), i).over(w) for n, (v, i) in names.items()})
    if method != "scan":
        raise ValueError("method must be scan or window")
    return ordered_scan(df, list(partition_by), list(order), lags=names, **buckets)
