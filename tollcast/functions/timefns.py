"""Time arithmetic and window labels.

All timestamps are ``timestamp_ntz``: wall-clock values with no session time
zone applied.  Texts come from the cast of such a value, never from
``date_format``, which reads it as an instant of the session's zone; so bins and
labels do not move with ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed text format of timestamps in window labels and CSV files.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_ts(col, fmt: str = TS_FORMAT) -> Column:
    """text -> timestamp_ntz."""
    return F.to_timestamp_ntz(_c(col), F.lit(fmt))


def parse_date(col, fmt: str = DATE_FORMAT) -> Column:
    """text or timestamp -> date."""
    c = _c(col)
    return F.to_date(c, fmt) if fmt else F.to_date(c)


def interval(hours: int = 0, minutes: int = 0, seconds: int = 0) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(hours), F.lit(minutes), F.lit(seconds))


def shift(col, hours: int = 0, minutes: int = 0) -> Column:
    """add (or, with negative numbers, subtract) hours and minutes."""
    return _c(col) + interval(hours, minutes)


def bin_start(col, minutes: int = 20, offset_minutes: int = 0) -> Column:
    """floor a timestamp to a fixed-width bin, optionally shifted by an offset.

    Bins are aligned to the epoch (every 20-minute bin starts at :00, :20, :40),
    like a time grouper with the same frequency.
    """
    # an offset only matters modulo the width (a 55-minute base on 20-minute
    # bins is the 15-minute grid), and the window function wants it below it
    w = F.window(_c(col), f"{minutes} minutes", f"{minutes} minutes",
                 f"{offset_minutes % minutes} minutes")
    return w.start


def fmt_ts(col) -> Column:
    """timestamp -> ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.substring(_c(col).cast("string"), 1, 19)


def window_label(start, minutes: int = 20) -> Column:
    """``[start,end)`` label of a bin, end = start + width."""
    s = _c(start)
    return F.concat(F.lit("["), fmt_ts(s), F.lit(","), fmt_ts(shift(s, minutes=minutes)),
                    F.lit(")"))


def parse_window_start(label) -> Column:
    """start timestamp of a ``[start,end)`` label (split on comma, strip bracket)."""
    first = F.substring_index(_c(label), ",", 1)
    return parse_ts(F.substring(first, 2, 19))
