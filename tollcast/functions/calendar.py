"""Calendar features (F2, F5-F10): weekday, hour and minute parts, fixed-domain
dummies, the 3-hour weather bucket and the holiday flag.

All are column expressions (whole-stage codegen, no Python); the holiday
flag can also go through its generated date table with a bounded broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .timefns import _c

# Weekday names as produced by the "EEEE" pattern, Monday first.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# The minute dummies of 20-minute bins.
BIN_MINUTES = [0, 20, 40]

# Holiday date ranges (inclusive) of the traffic task:
# 2016-09-15..2016-09-17 and 2016-10-01..2016-10-07.
HOLIDAY_RANGES = [("2016-09-15", "2016-09-17"), ("2016-10-01", "2016-10-07")]


def weekday_name(ts) -> Column:
    """weekday name, e.g. ``Tuesday``."""
    return F.date_format(_c(ts), "EEEE")


def calendar_parts(df: DataFrame, ts: str, prefix: str = "") -> DataFrame:
    """Date, weekday name, hour and minute of ``ts``."""
    t = F.col(ts)
    return df.withColumns({
        f"{prefix}date": F.to_date(t),
        f"{prefix}weekday": weekday_name(t),
        f"{prefix}hour": F.hour(t).cast("int"),
        f"{prefix}minute": F.minute(t).cast("int"),
    })


def dummies(df: DataFrame, ts: str, weekdays: bool = True, hours: bool = True,
            minutes: list[int] | None = None, hour_prefix: str = "hour__",
            minute_prefix: str = "minute_") -> DataFrame:
    """0/1 flags over fixed domains, added on the same row (no join).

    A fixed domain (7 weekdays, 24 hours, the bin minutes) keeps the schema
    independent of the data, so train and test frames always agree.
    """
    t = F.col(ts)
    cols: dict[str, Column] = {}
    if weekdays:
        wd = weekday_name(t)
        for d in WEEKDAYS:
            cols[d] = (wd == F.lit(d)).cast("int")
    if hours:
        h = F.hour(t)
        for i in range(24):
            cols[f"{hour_prefix}{i}"] = (h == F.lit(i)).cast("int")
    mins = BIN_MINUTES if minutes is None else minutes
    if mins:
        m = F.minute(t)
        for v in mins:
            cols[f"{minute_prefix}{v}"] = (m == F.lit(v)).cast("int")
    return df.withColumns(cols)


def hour_bucket(hour) -> Column:
    """3-hour weather bucket: 23,0,1 -> 0; 2,3,4 -> 3; ...; 20,21,22 -> 21."""
    h = _c(hour)
    return (F.floor(F.pmod(h + 1, F.lit(24)) / 3) * 3).cast("int")


def bucket_date(date_col, hour, roll_date: bool = False) -> Column:
    """Date that goes with ``hour_bucket``.

    By default hour 23 keeps its own date (bucket 0 of the same day, as the
    traffic job does); ``roll_date=True`` moves it to the next day's bucket 0.
    """
    d = _c(date_col)
    if not roll_date:
        return d
    return F.when(_c(hour) == 23, F.date_add(d, 1)).otherwise(d)


def is_holiday(date_col, ranges=HOLIDAY_RANGES) -> Column:
    """F8: 1 if the date falls in any inclusive range, else 0 (a literal
    disjunction: no join, no shuffle)."""
    d = _c(date_col)
    cond = F.lit(False)
    for lo, hi in ranges:
        cond = cond | d.between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
    return F.coalesce(cond, F.lit(False)).cast("int")


def holiday_dates(spark: SparkSession, ranges=HOLIDAY_RANGES) -> DataFrame:
    """The date table of the ranges (``sequence`` + ``explode``, then union).

    Its size is the number of days in the ranges, fixed by the parameters.
    """
    out = None
    for lo, hi in ranges:
        part = spark.range(1).select(F.explode(F.sequence(
            F.lit(lo).cast("date"), F.lit(hi).cast("date"),
            F.expr("INTERVAL 1 DAY"))).alias("date"))
        out = part if out is None else out.unionByName(part)
    return out


def holiday_flag_by_table(df: DataFrame, date_col: str, ranges=HOLIDAY_RANGES,
                          out: str = "is_holiday") -> DataFrame:
    """F8 through the F7 date table: left join on the date.  The table has one
    row per day of the ranges (a bound fixed by the parameters), so it is
    broadcast; the fact side is never shuffled."""
    days = holiday_dates(df.sparkSession, ranges).distinct().withColumn("_hol", F.lit(1))
    days = days.withColumnRenamed("date", "_hday")
    joined = df.join(F.broadcast(days), F.col(date_col) == F.col("_hday"), "left")
    return joined.withColumn(out, F.coalesce(F.col("_hol"), F.lit(0))).drop("_hday", "_hol")
