"""Dimension joins.

No broadcast hints on data-derived tables: AQE converts a join to a broadcast
at run time only when the shuffled side's measured size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``, and keeps the shuffle join
otherwise.  That is the size check; a hint would skip it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import bucket_date, hour_bucket


def dedupe_weather(weather: DataFrame, date_col: str = "date", hour_col: str = "hour"
                   ) -> DataFrame:
    """One row per (date, hour): repeated readings are averaged, so the join
    can never multiply fact rows."""
    measures = [c for c in weather.columns if c not in (date_col, hour_col)]
    return weather.groupBy(date_col, hour_col).agg(
        *[F.avg(F.col(f"`{m}`")).alias(m) for m in measures])


def weather_join(facts: DataFrame, weather: DataFrame, ts: str, date_col: str = "date",
                 hour_col: str = "hour", roll_date: bool = False, dedupe: bool = True
                 ) -> DataFrame:
    """Attach the 3-hourly reading of each fact's (date, hour bucket).

    The bucket is a per-row expression (``hour_bucket``); the join is a left
    equi join on (date, bucket), so facts without weather keep NULLs.
    """
    w = dedupe_weather(weather, date_col, hour_col) if dedupe else weather
    h = F.hour(F.col(ts))
    keyed = facts.withColumns({
        "_wdate": bucket_date(F.to_date(F.col(ts)), h, roll_date),
        "_whour": hour_bucket(h)})
    w = w.withColumnRenamed(date_col, "_wdate").withColumnRenamed(hour_col, "_whour")
    return keyed.join(w, ["_wdate", "_whour"], "left").drop("_wdate", "_whour")


def feature_join(facts: DataFrame, features: DataFrame, keys) -> DataFrame:
    """Left equi join of per-key features onto facts."""
    return facts.join(features, list(keys), "left")
