"""Traffic tables expressed over the driver's generic tables.

* trips / vehicle passes -> ``events`` (``ts``; key ``event_type`` or
  ``user_id``; measure ``value``)
* routes (comma list of links) -> one list per order: the order's part keys
  by line number
* links (length, lanes, neighbour lists) -> ``part``: length ``p_size``,
  lanes ``p_size % 4 + 1``, neighbour lists from the words of ``p_name`` /
  ``p_type`` (a multi-word name reads as a list with a comma)
* weather (3-hourly readings) -> a 3-hourly aggregate of all events; readings
  with a number of events divisible by seven carry the sentinel as wind speed

Each function reads the driver tables, so its work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import hour_bucket
from ..operators.repair import WIND_SENTINEL
from ..sources.tables import table

EVENTS_SPLIT = "2024-01-16"  # train rows before, test rows from this date


def events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events")


def routes(spark: SparkSession, d: str, orders: DataFrame | None = None) -> DataFrame:
    """(o_orderkey, link_seq): the order's part keys as a comma list; of ``orders`` (l_orderkey), if
    given: lines of others are dropped before they are put together."""
    li = table(spark, d, "lineitem")
    li = li if orders is None else li.join(orders, "l_orderkey", "left_semi")
    arr = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey")))
    return li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.array_join(F.transform(arr, lambda x: x["l_partkey"].cast("string")), ",")
        .alias("link_seq"))


def links(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("link_id"),
        F.col("p_size").alias("length"),
        (F.pmod(F.col("p_size"), F.lit(4)) + 1).alias("lanes"),
        F.translate(F.col("p_name"), " ", ",").alias("in_top"),
        F.translate(F.col("p_type"), " ", ",").alias("out_top"))


def weather(spark: SparkSession, d: str) -> DataFrame:
    """(date, hour, temperature, wind_speed, n_obs) from all events."""
    n = F.count(F.lit(1))
    return events(spark, d).groupBy(F.to_date("ts").alias("date"),
                                    hour_bucket(F.hour("ts")).alias("hour")).agg(
        F.avg("value").alias("temperature"),
        F.when(n % 7 == 0, F.lit(WIND_SENTINEL)).otherwise(F.max("value")).alias("wind_speed"),
        n.alias("n_obs"))
