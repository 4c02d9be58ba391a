"""Route features from link lists.

A route is a comma list of link ids.  The list is exploded (with position),
joined to link attributes and reduced in ONE ``groupBy`` with conditional
aggregates, instead of a chain of one-column aggregates glued by joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lists import explode_list, has_many

LANE_CLASSES = (1, 2, 3, 4)


def link_flags(links: DataFrame, in_col: str = "in_top", out_col: str = "out_top",
               crsin: str = "crsin", crsout: str = "crsout") -> DataFrame:
    """1 if a link has more than one incoming / outgoing neighbour."""
    return links.withColumns({crsin: has_many(in_col), crsout: has_many(out_col)})


def route_links(routes: DataFrame, links: DataFrame, route_keys, seq_col: str = "link_seq",
                link_key: str = "link_id", pos_col: str = "pos") -> DataFrame:
    """One row per (route, position, link) with the link's attributes."""
    exploded = explode_list(routes.select(*route_keys, seq_col), seq_col, link_key, pos_col)
    return exploded.join(links, link_key, "left")


def route_features(rl: DataFrame, route_keys, length: str = "length", lanes: str = "lanes",
                   crsin: str = "crsin", crsout: str = "crsout",
                   lane_classes=LANE_CLASSES) -> DataFrame:
    """Per route: crossing counts, total length, link count and
    length/count per lane class, all from one aggregation.  Absent classes
    give 0 (not NULL)."""
    aggs = [
        F.coalesce(F.sum(crsin), F.lit(0)).cast("bigint").alias("inlink_crscount"),
        F.coalesce(F.sum(crsout), F.lit(0)).cast("bigint").alias("outlink_crscount"),
        F.coalesce(F.sum(length), F.lit(0)).alias("length"),
        F.count(F.lit(1)).alias("linkcnt"),
    ]
    for n in lane_classes:
        hit = F.col(lanes) == F.lit(n)
        aggs.append(F.coalesce(F.sum(F.when(hit, F.col(length))), F.lit(0)).alias(f"lane{n}_length"))
    for n in lane_classes:
        hit = F.col(lanes) == F.lit(n)
        aggs.append(F.count(F.when(hit, F.lit(1))).alias(f"lane{n}_count"))
    return rl.groupBy(*route_keys).agg(*aggs)
