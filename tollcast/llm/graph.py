"""Connected components of an edge table by alternating star contractions.

Each round is two joins and two aggregates on the edges; a round's edges are
written to the shared checkpoint folder.  Large stars hang a node's greater
neighbours on its smallest one, small stars its smaller ones; the rounds end
when the edges no longer change, and every node then points at the smallest
of its component.  A hub's edges are aggregated before they are shuffled, and
they meet the hub's smallest neighbour in ``SALTS`` parts, so no task holds
them all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


SALTS = 16


def _beside(edges: DataFrame, low: DataFrame) -> DataFrame:
    """``edges`` with m, the row of ``low`` for their node a, dealt out by a and a part of b."""
    dealt = edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    copies = low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(copies.withColumnRenamed("n", "a"), ["a", "salt"]).drop("salt")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    low = low.select("n", F.least("n", "m").alias("m"))
    return (_beside(both.filter("b > a"), low)
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    moved = (_beside(down, low).filter("b <> m")
             .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return moved.unionAll(low.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with an edge; component is the smallest node."""
    cur = written(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
                  .distinct(), "edges")
    sign = None
    while True:
        cur = written(_small_star(_large_star(cur)), "stars")
        now = tuple(cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40)),
                            F.sum(F.col("b") % (1 << 40))).first())
        if now == sign or now[0] == 0:
            break
        sign = now
    nodes = cur.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionAll(cur.select(F.col("b").alias("node"), F.col("b").alias("component"))
                          .distinct())
