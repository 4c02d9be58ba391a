"""Interaction audit of document filters by relations of failing ids.

Every filter leaves one table of the ids of the rows that fail it.  What a
filter does after others depends on the set of these others only, so each set
of filters (a *prefix*, 2^k of them) is joined once, as a column beside the
id: the rows left by a prefix are those without a partner (left-anti join)
among the failing ids of its filters, a filter's removals after the prefix are
its failing ids without such a partner, its redundancies those with one
(left-semi join).  All joins are on the id alone, so the rows are dealt out by
it once, narrow and before prefixes multiply them, and an id meets at most as
many failing rows as there are filters.  Orders and steps are looked up in the
counts at the end.

Rows are told apart by a number given when their flags are written, not by
``doc_id``, so repeated rows and NULL ids count as rows of their own.

Defined cases: a NULL text is an empty one; a NULL ``doc_id`` fails no
comparison of ids, neither as the smaller nor as the larger one, and has no
labels; a row whose id has several labels is good (toxic) if one of them says
so; a NULL part is the empty string; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import written

WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOL = r"[#$%&*|]"
LEAST_WORDS = 200
#: The filter that compares a text with those of smaller ids.
REPEATED = "E"
FILTERS = ("A", "B", "C", "D", REPEATED)


def text_failures(text: Column) -> dict[str, Column]:
    """The failure conditions that a text alone decides."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {"A": F.size(words) < LEAST_WORDS,
            "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
            "C": capitals * 100 > F.length(text) * 2,
            "D": text.rlike(SYMBOL)}


def _flagged(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, part: str) -> DataFrame:
    """(rid, doc_id, part, good, toxic, fails: letters decided by the text, digest), written once."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       t.alias("text"))
    letters = [F.when(c, F.lit(k)).otherwise("") for k, c in text_failures(F.col("text")).items()]
    rows = rows.select("doc_id", "part", F.concat(*letters).alias("fails"),
                       F.unhex(F.sha2("text", 256)).alias("digest"))
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.col("quality").eqNullSafe(1)).alias("good"), F.max(F.col("toxic").eqNullSafe(1)).alias("toxic"))
    rows = rows.withColumn("rid", F.monotonically_increasing_id())
    return written(rows.join(marks, "doc_id", "left").fillna(False, ["good", "toxic"]), "audit-rows")


def _repeated(rows: DataFrame) -> DataFrame:
    """Rows whose text a smaller id has: those that are not the first of their text.

    Dealt out by text and id, so a text that many rows share stays spread."""
    known = rows.filter(F.col("doc_id").isNotNull())
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    return known.join(first, ["digest", "doc_id"], "left_anti")


def failing_ids(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                part: str = "source") -> tuple[DataFrame, dict[str, DataFrame]]:
    """(rows, one written table of failing rows per filter); all have rid, part, good and toxic."""
    rows = _flagged(docs, labels, doc_id, text, part)
    keep = ("rid", "part", "good", "toxic")
    by_text = rows.select(*keep, F.explode(F.split("fails", "")).alias("filter")).filter("filter <> ''")
    failing = by_text.unionAll(_repeated(rows).select(*keep, F.lit(REPEATED).alias("filter")))
    path = scratch_path(docs.sparkSession, "audit-failing")
    failing.write.partitionBy("filter").parquet(path)
    stored = docs.sparkSession.read.schema(failing.schema).parquet(path)
    return rows.select(*keep), {k: stored.filter(F.col("filter") == k).select(*keep) for k in FILTERS}


def _prefixes(n: int, without: Column | None = None) -> Column:
    """All sets of n filters as bit sets, or those without the given one."""
    every = F.array(*[F.lit(s) for s in range(1 << n)])
    return F.explode(every if without is None else F.filter(every, lambda s: s.bitwiseAND(without) == 0))


def prefix_counts(rows: DataFrame, tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(part, prefix, kept) and (part, prefix, bit, removed, redundant, good_lost, toxic_lost)
    for every set of filters and every filter outside it."""
    names = list(tables)
    failing = None
    for i, k in enumerate(names):
        t = tables[k].withColumn("bit", F.lit(1 << i))
        failing = t if failing is None else failing.unionAll(t)
    # dealt out by id before the prefixes multiply the rows: the joins need no further exchange
    left = rows.repartition("rid").select("rid", "part", _prefixes(len(names)).alias("prefix"))
    dealt = failing.repartition("rid")
    cases = dealt.withColumn("prefix", _prefixes(len(names), F.col("bit")))
    other = dealt.select(F.col("rid").alias("r"), F.col("bit").alias("b"))

    def among(df: DataFrame, how: str) -> DataFrame:
        return df.join(other, (df["rid"] == F.col("r")) & (df["prefix"].bitwiseAND(F.col("b")) != 0), how)

    kept = among(left, "left_anti").groupBy("part", "prefix").agg(F.count(F.lit(1)).alias("kept"))
    key = ("part", "prefix", "bit")
    count = F.count(F.lit(1))
    removed = among(cases, "left_anti").groupBy(*key).agg(
        count.alias("removed"), F.count_if("good").alias("good_lost"), F.count_if("toxic").alias("toxic_lost"))
    redundant = among(cases, "left_semi").groupBy(*key).agg(count.alias("redundant"))
    return kept, removed.join(redundant, list(key), "full")


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          part: str = "source") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley): a row per part, order of the filters and step, counts within the part."""
    rows, tables = failing_ids(docs, labels, doc_id, text, part)
    names = list(tables)
    kept, cases = prefix_counts(rows, tables)
    every = (1 << len(names)) - 1
    # a filter's place is the same in |S|! * (k - 1 - |S|)! orders for each set S before it
    k = len(names)
    orders = F.element_at(F.array(*[F.lit(factorial(n) * factorial(k - 1 - n)) for n in range(k)]),
                          F.bit_count("prefix") + 1)
    of_filter = cases.groupBy("part", "bit").agg(
        F.sum(F.coalesce("removed", F.lit(0)) * orders).alias("shapley"),
        F.sum(F.when(F.col("prefix") + F.col("bit") == every, F.col("removed"))).alias("unique_fails"))
    steps = [(o, i, letter, 1 << names.index(letter), sum(1 << names.index(x) for x in o[:i]))
             for o in map("".join, permutations(names)) for i, letter in enumerate(o)]
    grid = F.explode(F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(i + 1).alias("step"),
                                        F.lit(b).alias("bit"), F.lit(s).alias("prefix"),
                                        F.lit(s + b).alias("after")) for o, i, _, b, s in steps]))
    out = rows.select("part").distinct().select("part", grid.alias("g")).select("part", "g.*")
    out = (out.join(kept.withColumnRenamed("prefix", "after"), ["part", "after"], "left")
           .join(cases, ["part", "prefix", "bit"], "left").join(of_filter, ["part", "bit"], "left"))
    longs = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return out.select("part", "filter_order", "step",
                      *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in longs])
