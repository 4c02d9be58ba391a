"""Balanced label propagation into shards, in DataFrame functions only.

Documents that share a link key are linked, through the key and never pair by
pair.  They start in the shard that the hash of a row number names.  In each
round every key names, of the shards with room, the one that holds most of its
documents; a document in a shard that holds fewer wishes to go there, by the
strongest of its keys; and quotas decide: a shard takes no more linked rows
than its quota has room for, as a share of the wishes drawn by hash, by
document where a key holds more than a fraction of a shard and by key
otherwise, so that small groups move whole.  Wishes and loads are
pre-aggregated to a number for each shard.

The law is ``rows``: shard counts differ by one at most.  After the rounds,
rows beyond a shard's quota fill the gaps of the others, those without a link
first.  Slots follow from counts by (shard, block of rows), whose number
grows with the corpus, so no task sorts a shard.

The rows' narrow table and every round's labels are written to the shared
checkpoint folder.

Defined cases: a NULL text has size 8 and checksum 0 and is linked to none;
a NULL id is an id like others; equal rows are rows each; fewer rows than
shards leave shards empty; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SHARDS = 24
ROUNDS = 8
LAW = "rows"
#: Rows ranked together for their slots.
BLOCK_ROWS = 20_000
#: Parts in which the rows of a key are joined.
SALTS = 32
#: A key of more than this share of a shard's quota moves document by document.
LARGE_KEY = 0.125


def _lookup(values: list, index: Column) -> Column:
    """``values[index]`` for one number a shard."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)


def _unit(*cols) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def propagate(rows: DataFrame, links: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(id, shard, linked) per row of ``rows`` (id), from ``links`` (id, key).

    Ids must be distinct; a key may link any number of rows.
    """
    total = rows.count()
    quota = max(1.0, total / shards)
    large = max(1.0, LARGE_KEY * quota)
    sizes = links.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    # a key may hold a third of all rows: its rows meet their size in SALTS parts
    dealt = links.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    copies = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    links = written(dealt.join(copies, ["key", "salt"]).drop("salt"), "links")
    linked = links.select("id").distinct().withColumn("linked", F.lit(True))
    start = rows.select("id", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"))
    cur = written(start.join(linked, "id", "left").select(
        "id", "shard", F.coalesce("linked", F.lit(False)).alias("linked")), "labels-0")
    # how strongly a key is in a shard; equal counts go by hash, so that ties do not all name one shard
    strength = F.struct(F.col("c"), F.xxhash64("key", "shard").alias("h"), F.col("shard"))
    for r in range(1, rounds + 1):
        room = [quota] * shards  # for linked rows: the others give way to them at the end
        for s, n in cur.filter("linked").groupBy("shard").count().collect():  # a number a shard
            room[s] -= n
        free = [s for s in range(shards) if room[s] >= 1]
        placed = links.join(cur.filter("linked"), "id")
        cells = (placed.groupBy("key", "shard").agg(F.count(F.lit(1)).alias("c"))
                 .withColumn("own", strength))
        best = cells.filter(F.col("shard").isin(free)).groupBy("key").agg(F.max("own").alias("best"))
        better = (cells.join(best, "key").filter("best > own")
                  .select("key", "shard", F.col("best.c").alias("c"), F.col("best.shard").alias("to")))
        wish = F.max(F.struct(F.col("c"), F.xxhash64("key").alias("h"), F.col("key"), F.col("to"), F.col("size")))
        # a key that has settled in one shard is one cell: its rows meet the cell's wish in SALTS parts too
        parts = better.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        split = placed.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
        wishes = (split.join(parts, ["key", "shard", "salt"]).groupBy("id").agg(wish.alias("w"))
                  .select("id", "w.key", "w.to", "w.size"))
        want = written(wishes.select("id", "to", F.when(F.col("size") > large, _unit("id", F.lit(r))).otherwise(
            _unit("key", F.lit(r))).alias("draw")), f"wishes-{r}")
        enter = [0] * shards
        for t, n in want.groupBy("to").count().collect():  # a number a shard
            enter[t] = n
        if not sum(enter):
            break
        share = [min(1.0, room[s] / enter[s]) if enter[s] else 0.0 for s in range(shards)]
        moved = want.filter(F.col("draw") < _lookup(share, F.col("to"))).select("id", "to")
        cur = written(cur.join(moved, "id", "left").select(
            "id", F.coalesce("to", "shard").alias("shard"), "linked"), f"labels-{r}")
    return cur


def even_slots(rows: DataFrame, order: list, shards: int = SHARDS,
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` (shard, linked, ...) with final ``shard`` and gapless ``slot``, counts at most one apart.

    ``order`` names the columns that tell rows apart.
    """
    total = rows.count()
    blocks = max(1, -(-total // (shards * block_rows)))
    # linked rows rank first, so that those beyond the quota are, if possible, without a link;
    # the blocks are cut by row hash, so a large group fills many of them evenly
    spread = F.pmod(F.xxhash64(*order), F.lit(blocks))
    b = rows.withColumn("_block", F.when(F.col("linked"), spread).otherwise(spread + blocks).cast("long"))
    sizes = b.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    load = [0] * shards
    for s, n in sizes.groupBy("shard").agg(F.sum("_n")).collect():  # a number a shard
        load[s] = n
    # the larger quotas go to the fullest shards
    quota = [total // shards] * shards
    for s in sorted(range(shards), key=lambda s: (-load[s], s))[:total % shards]:
        quota[s] += 1
    spare, gaps = [0], [0]  # running numbers of rows over, and of places free, before each shard
    for s in range(shards):
        spare.append(spare[-1] + max(0, load[s] - quota[s]))
        gaps.append(gaps[-1] + max(0, quota[s] - load[s]))
    inner = Window.partitionBy("shard", "_block").orderBy(*order)
    ranked = (b.withColumn("_in", F.row_number().over(inner) - 1).join(offsets, ["shard", "_block"])
              .withColumn("_rank", F.col("_off") + F.col("_in")))
    over = F.col("_rank") >= _lookup(quota, F.col("shard"))
    nth = _lookup(spare[:-1], F.col("shard")) + F.col("_rank") - _lookup(quota, F.col("shard"))
    target = F.coalesce(*[F.when(nth < gaps[s + 1], F.lit(s)) for s in range(shards)], F.lit(0))
    ranked = ranked.withColumns({"_over": over, "_nth": nth, "_to": target})
    slot = F.when(F.col("_over"), _lookup([min(a, q) for a, q in zip(load, quota)], F.col("_to"))
                  + F.col("_nth") - _lookup(gaps[:-1], F.col("_to"))).otherwise(F.col("_rank"))
    shard = F.when(F.col("_over"), F.col("_to")).otherwise(F.col("shard"))
    return (ranked.withColumns({"slot": slot.cast("long"), "_shard": shard.cast("int")})
            .withColumn("shard", F.col("_shard"))
            .drop("_block", "_off", "_in", "_rank", "_over", "_nth", "_to", "_shard"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard); rows of equal texts are linked."""
    t = F.coalesce(F.col(text), F.lit(""))
    # numbered once and written, so the numbers stay whatever is computed again
    rows = written(docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(t) + 8).cast("long").alias("size"),
        F.crc32(t).alias("text_crc32"), F.md5(F.col(text).cast("binary")).alias("key"),
        F.monotonically_increasing_id().alias("id")), "shard-rows")
    labels = propagate(rows.select("id"), rows.filter("key is not null").select("id", "key"), shards, rounds)
    placed = rows.join(labels, "id").drop("key")
    out = even_slots(placed, ["id"], shards)
    return out.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
