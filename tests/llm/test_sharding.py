import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tollcast.llm import sharding as S


def checked(rows, docs, shards):
    """All rows, the law, gapless slots, sizes and checksums."""
    want = Counter((d.doc_id, len((d.text or "").encode()) + 8, zlib.crc32((d.text or "").encode())) for d in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1


def broken_groups(rows, docs):
    text_of = {d.doc_id: d.text for d in docs}
    groups = defaultdict(list)
    for r in rows:
        groups[text_of[r.doc_id]].append(r.shard)
    return [len(g) for g in groups.values() if len(set(g)) > 1], sum(len(g) > 1 for g in groups.values())


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_documents(corpus):
    docs = corpus.collect()
    rows = S.shard_documents(corpus, shards=24).collect()
    checked(rows, docs, 24)
    broken, groups = broken_groups(rows, docs)
    assert groups > 30 and len(broken) <= 0.1 * groups


def test_a_third_of_all_rows_in_one_group(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").when(
        F.col("id") % 3 == 1, F.concat(F.lit("pair "), (F.col("id") / 6).cast("int"))).otherwise(
        F.concat(F.lit("own "), "id")).alias("text"))
    rows = S.shard_documents(docs, shards=8).collect()
    checked(rows, docs.collect(), 8)
    hot = Counter(r.shard for r in rows if r["size"] == len("same text") + 8)
    assert hot.most_common(1)[0][1] > 250  # drawn together, in a shard of 375 that holds pairs too
    broken, groups = broken_groups(rows, docs.collect())
    assert len(broken) <= 0.2 * groups


def test_blocks_of_few_rows_change_no_law(spark, corpus):
    rows = corpus.select(F.col("doc_id").alias("id")).withColumns(
        {"shard": F.pmod(F.xxhash64("id"), F.lit(3)).cast("int"), "linked": F.col("id") % 5 == 0})
    out = S.even_slots(rows, ["id"], shards=5, block_rows=7).collect()
    assert len(out) == corpus.count()
    for s in range(5):
        slots = sorted(r.slot for r in out if r.shard == s)
        assert slots == list(range(200))


def test_no_python_in_the_plan(documents):
    plan = S.shard_documents(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_odd_rows(odd_documents, no_documents):
    rows = S.shard_documents(odd_documents.withColumnRenamed("lang", "shard"), shards=3).collect()
    checked(rows, odd_documents.collect(), 3)
    checked(S.shard_documents(odd_documents, shards=24).collect(), odd_documents.collect(), 24)
    assert S.shard_documents(no_documents).collect() == []
