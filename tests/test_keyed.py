"""Tables stored by key: joins without an exchange, hot keys spread."""
import pytest
from pyspark.sql import functions as F

from tollcast.operators.joins import feature_join
from tollcast.plans import catalogue as C
from tollcast.sources import keyed

from conftest import SF001


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, old)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_join_moves_no_rows(spark, no_broadcast):
    stored, plain = _plan(C.q_feature_join_stored(spark, SF001)), _plan(C.q_feature_join(spark, SF001))
    assert "SortMergeJoin" in stored and "Exchange" not in stored
    assert "SortMergeJoin" in plain and "Exchange" in plain


def test_same_rows_with_hot_null_and_repeated_keys(spark, no_broadcast):
    rows = [(None if i % 11 == 0 else 7 if i % 3 == 0 else i % 50, i // 2 % 40) for i in range(900)]
    facts = spark.createDataFrame(rows, "k long, v long")
    features = spark.createDataFrame([(k, float(k)) for k in range(45)] + [(None, -1.0)], "k long, x double")
    got = keyed.stored_join(keyed.store_facts(facts, "facts", ["k"]), keyed.store_features(features, "features", ["k"]), ["k"])
    want = feature_join(facts, features, ["k"])
    assert got.columns == ["k", "v", "x"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.select("k", "v", "x").collect()), key=repr)
    empty = keyed.store_facts(facts.limit(0), "facts", ["k"])
    assert keyed.stored_join(empty, keyed.store_features(features, "features", ["k"]), ["k"]).collect() == []


def test_a_hot_key_lies_in_many_buckets(spark):
    facts = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    stored = keyed.store_facts(facts, "hot", ["k"], buckets=32, salts=64)
    sizes = stored.groupBy(F.input_file_name().alias("f")).count().toPandas()["count"]
    assert sizes.sum() == 20_000 and len(sizes) == 32 and sizes.max() < 20_000 / 8


def test_buckets_grow_with_the_tables(spark, monkeypatch):
    """Would have failed before: eight buckets, whatever the rows."""
    facts, features = spark.range(50), spark.range(90)
    assert keyed.buckets_for(facts, features) == keyed.BUCKETS
    monkeypatch.setattr(keyed, "BUCKET_ROWS", 10)
    assert keyed.buckets_for(facts, features) == 90 * keyed.SALTS // 10
    assert keyed.buckets_for(spark.range(10_001), features) == 1001
