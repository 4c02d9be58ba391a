"""Physical plan checks: pruning, pushdown, balanced scans, no key windows."""
import pytest

from tollcast.plans import catalogue as C

from conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df):
    return df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted") and \
        df._jdf.queryExecution().explainString(
            df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_scan_pruning_and_pushdown(spark):
    f = _formatted(C.q_filter_keys(spark, SF001))
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(user_id), EqualTo(event_type,click)" in f
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in f
    b = _formatted(C.q_bin_mean(spark, SF001))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in b


def test_lags_use_balanced_buckets_not_key_windows(spark):
    f = _formatted(C.q_lags_by_key(spark, SF001))
    assert "hashpartitioning(_key" in f and "_b0" in f
    # windows over data are partitioned by key and bucket, those over the key alone see summaries
    for line in f.splitlines():
        if line.startswith("Arguments:") and "windowspecdefinition(" in line and "_b0" not in line:
            raise AssertionError(line)


def test_scans_span_many_buckets(spark):
    """At sf0.01 every scan query's keys lie in 50 buckets and more."""
    from pyspark.sql import functions as F
    from tollcast.operators.sequence import bucket_columns
    for q, order in ((C._repair_input, ["ts", "event_id"]), (C._with_missing, ["ts", "event_id"]),
                     (C._bins_mean, ["bin_start"]), (C._sparse_bins, ["bin_start"])):
        df = q(spark, "/root/testdata/sf0.01")
        parts = bucket_columns(df, order, hours=C.BUCKET_HOURS)
        assert df.select(F.struct(*parts)).distinct().count() >= 50


@pytest.mark.parametrize("name", ["volume_features", "travel_time_features"])
def test_volume_job_is_lazy_and_neither_leaves_anything_cached(spark, name, monkeypatch):
    schemas = {t: spark.read.parquet(f"{SF001}/{t}.parquet").schema for t in ("events", "lineitem", "part")}

    def table(session, d, t):  # with a schema, reading a path needs no job either
        return session.read.schema(schemas[t]).parquet(f"{d}/{t}.parquet")
    monkeypatch.setattr(C.si, "table", table)
    monkeypatch.setattr(C, "table", table)
    sc = spark.sparkContext
    spark.catalog.clearCache()
    kept = sc._jsc.getPersistentRDDs().size()
    sc.setJobGroup(f"build-{name}", name)
    df = C.QUERIES[name](spark, SF001)
    built = list(sc.statusTracker().getJobIdsForGroup(f"build-{name}"))
    assert built == [] if name == "volume_features" else built != []  # the written windows
    sc.setJobGroup(f"run-{name}", name)
    df.write.format("noop").mode("overwrite").save()
    assert list(sc.statusTracker().getJobIdsForGroup(f"run-{name}")) != []
    assert sc._jsc.getPersistentRDDs().size() == kept


def test_profile_counts_values_before_it_sorts(spark):
    from pyspark.sql import functions as F
    from tollcast.operators import profile
    df = spark.range(100_000).select(F.lit(7.0).alias("a"), (F.col("id") % 10).cast("double").alias("b"))
    seen = []
    original = profile.add_sequence

    def watched(frame, *args, **kw):
        seen.append(frame.count())
        return original(frame, *args, **kw)
    profile.add_sequence = watched
    try:
        rows = {r.col_name: r for r in profile.profile(df, ["a", "b"]).collect()}
    finally:
        profile.add_sequence = original
    assert seen == [11]  # what is sorted: one row per distinct value
    assert rows["a"].q50 == 7.0 and rows["b"].q25 == 2.0 and rows["b"].q50 == 4.5


def test_bin_aggregation_is_partial_then_final(spark):
    p = _plan(C.q_bin_count(spark, SF001))
    assert p.count("HashAggregate") >= 2
    assert "hashpartitioning(bin_start" in p


def test_route_features_single_aggregate(spark):
    f = _formatted(C.q_route_features(spark, SF001))
    # one grouping on the route key instead of a chain of joined aggregates
    import re
    aggs = re.findall(r"^\(\d+\) HashAggregate", f, flags=re.M)
    # route lists (partial+final) and route features (partial+final)
    assert len(aggs) <= 4
    assert "SortMergeJoin" in f or "BroadcastHashJoin" in f


def test_corr_matrix_one_pass(spark):
    f = _formatted(C.q_corr_matrix(spark, SF001))
    import re
    assert len(re.findall(r"^\(\d+\) Scan parquet", f, flags=re.M)) == 1


def test_single_task_windows_only_over_summaries(spark):
    """Windows over data rows are partitioned by (key, bucket) or, without keys, by
    bucket; one without a partition spec (one task) runs over the buckets' summary
    rows, and only in scans without keys."""
    import re
    single = []
    for q in (C.q_lags_global, C.q_sentinel_repair, C.q_locf_grid, C.q_volume_features):
        for line in _formatted(q(spark, SF001)).splitlines():
            if not line.startswith("Arguments:") or "windowspecdefinition(" not in line:
                continue
            for of, spec in re.findall(r"(\w+)(?:#\d+L?[^()]*)?\)? windowspecdefinition\(([^()]*)", line):
                first = spec.split(", ")[0]
                if re.search(r" (ASC|DESC)", first):  # no partition columns before the order
                    assert first.startswith("_b0#"), line
                    assert re.search(r"_(tail|head|lastv|firstv|cnt|sofar|markat)", line), line
                    single.append(q.__name__)
                else:
                    assert first.startswith(("_key#", "_b0#")), line
    assert "q_lags_global" in single and not {"q_sentinel_repair", "q_locf_grid"} & set(single)
