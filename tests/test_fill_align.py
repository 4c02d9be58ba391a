"""Gap fill, grids, imputation, schema alignment, appends, lags."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tollcast.operators import align, fill, lags


def _ts(h, m):
    return dt.datetime(2016, 10, 18, h, m)


def test_gap_fill_fixture(spark):
    # positions 0..5 with values -,5,-,-,7,- -> null,5,5,5,7,7
    obs = spark.createDataFrame([("A", _ts(8, 20), 5.0), ("A", _ts(9, 20), 7.0)],
                                "k string, bin_start timestamp_ntz, v double")
    out = fill.locf_fill(obs, ["k"], "v", start="2016-10-18 08:00:00",
                         end="2016-10-18 09:40:00", bucket_hours=1)
    got = [r.v for r in out.orderBy("bin_start").collect()]
    assert got == [None, 5.0, 5.0, 5.0, 7.0, 7.0]
    filled = [r.filled for r in out.orderBy("bin_start").collect()]
    assert filled == [1, 0, 1, 1, 0, 1]


def test_missing_windows(spark):
    obs = spark.createDataFrame([("A", _ts(8, 0)), ("A", _ts(9, 0)), ("B", _ts(8, 0))],
                                "k string, bin_start timestamp_ntz")
    miss = fill.missing_windows(obs, ["k"]).orderBy("bin_start").collect()
    assert [(r.k, r.bin_start) for r in miss] == [("A", _ts(8, 20)), ("A", _ts(8, 40))]


def test_global_vs_key_lags(spark):
    rows = [(0, "A", 1.0), (0, "B", 2.0), (1, "A", 3.0), (1, "B", 4.0)]
    df = spark.createDataFrame(rows, "t long, k string, v double")
    g = lags.add_lags(df, "v", 1, partition_by=(), order=["t", "k"], bucket_width=1)
    k = lags.add_lags(df, "v", 1, partition_by=["k"], order=["t"], bucket_width=1)
    w = lags.add_lags(df, "v", 1, partition_by=["k"], order=["t"], method="window")
    assert [r.lag1 for r in g.orderBy("t", "k").collect()] == [None, 1.0, 2.0, 3.0]
    assert [r.lag1 for r in k.orderBy("t", "k").collect()] == [None, None, 1.0, 2.0]
    assert [r.lag1 for r in w.orderBy("t", "k").collect()] == [None, None, 1.0, 2.0]
    with pytest.raises(ValueError):
        lags.add_lags(df, "v", 1, partition_by=(), method="window")


def test_impute(spark):
    df = spark.createDataFrame([(1.0, None), (None, 4.0), (3.0, 2.0)], "a double, b double")
    z = fill.zero_impute(df, ["a", "b"]).collect()
    assert [(r.a, r.b) for r in z] == [(1.0, 0.0), (0.0, 4.0), (3.0, 2.0)]
    m = fill.mean_impute(df, ["a", "b"]).collect()
    assert [(r.a, r.b) for r in m] == [(1.0, 3.0), (2.0, 4.0), (3.0, 2.0)]
    fit = spark.createDataFrame([(10.0, 20.0)], "a double, b double")
    m2 = fill.mean_impute(df, ["a", "b"], fit=fit).collect()
    assert m2[0].b == 20.0 and m2[1].a == 10.0


def test_align_schema_fixture(spark):
    test = spark.createDataFrame([(5, 9)], "c int, x int")
    out = align.align_schema(test, ["a", "b", "c"])
    assert out.columns == ["a", "b", "c"]
    assert tuple(out.first()) == (0, 0, 5)


def test_append_sources_renumbers(spark):
    a = spark.createDataFrame([(3,), (1,)], "id long")
    b = spark.createDataFrame([(2,), (0,), (9,)], "id long")
    out = align.append_sources({"train": a, "test": b}, order=["id"], num_partitions=3)
    got = sorted((r["index"], r.source, r.id, r.old_index) for r in out.collect())
    assert got == [(0, "train", 1, 0), (1, "train", 3, 1), (2, "test", 0, 0),
                   (3, "test", 2, 1), (4, "test", 9, 2)]


def test_key_first_and_drop_rename(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert align.key_first(df, ["c"]).columns == ["c", "a", "b"]
    assert align.drop_rename(df, ["a"], {"b": "bb"}).columns == ["bb", "c"]


def test_bin_offset_right_label(spark):
    from tollcast.operators import bins
    df = spark.createDataFrame([(_ts(8, 7),), (_ts(8, 3),)], "ts timestamp_ntz")
    out = bins.bin_count(df, "ts", [], offset_minutes=5, label="right", bin_col="b")
    got = sorted(r.b for r in out.collect())
    assert got == [_ts(8, 5), _ts(8, 25)]
    assert F  # keep import


def test_grid_spans_chunks(spark, monkeypatch):
    from tollcast.operators import fill as FL
    monkeypatch.setattr(FL, "GRID_CHUNK", 4)
    obs = spark.createDataFrame([("A", _ts(8, 0)), ("A", _ts(11, 20)), ("B", _ts(9, 0))],
                                "k string, bin_start timestamp_ntz")
    g = FL.expected_grid(obs, ["k"]).orderBy("k", "bin_start").collect()
    a = [r.bin_start for r in g if r.k == "A"]
    assert len(a) == 11 and a[0] == _ts(8, 0) and a[-1] == _ts(11, 20)
    assert len(set(a)) == 11
    assert [r.bin_start for r in g if r.k == "B"] == [_ts(9, 0)]


def test_gap_fill_walk_order_option(spark):
    """Q3: walking the grid as all mornings then all afternoons lets the first
    afternoon window inherit the last morning value."""
    d1m, d2m = dt.datetime(2016, 10, 18, 8, 0), dt.datetime(2016, 10, 19, 8, 0)
    d1a = dt.datetime(2016, 10, 18, 17, 0)
    obs = spark.createDataFrame([("A", d1m, 1.0), ("A", d2m, 2.0), ("A", d1a, None)],
                                "k string, bin_start timestamp_ntz, v double").filter("v IS NOT NULL")
    grid_obs = obs.unionByName(spark.createDataFrame(
        [("A", dt.datetime(2016, 10, 19, 17, 0), 9.0)], "k string, bin_start timestamp_ntz, v double"))
    part = F.when(F.hour("bin_start") < 12, 0).otherwise(1)
    out = fill.locf_fill(grid_obs, ["k"], "v", hours=(8, 17), order=[part, "bin_start"],
                         bucket_hours=1)
    got = {r.bin_start: r.v for r in out.collect()}
    # 18th 17:00 is missing; by position it follows the 19th 08:00 morning (2.0)
    assert got[d1a] == 2.0
    by_time = fill.locf_fill(grid_obs, ["k"], "v", hours=(8, 17), bucket_hours=1)
    assert {r.bin_start: r.v for r in by_time.collect()}[d1a] == 1.0


@pytest.mark.parametrize("how", [{}, {"hours": (8, 9)}, {"start": "2016-10-18 08:00:00", "end": "2016-10-18 09:00:00"}])
def test_observed_windows_stay_once_whatever_their_value_and_key(spark, how):
    rows = [("A", _ts(8, 0), 1.0), ("A", _ts(8, 40), None), ("A", _ts(9, 0), 3.0),
            (None, _ts(8, 0), 5.0), (None, _ts(8, 40), 6.0), ("B", _ts(12, 0), 7.0)]
    obs = spark.createDataFrame(rows, "k string, bin_start timestamp_ntz, v double")
    out = fill.locf_fill(obs, ["k"], "v", **how).collect()
    seen = [(r.k, r.bin_start, r.v) for r in out if r.filled == 0]
    assert sorted(seen, key=repr) == sorted(rows, key=repr)
    fills = {(r.k, r.bin_start): r.v for r in out if r.filled == 1}
    assert fills[("A", _ts(8, 20))] == 1.0 and fills[(None, _ts(8, 20))] == 5.0
    assert not {(k, b) for k, b, _ in rows} & set(fills)
    missing = {(r.k, r.bin_start) for r in fill.missing_windows(obs, ["k"], **how).collect()}
    assert missing == set(fills)


def test_listed_grid_has_unobserved_keys_and_the_lists_order(spark):
    keys = spark.createDataFrame([("A",), ("C",), (None,)], "k string")
    obs = spark.createDataFrame([("A", _ts(17, 0), 4.0)], "k string, bin_start timestamp_ntz, v double")
    windows = ["2016-10-18 17:00:00", "2016-10-18 08:00:00"]
    out = fill.locf_fill(obs, ["k"], "v", order=["position"], grid=fill.listed_grid(keys, ["k"], windows)).collect()
    got = {(r.k, r.bin_start): (r.v, r.filled, r.position) for r in out}
    assert got[("A", _ts(17, 0))] == (4.0, 0, None) and got[("A", _ts(8, 0))] == (4.0, 1, 1)
    assert got[("C", _ts(8, 0))] == (None, 1, 1) and got[(None, _ts(17, 0))] == (None, 1, 0) and len(out) == 6


def test_means_type_does_not_depend_on_the_data(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b int")
    out = fill.mean_impute(df, ["a", "b"])
    assert dict(out.dtypes) == {"a": "double", "b": "double"}
    assert [(r.a, r.b) for r in out.collect()] == [(1.0, None), (2.0, None)]


def test_bin_count_augmented(spark):
    from tollcast.operators import bins
    df = spark.createDataFrame([(_ts(8, 7),), (_ts(8, 3),), (_ts(8, 22),)], "ts timestamp_ntz")
    out = bins.bin_count_augmented(df, "ts", [], [(5, "right"), (55, "left")], out="volume")
    got = sorted((r.shift, r.bin_start, r.volume) for r in out.collect())
    assert ("0/left", _ts(8, 0), 2) in got and ("0/left", _ts(8, 20), 1) in got
    # 5-minute offset, right label: 08:03 -> (07:45, 08:05] labelled 08:05
    assert ("5/right", _ts(8, 5), 1) in got and ("5/right", _ts(8, 25), 2) in got
    # 55-minute offset is the 15-minute grid (:15, :35, :55), left label
    assert ("55/left", _ts(7, 55), 2) in got and ("55/left", _ts(8, 15), 1) in got
    assert sum(v for s, _, v in got if s == "55/left") == 3


@pytest.mark.parametrize("hours", [None, (6, 7)])
def test_fill_by_window_equals_the_scan(spark, hours):
    """Rows outside the expected hours, NULL values and a NULL key; other columns are kept."""
    rows = [(None if k == 3 else k, f"2024-01-0{1 + i % 3} {5 + i * j % 4:02d}:{20 * (i % 3):02d}:00", None if i % 4 == 0 else float(i), j)
            for k in (1, 2, 3) for j in (1, 3) for i in range(k, 20, 2)]
    rows = list({r[:2]: r for r in rows}.values())
    df = spark.createDataFrame(rows, "k long, b string, v double, other long").selectExpr(
        "k", "CAST(b AS timestamp_ntz) AS bin_start", "v", "other")
    a, b = (fill.locf_fill(df, ["k"], "v", hours=hours, method=m) for m in ("scan", "window"))
    assert a.columns == b.columns
    got = [sorted(map(repr, x.collect())) for x in (a, b)]
    assert got[0] == got[1] and len(got[1]) > len(rows)
    with pytest.raises(ValueError):
        fill.locf_fill(df, [], "v", method="window")
