"""Recursive forecasts against a plain loop."""
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tollcast.operators import forecast as fc

T0 = datetime(2024, 1, 10)


def ts(minutes):
    return (T0 + timedelta(minutes=minutes)).strftime("%Y-%m-%d %H:%M:%S")


def test_blocks():
    assert fc.blocks([ts(40), ts(0), ts(20), ts(100), ts(0)]) == [
        (ts(0), 1, ts(0)), (ts(20), 2, ts(0)), (ts(40), 3, ts(0)), (ts(100), 1, ts(100))]
    assert fc.blocks([]) == []


def test_recursion_against_a_loop(spark):
    rnd = random.Random(3)
    keys = ["a", "b", None, "c"]  # c: too few values; d: none at all
    rows = [(k, ts(20 * i), float(rnd.randrange(100))) for k in keys[:3] for i in range(60) if rnd.random() < 0.7]
    rows += [("c", ts(20 * 3), 5.0), ("b", ts(20 * 500), 1.0)]
    windows = [ts(20 * i) for i in (30, 31, 32, 33, 50, 51, 200)]
    known = [r for r in rows if r[1] not in windows]
    n = 3

    def plain(lags, at):
        x = [7.0 if v is None else v for v in lags]
        return 0.5 * x[0] + 0.2 * x[1] + 0.1 * x[2] + at.minute

    want = {}
    for k in [*keys, "d"]:
        for w, step, block in fc.blocks(windows):
            if step == 1:
                old = sorted((t, v) for kk, t, v in known if kk == k and t < block)
                lags = [v for _, v in reversed(old)][:n]
                lags += [None] * (n - len(lags))
            z = plain(lags, datetime.strptime(w, "%Y-%m-%d %H:%M:%S"))
            want[k, w] = round(z, 6)
            lags = [z, *lags[:-1]]

    observed = spark.createDataFrame(known, "k string, t string, v double").select(
        "k", F.to_timestamp_ntz("t").alias("bin_start"), "v")
    table = spark.createDataFrame([(k,) for k in [*keys, "d"]], "k string")
    starts = {b for _, _, b in fc.blocks(windows)}
    origins = fc.last_values(observed.repartition(5), ["k"], "v", starts, n)
    grid = fc.forecast_grid(table, ["k"], windows)

    def predict(df):
        x = [F.coalesce(F.col(f"lag{i}"), F.lit(7.0)) for i in (1, 2, 3)]
        return df.withColumn("prediction", 0.5 * x[0] + 0.2 * x[1] + 0.1 * x[2] + F.minute("bin_start"))

    out = fc.recursive_forecast(grid, origins, predict, ["k"], n).collect()
    got = {(r.k, str(r.bin_start)[:19]): round(r.prediction, 6) for r in out}
    assert len(out) == len(want) and got == want


def test_nothing_to_forecast(spark):
    observed = spark.createDataFrame([], "k string, bin_start timestamp_ntz, v double")
    origins = fc.last_values(observed, ["k"], "v", [ts(0)], 2)
    assert origins.collect() == []
    grid = fc.forecast_grid(observed, ["k"], [ts(0), ts(20)])
    out = fc.recursive_forecast(grid, origins, lambda df: df.withColumn("prediction", F.lit(0.0)), ["k"], 2)
    assert out.collect() == [] and "prediction" in out.columns


def test_one_scan_and_two_exchanges_of_data_for_panes(spark):
    """All shifted bins come from one scan of the rows."""
    from tollcast.operators import bins

    from conftest import SF001
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    shifts = [(5, "right"), (-5, "left"), (3, "right"), (55, "left")]
    out = bins.bin_count_augmented(ev, "ts", ["event_type"], shifts)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 2
    got = {tuple(r) for r in out.collect()}
    want = set()
    for off, label in [(0, "left"), *shifts]:
        b = bins.bin_count(ev, "ts", ["event_type"], offset_minutes=off, label=label)
        want |= {(*r, f"{off}/{label}") for r in b.select("bin_start", "event_type", "volume").collect()}
    assert got == want


def test_merged_states_do_not_depend_on_the_parts(spark):
    from tollcast.operators import profile, states
    df = spark.range(4000).selectExpr("CAST(id % 977 AS DOUBLE) AS a", "IF(id % 5 = 0, NULL, 1e9 + id) AS b",
                                      "CAST(NULL AS DOUBLE) AS c", "id % 13 AS part", "id % 3 AS other")
    exact = {r.col_name: r for r in profile.profile(df, ["a", "b"]).collect()}
    for part in ("part", "other"):
        st = states.partial_states(df, F.col(part), ["a", "b", "c"])
        got = {r.col_name: r for r in states.merge_states(st).collect()}
        assert set(got) == {"a", "b"}
        for c in "ab":
            assert (got[c]["count"], got[c]["min"], got[c]["max"]) == (exact[c]["count"], exact[c]["min"], exact[c]["max"])
            assert abs(got[c]["mean"] - exact[c]["mean"]) < 1e-9 * abs(exact[c]["mean"])
            assert abs(got[c]["std"] - exact[c]["std"]) < 1e-6 * exact[c]["std"]
        values = sorted(r.a for r in df.collect())
        for q, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")):
            low = sum(v < got["a"][name] for v in values) / len(values)
            upto = sum(v <= got["a"][name] for v in values) / len(values)
            e = states.rank_error()
            assert low - e <= q <= upto + e


def test_open_domain_keeps_its_values_off_the_driver(spark):
    from pyspark.ml.linalg import SparseVector

    from tollcast.operators import encode
    df = spark.createDataFrame([(v,) for v in ["b"] * 3 + ["a"] * 3 + ["c", "d", None, "e"]], "v string")
    known = encode.frequency_dictionary(df, "v", num_partitions=3)
    assert [tuple(r) for r in known.orderBy("index").collect()] == [
        ("a", 3, 0), ("b", 3, 1), ("c", 1, 2), ("d", 1, 3), ("e", 1, 4)]
    more = df.unionAll(spark.createDataFrame([("new",)], "v string"))
    rows = encode.onehot_open(more, "v", known, 2).collect()
    assert {(r.v, r.v_index) for r in rows} == {("a", 0.0), ("b", 1.0), ("c", 2.0), ("d", 2.0), ("e", 2.0),
                                               (None, 2.0), ("new", 2.0)}
    assert all(isinstance(r.v_vec, SparseVector) and r.v_vec.size == 2 for r in rows)
    assert {r.v: list(r.v_vec.indices) for r in rows}["b"] == [1]


def test_a_day_written_again_leaves_the_others(spark, tmp_path):
    import os
    from datetime import date

    from tollcast.operators.lags import add_lags
    from tollcast.sources import days
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    rows = spark.range(24 * 6).selectExpr(
        "timestampadd(HOUR, CAST(id AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00') AS t", "CAST(id AS DOUBLE) AS v")
    rows = rows.withColumn("day", F.to_date("t"))

    def lagged(df):
        return add_lags(df, "v", 2, order=["t"])

    days.write_days(rows, source)
    days.refresh(spark, source, target, date(2024, 1, 1), date(2024, 1, 6), lagged, look_back_days=1)
    first = sorted(map(tuple, spark.read.parquet(target).select("t", "v", "lag2").collect()))
    assert first == sorted(map(tuple, lagged(rows).select("t", "v", "lag2").collect()))

    def files():
        return {d: sorted((f, os.stat(os.path.join(target, d, f)).st_mtime_ns) for f in os.listdir(os.path.join(target, d)))
                for d in os.listdir(target) if d.startswith("day=")}

    before = files()
    changed = rows.filter("day = DATE'2024-01-03'").withColumn("v", -F.col("v"))
    days.write_days(changed, source)
    days.refresh(spark, source, target, date(2024, 1, 3), date(2024, 1, 3), lagged, look_back_days=1)
    after = files()
    assert {d for d in after if after[d] != before[d]} == {"day=2024-01-03", "day=2024-01-04"}
    whole = rows.filter("day <> DATE'2024-01-03'").unionByName(changed)
    assert sorted(map(tuple, spark.read.parquet(target).select("t", "v", "lag2").collect())) == sorted(
        map(tuple, lagged(whole).select("t", "v", "lag2").collect()))
    plan = days.read_days(spark, source, date(2024, 1, 2), date(2024, 1, 3))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "day=" not in plan.split("PushedFilters")[1][:40]


def test_rejected_lines(spark, tmp_path):
    from tollcast.sources import csv as csvsrc
    path = tmp_path / "in"
    path.mkdir()
    (path / "a.csv").write_text('k,t,v\n1,2024-01-01 00:00:00,2.5\nx,2024-01-01 00:00:00,2\n2,noon,1.2.3\n3,2024-01-01 00:00:00\n'
                                '4,,\n5,2024-01-01 00:00:00,1,9\n"6","2024-01-01 00:00:00","7"\n')
    rows, rejects = csvsrc.read_csv_rejects(spark, str(path), "k int, t timestamp_ntz, v double")
    assert sorted((r.k, r.v) for r in rows.collect()) == [(1, 2.5), (4, None), (6, 7.0)]
    found = {r.line: r.reason for r in rejects.collect()}
    assert found == {"x,2024-01-01 00:00:00,2": "bad k", "2,noon,1.2.3": "bad t, v",
                     "3,2024-01-01 00:00:00": "number of fields", "5,2024-01-01 00:00:00,1,9": "number of fields"}
    assert all(r.file.endswith("a.csv") for r in rejects.collect())
    assert rows.select("k").count() == 3 and rejects.select("reason").count() == 4
