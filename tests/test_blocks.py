"""Trees on blocks of rows against the library's on the rows, forecasts in place against those step by step."""
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tollcast.functions import timefns as tf
from tollcast.operators import blocks, metrics, models
from tollcast.operators import forecast as fc
from tollcast.plans import features, modeling

T0 = datetime(2024, 1, 10)
LAGS = ["lag1", "lag2", "lag3"]


def _rows(spark, n=900):
    """Rows of 30 windows and nine keys, some of a key's rows the same; labels that lags, windows and keys make."""
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        k, w = i % 9, rnd.randrange(30)
        lags = [float(rnd.randrange(200)), rnd.random(), float(rnd.randrange(3))]
        y = 0.3 * lags[0] + 20 * lags[1] * (w % 4) + 7 * (k % 3) + rnd.random()
        rows += [(k, T0 + timedelta(minutes=20 * w), y, *lags, [float(k % 3), k / 2])] * (2 if i % 50 == 0 else 1)
    df = spark.createDataFrame(rows, "k int, bin_start timestamp_ntz, y double, lag1 double, lag2 double, lag3 double, "
                                     "_of_key array<double>").repartition(3, "k")
    windows = spark.createDataFrame([(T0 + timedelta(minutes=20 * w), [float(w % 4), float(w >= 15), w / 7, 1.0]) for w in range(30)],
                                    "bin_start timestamp_ntz, _of_window array<double>")
    return features.FeatureRows(df, windows, [*LAGS, "a", "b", "c", "d", "e", "f"], LAGS)


def _vectors(rows):
    return rows.vectors(rows.rows).withColumn("features", array_to_vector("features")).select("bin_start", "y", "features")


def _small(monkeypatch):
    """Many blocks, and many pieces of work for a task."""
    monkeypatch.setattr(blocks, "UNIT", 200)
    return {"block": 37, "chunk": 100}


def test_boosted_trees_are_those_of_the_library(spark, monkeypatch):
    rows, early = _rows(spark), F.col("bin_start") < F.lit(T0 + timedelta(minutes=400))
    e = models.gradient_boosted("y", maxIter=5, maxDepth=3, maxBins=16)
    part = _vectors(rows).filter(early)
    model = e.fit(part)
    want = model.transform(_vectors(rows)).groupBy(early.alias("early")).agg(*metrics.aggregates("y")).collect()
    coef = np.arange(9.0)
    made = blocks.blocked(rows.rows, rows.windows, LAGS, "y", early, 16, (coef, 2.5), **_small(monkeypatch))
    assert made.df.count() > 20 and [len(c) for c in made.cuts[3:7]] == [3, 1, 15, 0]
    bytes_of_row = made.df.select([F.octet_length(c) for c in ("lags", "window", "combination", "combinations", "y")]).collect()
    assert sum(map(sum, bytes_of_row)) / rows.rows.count() < 24
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    trees = blocks.boosted(made, e)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached
    found = blocks.errors(made, trees, trees[:1])
    assert len(trees) == 5
    for r in want:
        got = found["boosted_trees", r["early"]]
        assert got["n"] == r["n"] > 100
        for c in ("mae", "rmse", "r2", "mape"):
            assert got[c] == pytest.approx(r[c], rel=1e-9)
    linear = _vectors(rows).rdd.map(lambda r: r["y"] - (float(np.dot(coef, r["features"].toArray())) + 2.5)).collect()
    both = [found["linear", p] for p in (True, False)]
    assert sum(b["mae"] * b["n"] for b in both) == pytest.approx(sum(map(abs, linear)), rel=1e-9)
    means = np.mean([r["features"].toArray() for r in part.collect()], 0)
    assert made.means == pytest.approx(means, rel=1e-9)


def test_forest_draws_rows_and_features(spark, monkeypatch):
    rows = _rows(spark)
    made = blocks.blocked(rows.rows, rows.windows, LAGS, "y", F.lit(True), 32, **_small(monkeypatch))
    e = models.random_forest("y", numTrees=40, maxDepth=5)
    trees = blocks.forest(made, e)
    assert len(trees) == 40 and len({tuple(t["feature"]) for t in trees}) > 30  # summed up in tasks and on the driver
    assert len({t["value"][1] for t in trees}) > 30  # each tree has rows of its own
    mean = rows.rows.agg(F.avg("y")).first()[0]
    assert np.mean([t["value"][1] for t in trees]) == pytest.approx(mean, rel=0.02)
    library = e.fit(_vectors(rows)).transform(_vectors(rows)).agg(*metrics.aggregates("y")).first()
    got = blocks.errors(made, [], trees)["random_forest", True]
    assert got["r2"] > 0.8 and got["rmse"] == pytest.approx(library["rmse"], rel=0.1)
    again = blocks.forest(made, e)
    assert all(np.array_equal(a[c], b[c]) for a, b in zip(trees, again) for c in ("feature", "cut", "value"))
    # one tree of all rows is the library's
    one = models.random_forest("y", numTrees=1, maxDepth=4, bootstrap=False)
    want = one.fit(_vectors(rows)).transform(_vectors(rows)).agg(*metrics.aggregates("y")).first()
    assert blocks.errors(made, [], blocks.forest(made, one))["random_forest", True]["rmse"] == pytest.approx(want["rmse"], rel=1e-9)


def test_many_values_are_told_by_points():
    t = blocks._tools()
    rnd = np.random.default_rng(1)
    x = np.r_[rnd.random(50_000), np.full(20_000, 0.25), np.full(7, np.nan)]
    u, c = t.points(x, None, 500)
    assert len(u) <= 500 and c.sum() == pytest.approx(70_000) and c[u == 0.25][0] == pytest.approx(20_000, rel=0.02)
    u, c = t.points(np.array([3.0, 1.0, 3.0, np.nan]), np.array([2.0, 5.0, 1.0, 9.0]), 2)
    assert u.tolist() == [1.0, 3.0] and c.tolist() == [5.0, 3.0]


def test_model_fits_no_trees_on_vectors(spark, monkeypatch):
    """The library's trees hold every row with all features, and read it in every pass."""
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

    def no_fit(self, *a, **b):
        raise AssertionError("fitted on rows")

    monkeypatch.setattr(GBTRegressor, "_fit", no_fit)
    monkeypatch.setattr(RandomForestRegressor, "_fit", no_fit)
    o = modeling.ModelOptions(gbt={"maxIter": 2, "maxDepth": 2}, rf={"numTrees": 3, "maxDepth": 2})
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    out = modeling.fit_and_report_vectors(_rows(spark), ["k"], "y", "2024-01-10 06:40:00", options=o).collect()
    assert len(out) == 6 and all(r["n"] > 0 and r["r2"] > 0 for r in out)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached
    with pytest.raises(ValueError, match="no rows"):
        blocks.blocked(_rows(spark).rows, _rows(spark).windows, LAGS, "y", F.lit(False), 32)


def test_forecast_in_place_is_that_by_steps(spark):
    ts = [(T0 + timedelta(minutes=20 * i)).strftime("%Y-%m-%d %H:%M:%S") for i in range(300)]
    rnd = random.Random(3)
    keys = ["a", "b", None]  # c: too few values; d: none at all
    known = [(k, ts[i], float(rnd.randrange(100))) for k in keys for i in range(60) if rnd.random() < 0.7 and i not in range(30, 34)]
    known += [("c", ts[3], 5.0)]
    windows = [ts[i] for i in (30, 31, 32, 33, 50, 51, 200)]
    observed = spark.createDataFrame(known, "k string, t string, v double").select(
        "k", F.to_timestamp_ntz("t").alias("bin_start"), "v")
    table = spark.createDataFrame([(k, None if k in (None, "d") else [1.5, None if k == "c" else 2.0]) for k in [*keys, "c", "d"]],
                                  "k string, _of_key array<double>")
    listed = fc.blocks(windows)
    origins = fc.last_values(observed, ["k"], "v", {b for _, _, b in listed}, 3)

    def predict(model, lags, window, of_key):
        x = np.where(np.isnan(lags), 7.0, lags)
        own = np.where(np.isnan(of_key), 4.0, of_key).sum(1) if of_key.shape[1] else np.full(len(window), 8.0)
        return (2.0 if model == "twice" else 1.0) * (0.5 * x[0] + 0.2 * x[1] + 0.1 * x[2] + window + own)

    out = fc.forecast_in_place(table.repartition(4), origins, predict, ["k"], listed, ["once", "twice"], 3, "v").collect()
    got = {(r["model"], r["k"], r["time_window"]): r["v"] for r in out}
    assert len(out) == len(got) == 2 * 5 * 7
    number = F.element_at(F.create_map(*[x for i, w in enumerate(windows) for x in (F.lit(w), F.lit(float(i)))]),
                          F.date_format("bin_start", "yyyy-MM-dd HH:mm:ss"))
    own = F.coalesce(F.aggregate("_of_key", F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(4.0))), F.lit(8.0))
    grid = fc.forecast_grid(table, ["k"], windows).join(table.withColumnRenamed("k", "kk"), F.col("k").eqNullSafe(F.col("kk"))).drop("kk")
    for model, times in (("once", 1.0), ("twice", 2.0)):
        def step(df, times=times):
            x = [F.coalesce(F.col(f"lag{i}"), F.lit(7.0)) for i in (1, 2, 3)]
            return df.withColumn("prediction", times * (0.5 * x[0] + 0.2 * x[1] + 0.1 * x[2] + number + own))
        done = fc.recursive_forecast(grid, origins, step, ["k"], 3).withColumn("w", tf.window_label("bin_start", 20))
        for r in done.collect():
            assert got[model, r["k"], r["w"]] == pytest.approx(r["prediction"], rel=1e-9)


def test_forecasts_of_vectors_follow_the_models(spark, monkeypatch):
    """Nothing is written for a step, and what is missing has the rows' means."""
    from tollcast.sources import tables
    rows = _rows(spark)
    names = []
    for module in (fc, modeling):
        monkeypatch.setattr(module, "written", lambda df, name: names.append(name) or tables.written(df, name))
    last = [(T0 + timedelta(minutes=20 * w)).strftime("%Y-%m-%d %H:%M:%S") for w in (30, 31, 32)]

    def known(df):
        w = F.col("bin_start") >= F.lit(last[1]).cast("timestamp_ntz")
        return df.withColumns({"a": F.lit(2), "b": F.lit(1), "c": F.when(w, 4.0), "d": F.lit(1.0)})

    table = spark.createDataFrame([(k,) for k in range(11)], "k int")
    of_key = spark.createDataFrame([(k, float(k % 3), k / 2) for k in range(9)], "k int, e double, f double")
    observed = rows.rows.dropDuplicates(["k", "bin_start"])
    rows = features.FeatureRows(observed, rows.windows, rows.names, rows.lags)
    out = modeling.forecast_vectors(
        rows, ["k"], "y", last, known, of_key, (["lag1", "c"], models.linear_regression("y")),
        ("random_forest", models.random_forest("y", numTrees=5, maxDepth=4)), table, n_lags=3, method="window").collect()
    assert not [n for n in names if n.startswith("forecast")]
    assert len(out) == 2 * 11 * 3
    pairs = observed.join(rows.windows, "bin_start").select("k", "bin_start", "y", "lag1", F.col("_of_window")[2].alias("c")).toPandas()
    x = np.c_[pairs[["lag1", "c"]], np.ones(len(pairs))]
    b = np.linalg.lstsq(x, pairs["y"], rcond=None)[0]
    latest = pairs.sort_values("bin_start").groupby("k")["y"].last()
    linear = {(r["k"], r["time_window"][1:20]): r["y"] for r in out if r["model"] == "linear"}
    for k in range(11):
        lag = latest.get(k, pairs["lag1"].mean())
        for w in last:
            lag = b @ [lag, pairs["c"].mean() if w == last[0] else 4.0, 1.0]
            assert linear[k, w] == pytest.approx(lag, rel=1e-6)
    forest = [r["y"] for r in out if r["model"] == "random_forest"]
    assert pairs["y"].min() <= min(forest) and max(forest) <= pairs["y"].max() and len(set(forest)) > 5
