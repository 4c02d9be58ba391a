"""Grids whose points share fits: against the library's own fits, and the whole declared grids."""
import math

import duckdb
import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tollcast.operators import models, tuning

from conftest import SF001


@pytest.fixture(scope="module")
def parts(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    rows = li.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") / 1000).alias("x"), "l_discount", "l_tax",
                     F.lit(3.0).alias("flat"),
                     (F.col("l_extendedprice") / 1000 * (1 - F.col("l_discount"))).alias("label"))
    rows = VectorAssembler(inputCols=["x", "l_discount", "l_tax", "flat"], outputCol="features").transform(rows)
    train, valid = tuning.holdout(rows, F.col("l_orderkey") * 31 + F.col("l_linenumber"))
    return models.training_frame(train, ["l_orderkey", "l_linenumber"], 4).cache(), valid.cache()


COLS = ["x", "l_discount", "l_tax", "flat"]


def rmse(model, valid):
    e = model.transform(valid).select(F.sqrt(F.avg(F.pow(F.col("label") - F.col("prediction"), F.lit(2)))).alias("e"))
    return e.first().e


def test_holdout(spark):
    df = spark.createDataFrame([(i,) for i in range(-20, 100)] + [(None,)], "k long")
    train, valid = tuning.holdout(df, F.col("k"))
    assert train.count() == 96 and valid.count() == 25


def test_linear_points_equal_the_library(parts):
    train, valid = parts
    grid = {"maxIter": [50], "regParam": [0.9, 0.1], "fitIntercept": [False, True], "elasticNetParam": [0.0, 0.5, 1.0]}
    for p, error in tuning.linear_grid(train, valid, COLS, "label", grid):
        model = models.linear_regression(**{**p, "maxIter": 500, "tol": 1e-10}).fit(train)
        assert error == pytest.approx(rmse(model, valid), rel=2e-3), p
        coef, b = tuning.linear_point(tuning.moments(train, [*COLS, "label"]), p["regParam"], p["elasticNetParam"],
                                      p["fitIntercept"], 50)
        assert np.allclose(coef, model.coefficients.toArray(), rtol=5e-3, atol=5e-3), p
        assert b == pytest.approx(model.intercept, rel=5e-3, abs=5e-3)


def test_boosted_prefixes_equal_own_fits(parts):
    train, valid = parts
    grid = {"maxDepth": [2, 4], "maxIter": [1, 3, 6]}
    found = tuning.boosted_grid(models.gradient_boosted(), train, valid, grid)
    assert len(found) == 6
    for p, error in found:
        assert error == pytest.approx(rmse(models.gradient_boosted(**p).fit(train), valid), rel=1e-9)


def test_forest_parts_against_the_stored_trees(parts):
    """The whole forest equals its own prediction; prefixes and cuts equal a plain walk of its trees."""
    train, valid = parts
    grid = {"maxDepth": [1, 2, 5], "maxBins": [8, 16], "numTrees": [1, 3, 4]}
    found = {tuple(p[k] for k in grid): e for p, e in tuning.forest_grid(models.random_forest(), train, valid, grid)}
    assert len(found) == 18
    rows = valid.select("features", "label").collect()
    for bins in (8, 16):
        model = models.random_forest(maxDepth=5, maxBins=bins, numTrees=4).fit(train)
        assert found[5, bins, 4] == pytest.approx(rmse(model, valid), rel=1e-9)
        trees = [t._call_java("rootNode") for t in model.trees]

        def walk(node, x, depth):
            while depth and node.subtreeDepth() > 0:
                split = node.split()
                node = node.leftChild() if x[split.featureIndex()] <= split.threshold() else node.rightChild()
                depth -= 1
            return node.prediction()

        some = rows[:40]
        for depth, n in ((1, 1), (2, 3), (5, 3)):
            plain = [sum(walk(t, r.features, depth) for t in trees[:n]) / n for r in some]
            few = valid.sparkSession.createDataFrame(some)
            own = {tuple(p[k] for k in grid): e for p, e in tuning.forest_grid(
                models.random_forest(), train, few, {**grid, "maxBins": [bins]})}
            want = math.sqrt(sum((r.label - z) ** 2 for r, z in zip(some, plain)) / len(some))
            assert own[depth, bins, n] == pytest.approx(want, rel=1e-9)


def test_refit_takes_the_least_error(spark, parts):
    train, valid = parts
    grid = {"maxDepth": [1, 3], "maxIter": [2, 4]}
    errors = tuning.boosted_grid(models.gradient_boosted(), train, valid, grid)
    best = tuning.refit(models.gradient_boosted(), grid, tuning.table(spark, grid, errors), train)
    assert best.getNumTrees == 4 and best.getMaxDepth() == 3


@pytest.mark.parametrize("name,fits", [("GBT_GRID", 5), ("GBT_GRID_VOLUME", 5), ("RF_GRID", 2), ("RF_GRID_VOLUME", 3),
                                       ("LR_GRID", 0), ("LR_GRID_VOLUME", 0)])
def test_tune_queries_have_every_declared_point(spark, monkeypatch, name, fits):
    """The query's rows are the declared grid, from as many fits as the README says; so are the SQL's."""
    from tollcast.plans import catalogue
    declared = getattr(models, name)
    n = math.prod(len(v) for v in declared.values())
    own = {"G": ("maxIter",), "R": ("numTrees", "maxDepth"), "L": tuple(declared)}[name[0]]
    assert len(tuning._fits(declared, own)) == max(fits, 1)
    query = f"tune_{name.lower().replace('_grid', '')}"
    seen = []
    monkeypatch.setattr(catalogue, "_tuned", lambda spark, d, grid, errors, exact=False: seen.append(grid))
    catalogue.QUERIES[query](spark, "")
    assert seen == [declared]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{SF001}/lineitem.parquet'")
    points = con.execute(catalogue.ORACLE_SQL[query]).df()[list(declared)]
    assert len(points) == len(points.drop_duplicates()) == n


def test_linear_points_on_the_feature_table(spark):
    """Elastic-net points on all numeric features of a job equal the library's fits."""
    from tollcast.plans import catalogue, modeling
    rows = modeling.training_rows(catalogue.q_volume_features(spark, SF001), ["event_type"], "volume")
    numbers = modeling.numeric_columns(rows, without=("volume", "event_type"))
    assert len(numbers) > 40
    train, valid = tuning.holdout(rows, F.expr("floor(unix_timestamp(window_start) / 1200)"))
    train, valid = (VectorAssembler(inputCols=numbers, outputCol="features").transform(x).withColumn(
        "label", F.col("volume").cast("double")) for x in (train, valid))
    grid = {"maxIter": [20], "regParam": [0.1], "fitIntercept": [False, True], "elasticNetParam": [0.0, 0.3]}
    for p, error in tuning.linear_grid(train, valid, numbers, "label", grid):
        model = models.linear_regression(**{**p, "maxIter": 500, "tol": 1e-10}).fit(train)
        assert error == pytest.approx(rmse(model, valid), rel=2e-3), p
