"""Trees fitted on cells: against the library's fits on rows and plain draws."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tollcast.operators import cells, models, tuning


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(6000).select("id", (F.pmod(F.xxhash64("id"), F.lit(1000)) / 10.0).alias("x"),
                                  (F.col("id") % 11 / 100.0).alias("z"))
    df = df.withColumn("label", F.col("x") * (1 - F.col("z")) + F.sin(F.col("id")))
    return VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(df).cache()


def test_boosted_on_cells_equals_rows(rows):
    """Predictions of the fit on cells are those of the library's fit on all rows, from few weighted rows."""
    binning = cells.binning(rows, 32)
    found = binning.cells(rows, "label")
    assert found.count() <= 32 * 11 and found.agg(F.sum("n")).first()[0] == 6000
    e = models.gradient_boosted(maxIter=5, maxDepth=4)
    want = e.fit(rows).transform(rows).select("id", F.col("prediction").alias("w"))
    got = cells.boosted(e, rows).join(want, "id")
    assert got.agg(F.max(F.abs(F.col("prediction") - F.col("w")))).first()[0] < 1e-8
    assert got.count() == 6000


def test_a_grid_of_boosted_trees_fits_no_rows(rows, monkeypatch):
    """Would have failed before: each point's fit read all rows at every level of every tree."""
    monkeypatch.setattr(models, "fit", lambda *a: pytest.fail("fitted on rows"))
    found = tuning.boosted_grid(models.gradient_boosted(), rows, rows, {"maxDepth": [2, 3], "maxIter": [2, 4]})
    assert len(found) == 4 and found[3][1] < found[0][1]


def test_a_forest_grid_fits_no_rows(rows, monkeypatch):
    """Would have failed before; the errors are near those of the library's forest."""
    grid = {"maxDepth": [2, 6], "maxBins": [16], "numTrees": [1, 40]}
    want = {tuple(p.values()): e for p, e in tuning.forest_grid(models.random_forest(), rows, rows, grid)}
    monkeypatch.setattr(models, "fit", lambda *a: pytest.fail("fitted on rows"))
    got = {tuple(p.values()): e for p, e in tuning.forest_grid(models.random_forest(), rows, rows, grid, few=100)}
    assert got.keys() == want.keys()
    for depth in (2, 6):
        point = next(k for k in got if set(k) == {depth, 16, 40})
        assert got[point] == pytest.approx(want[point], rel=0.25)


def test_draws_are_those_of_rows(rows):
    """Each row is drawn once on average, with a Poisson draw's variance, in every cell and tree."""
    binning = cells.binning(rows, 4)
    n = cells.drawn(rows, binning, "label", 200, 1.0, 7).groupBy("tree", "cell").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s")).toPandas()
    real = binning.cells(rows, "label").toPandas().set_index("cell")
    each = n.groupby("cell")
    assert np.allclose(each["n"].sum() / 200 / real["n"], 1, atol=0.05)
    assert np.allclose(each["s"].sum() / 200 / (real["n"] * real["mean"]), 1, atol=0.05)
    assert np.allclose(each["n"].var() / real["n"], 1, atol=0.5)


def test_grown_tree_by_hand():
    """Two features, the second of one bin: splits at the widest step, deeper ones inside."""
    pdf = pd.DataFrame({"tree": 0, "cell": [0, 1, 2, 3], "n": [1.0] * 4, "s": [1.0, 2.0, 9.0, 11.0]})
    out = cells.grown((4, 1), [0, 1, 2], 2, 1)(pdf)
    assert [list(c) for c in out["cuts"]] == [[5.75, 1.5, 1.0], [5.75, 1.5, 2.0], [5.75, 10.0, 9.0], [5.75, 10.0, 11.0]]


def test_many_features_are_no_cells(spark):
    names = [f"f{i}" for i in range(20)]
    df = VectorAssembler(inputCols=names, outputCol="features").transform(
        spark.range(50).select(*[(F.col("id") * 1.0).alias(n) for n in names]))
    assert cells.binning(df, 32) is None
    assert cells.thresholds({1.0: 2, 3.0: 1}, 8) == [2.0]


def test_training_partitions_grow_with_the_rows(rows, monkeypatch):
    """Would have failed before: sixteen partitions, whatever the rows."""
    assert models.training_frame(rows, ["id"]).rdd.getNumPartitions() == models.TRAIN_PARTITIONS
    monkeypatch.setattr(models, "TRAIN_ROWS", 100)
    assert models.training_frame(rows, ["id"]).rdd.getNumPartitions() == 60
    assert models.training_frame(rows, ["id"], 4).rdd.getNumPartitions() == 4
