"""Training rows with vectors against the wide feature table."""
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tollcast.operators import profile, tuning
from tollcast.plans import features, modeling


def _job(spark):
    """Arguments of the job: null and repeated keys, a route and readings that are missing, a missing value."""
    start = datetime(2024, 1, 1, 5, 3)
    trips = [(k, start + timedelta(minutes=37 * i + 5 * (k or 0)), 100 * i + (k or 0), 40.0 + (i * 7 + (k or 0)) % 90)
             for k in (1, 2, 3, None) for i in range(60)]
    trips.append((2, start + timedelta(minutes=11), 9999, None))
    trips = spark.createDataFrame(trips, "k long, t timestamp_ntz, id long, v double")
    cut = F.lit("2024-01-02 05:00:00").cast("timestamp_ntz")
    weather = spark.createDataFrame([(datetime(2024, 1, 1).date(), h, 1.0 + h / 7, None if h == 9 else h)
                                     for h in (3, 6, 9, 12)], "date date, hour int, warm double, n long")
    routes = spark.createDataFrame([(1, 5, 7.5), (3, None, 2.25), (8, 6, 1.0)], "k long, links long, length double")
    return (trips.filter(F.col("t") < cut), trips.filter(F.col("t") >= cut), weather, routes), {
        "ts": "t", "keys": ["k"], "value": "v", "order_tiebreak": "id", "threshold": 100.0, "target": "y"}


@pytest.mark.parametrize("digits,with_routes", [(6, True), (None, False)])
def test_vectors_are_the_wide_tables_numbers(spark, digits, with_routes):
    (train, test, weather, routes), kw = _job(spark)
    args, o = (train, test, weather, routes if with_routes else None), features.JobOptions(digits=digits)
    wide = modeling.training_rows(features.travel_time_features(*args, **kw, options=o), ["k"], "y")
    names = modeling.numeric_columns(wide, without=("y", "k"))
    got = features.travel_time_rows(*args, **kw, options=o)
    assert got.names == names and len(names) > 40
    assert len(got.rows.columns) < 15  # a row does not carry its window's columns

    def sorted_rows(rows):
        return sorted([(r[0], str(r[1])), r[2], *r[3]] for r in rows)

    want = sorted_rows((r["k"], r["window_start"], r["y"], [float(r[c]) for c in names]) for r in wide.collect())
    have = sorted_rows(tuple(r) for r in got.vectors(got.rows).select("k", "bin_start", "y", "features").collect())
    assert [w[0] for w in want] == [h[0] for h in have] and len(want) > 150
    assert np.allclose([w[1:] for w in want], [h[1:] for h in have], rtol=0, atol=2e-6 if digits else 1e-9)


def test_reports_and_grids_of_vectors_are_those_of_columns(spark):
    args, kw = _job(spark)
    o = modeling.ModelOptions(gbt={"maxIter": 2, "maxDepth": 2}, rf={"numTrees": 2, "maxDepth": 2}, partitions=2)
    cutoff = "2024-01-02 06:00:00"
    wide = features.travel_time_features(*args, **kw)
    rows = features.travel_time_rows(*args, **kw)
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    want = {(r.model, r.part): r for r in modeling.fit_and_report(wide, ["k"], "y", cutoff, options=o).collect()}
    have = {(r.model, r.part): r for r in modeling.fit_and_report_vectors(rows, ["k"], "y", cutoff, options=o).collect()}
    assert set(want) == set(have) and len(have) == 6
    for at, w in want.items():
        assert w.n == have[at].n > 0 and w.label_sum == pytest.approx(have[at].label_sum)
    for part in ("in_sample", "holdout"):
        assert have["linear", part].rmse == pytest.approx(want["linear", part].rmse, rel=1e-4)
    assert have["boosted_trees", "in_sample"].rmse == pytest.approx(want["boosted_trees", "in_sample"].rmse, rel=1e-6)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached
    # a part without rows is still reported
    empty = modeling.fit_and_report_vectors(rows, ["k"], "y", "2030-01-01 00:00:00", options=o).collect()
    assert {(r.model, r.n, r.r2) for r in empty if r.part == "holdout"} == {
        (m, 0, None) for m in ("linear", "boosted_trees", "random_forest")}

    grid = {"maxIter": [10], "regParam": [0.5, 0.1], "fitIntercept": [False, True], "elasticNetParam": [0.0, 0.5]}
    frame = modeling.training_rows(wide, ["k"], "y")
    parts = tuning.holdout(frame, F.expr("floor(unix_timestamp(window_start) / 1200)"))
    of = tuning.holdout(rows.rows, F.expr("floor(unix_timestamp(bin_start) / 1200)"))
    a = tuning.linear_grid(*parts, rows.names, "y", grid)
    b = tuning.linear_grid(*map(rows.vectors, of), rows.names, "y", grid, vector="features")
    assert [p for p, _ in a] == [p for p, _ in b]
    assert np.allclose([e for _, e in a], [e for _, e in b], rtol=1e-6)


def test_moments_of_arrays_are_those_of_columns(spark):
    df = spark.range(0, 5000, 1, 7).selectExpr("1e6 + id % 13 AS a", "CAST(id % 7 AS DOUBLE) AS b", "3.0D AS c")
    cols = ["a", "b", "c"]
    key, largest = ["i", "j"], ["largest_x", "largest_y"]  # of a task's sums: as the rows lie
    want = profile.pair_moments(df, cols).drop(*largest).orderBy(*key).toPandas()
    for parts in (df, df.coalesce(1), df.filter("b < 0").unionAll(df)):
        have = profile.array_moments(parts, F.array(*cols)).drop(*largest).orderBy(*key).toPandas()
        assert have[key].equals(want[key]) and np.allclose(have, want, rtol=1e-9, atol=1e-5)
    assert profile.array_moments(df.filter("b < 0"), F.array(*cols)).count() == 0
