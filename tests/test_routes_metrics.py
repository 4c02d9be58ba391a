"""Route features golden values, CSV formats, metrics, models."""
import pytest
from pyspark.sql import functions as F

from tollcast.operators import metrics, models, routes
from tollcast.session import scratch_path
from tollcast.sources.csv import SCHEMAS, read_csv

from conftest import SF001

# The traffic task's link table (link_id, length, width, lanes,
# in_top, out_top, lane_width) and route table (intersection, tollgate, link list).
LINKS = [
    ("100", 58, 3, 1, "105", "111", 3), ("101", 84, 3, 1, "116", "121", 3),
    ("102", 131, 9, 3, "115", "109", 3), ("103", 23, 12, 4, "111", "122,116", 3),
    ("104", 293, 9, 3, "109", "112", 3), ("105", 78, 6, 2, "", "100", 3),
    ("106", 15, 3, 1, "121", "113", 3), ("107", 34, 9, 3, "123", "108", 3),
    ("108", 40, 9, 3, "107", "119,120", 3), ("109", 135, 9, 3, "102", "104", 3),
    ("110", 109, 9, 3, "", "123", 3), ("111", 121, 12, 4, "100,112", "103", 3),
    ("112", 199, 9, 3, "104", "111", 3), ("113", 144, 6, 2, "106", "", 3),
    ("114", 198, 3, 1, "119", "118", 3), ("115", 107, 9, 3, "", "102", 3),
    ("116", 180, 9, 3, "118,103", "101", 3), ("117", 136, 3, 1, "120", "", 3),
    ("118", 206, 9, 3, "114", "116,122", 3), ("119", 9, 3, 1, "108", "114", 3),
    ("120", 6, 3, 1, "108", "117", 3), ("121", 118, 3, 1, "101", "106", 3),
    ("122", 197, 3, 1, "118,103", "", 3), ("123", 59, 9, 3, "110", "107", 3),
]
ROUTES = [
    ("A", 2, "110,123,107,108,120,117"),
    ("A", 3, "110,123,107,108,119,114,118,122"),
    ("B", 1, "105,100,111,103,116,101,121,106,113"),
    ("B", 3, "105,100,111,103,122"),
    ("C", 1, "115,102,109,104,112,111,103,116,101,121,106,113"),
    ("C", 3, "115,102,109,104,112,111,103,122"),
]

# Golden route features, computed independently (FIXTURES.md section 3).
GOLDEN = {
    ("A", 2): (0, 1, 384, 6, 142, 0, 242, 0, 2, 0, 4, 0),
    ("A", 3): (1, 2, 852, 8, 404, 0, 448, 0, 3, 0, 5, 0),
    ("B", 1): (2, 1, 821, 9, 275, 222, 180, 144, 4, 2, 1, 2),
    ("B", 3): (2, 1, 477, 5, 255, 78, 0, 144, 2, 1, 0, 2),
    ("C", 1): (2, 1, 1550, 12, 217, 144, 1045, 144, 3, 1, 6, 2),
    ("C", 3): (2, 1, 1206, 8, 197, 0, 865, 144, 1, 0, 5, 2),
}
COLS = ["inlink_crscount", "outlink_crscount", "length", "linkcnt", "lane1_length",
        "lane2_length", "lane3_length", "lane4_length", "lane1_count", "lane2_count",
        "lane3_count", "lane4_count"]


def _write_quoted_csv(spark, name, header, rows):
    """A CSV in the traffic files' format: header row, every value quoted."""
    path = scratch_path(spark, name)
    lines = [",".join(f'"{h}"' for h in header)]
    lines += [",".join(f'"{v}"' for v in r) for r in rows]
    spark.createDataFrame([("\n".join(lines),)], "t string").coalesce(1) \
        .write.mode("overwrite").text(path)
    return path


def test_route_features_golden(spark):
    links = read_csv(spark, _write_quoted_csv(spark, "links", SCHEMAS["links"].names, LINKS),
                     "links")
    rts = read_csv(spark, _write_quoted_csv(spark, "routes", SCHEMAS["routes"].names, ROUTES),
                   "routes")
    rl = routes.route_links(rts, routes.link_flags(links), ["intersection_id", "tollgate_id"])
    feats = routes.route_features(rl, ["intersection_id", "tollgate_id"])
    got = {(r.intersection_id, r.tollgate_id): tuple(r[c] for c in COLS)
           for r in feats.collect()}
    assert got == GOLDEN
    for v in got.values():
        assert sum(v[4:8]) == v[2] and sum(v[8:12]) == v[3]


def test_weather_csv_schema(spark):
    rows = [("2016-10-18", 0, "1015.2000", "1020.3000", "62.0000", "2.1000", "20.5000",
             "87.0000", "0.0000"),
            ("2016-10-18", 3, "1014.5000", "1019.5000", "999017.0000", "2.5000", "23.3000",
             "73.0000", "0.0000")]
    w = read_csv(spark, _write_quoted_csv(spark, "weather", SCHEMAS["weather"].names, rows),
                 "weather")
    got = w.collect()
    assert dict(w.dtypes)["date"] == "date" and dict(w.dtypes)["hour"] == "int"
    assert [r.wind_direction for r in got] == [62.0, 999017.0]


def test_mape_fixture(spark):
    df = spark.createDataFrame([(10.0, 9.0), (20.0, 25.0), (40.0, 40.0), (0.0, 1.0)],
                               "label double, prediction double")
    m = metrics.regression_metrics(df).first()
    assert m.mape == pytest.approx((0.1 + 0.25 + 0.0) / 3, abs=1e-6)
    assert m.n == 4


def test_lr_matches_sql_regression(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    df = li.select((F.col("l_extendedprice") / 1000).alias("x"),
                   (F.col("l_extendedprice") / 1000 * (1 - F.col("l_discount"))).alias("label"))
    from pyspark.ml.feature import VectorAssembler
    feats = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    m = models.linear_regression().fit(feats)
    ref = df.selectExpr("regr_slope(label, x) s", "regr_intercept(label, x) b").first()
    assert m.coefficients[0] == pytest.approx(ref.s, rel=1e-9)
    assert m.intercept == pytest.approx(ref.b, rel=1e-6, abs=1e-9)


def test_trees_beat_mean_predictor(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    df = li.select((F.col("l_extendedprice") / 1000).alias("x"), "l_discount",
                   (F.col("l_extendedprice") / 1000 * (1 - F.col("l_discount"))).alias("label"))
    from pyspark.ml.feature import VectorAssembler
    feats = VectorAssembler(inputCols=["x", "l_discount"], outputCol="features").transform(df)
    feats = feats.cache()
    for est in (models.random_forest(numTrees=10), models.gradient_boosted(maxIter=10)):
        pred = models.score(est.fit(feats), feats)
        r2 = metrics.regression_metrics(pred).first().r2
        assert r2 > 0.5


def test_encoder_pipeline(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("b", 3.0), ("c", 4.0)],
                               "cat string, v double")
    pm = models.fit_encoder(df, ["cat"], ["v"])
    out = models.vector_columns(pm.transform(df), "features", 4).orderBy("v").collect()
    # b most frequent -> index 0; a, c tie -> alphabetical; dropLast + keep bucket
    assert [r.cat_index for r in out] == [0.0, 1.0, 0.0, 2.0]
    assert [r.f_0 for r in out] == [1.0, 0.0, 1.0, 0.0]


def test_encoder_refuses_open_domains(spark):
    df = spark.range(3000).selectExpr("CAST(id AS STRING) AS cat", "1.0 AS v")
    with pytest.raises(ValueError):
        models.fit_encoder(df, ["cat"], ["v"])
    assert models.fit_encoder(df.limit(50), ["cat"], ["v"]) is not None


def test_forest_does_not_depend_on_the_inputs_partitions(spark):
    from pyspark.ml.feature import VectorAssembler
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    df = VectorAssembler(inputCols=["l_quantity", "l_tax"], outputCol="features").transform(
        li.withColumn("label", F.col("l_extendedprice")))
    keys = ["l_orderkey", "l_linenumber"]
    got, cached = [], spark.sparkContext._jsc.getPersistentRDDs().size()
    for n in (2, 7):
        frame = models.training_frame(df.repartition(n), keys, partitions=4)
        model = models.fit(models.random_forest(numTrees=3, maxDepth=4), frame)
        got.append(sorted(tuple(r) for r in models.score(model, frame, keep=keys).collect()))
    assert got[0] == got[1] and spark.sparkContext._jsc.getPersistentRDDs().size() == cached


def test_tune_fits_every_grid_point(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").limit(500)
    from pyspark.ml.feature import VectorAssembler
    df = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(
        li.withColumnRenamed("l_extendedprice", "label"))
    grid = {"regParam": [0.1, 0.5], "fitIntercept": [False, True]}
    tvs = models.tune(models.linear_regression(), grid, df, parallelism=2)
    table = models.tuning_table(spark, tvs, grid)
    assert table.count() == 4


def test_time_split_holdout(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", 1.0), ("2024-01-20 00:00:00", 2.0)],
                               "s string, v double").selectExpr(
        "to_timestamp_ntz(s) AS ts", "v")
    train, valid = models.time_split(df, "ts", "2024-01-16")
    assert [r.v for r in train.collect()] == [1.0]
    assert [r.v for r in valid.collect()] == [2.0]


def test_profile_exact_and_approx(spark):
    from tollcast.operators import profile
    df = spark.range(1, 102).selectExpr("CAST(id AS DOUBLE) AS a", "CAST(id % 7 AS DOUBLE) AS b")
    ex = {r.col_name: r for r in profile.profile(df, ["a", "b"], num_partitions=3).collect()}
    ap = {r.col_name: r for r in profile.profile(df, ["a", "b"], exact=False).collect()}
    # 1..101: quartiles by linear interpolation are 26, 51, 76
    assert (ex["a"].q25, ex["a"].q50, ex["a"].q75) == (26.0, 51.0, 76.0)
    assert ex["a"]["count"] == 101 and ex["a"]["min"] == 1.0 and ex["a"]["max"] == 101.0
    for c in ("a", "b"):
        for q in ("q25", "q50", "q75"):
            assert abs(ap[c][q] - ex[c][q]) <= 1.0


@pytest.mark.parametrize("by_pairs", [True, False])
def test_correlations_against_pandas(spark, by_pairs):
    import numpy as np
    import pandas as pd
    from tollcast.operators import profile
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.normal(1e6, 1, (900, 4)), columns=list("abcd"))
    pdf["d"] = pdf["a"] * 2 + rng.normal(0, .1, 900)
    pdf.loc[::7, "b"] = np.nan
    pdf["e"] = 5.0
    pdf["f"] = np.nan
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), ", ".join(f"{c} double" for c in pdf))
    got = {(r.col_a, r.col_b): r["corr"] for r in profile.corr_matrix(df.repartition(5), list(pdf), by_pairs=by_pairs).collect()}
    want = pdf.corr()
    for a in "abcde":
        for b in "abcde":
            if pd.isna(want.loc[a, b]):
                assert got[(a, b)] is None
            else:
                assert got[(a, b)] == pytest.approx(want.loc[a, b], abs=1e-7)
    assert not any("f" in k and v is not None for k, v in got.items())
