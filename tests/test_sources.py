"""Sources and sinks: CSV round trip, schema listing, shape, head."""
import math

from pyspark.sql import functions as F

from tollcast.session import scratch_path
from tollcast.sources import csv as csvsrc
from tollcast.sources import inspect as insp


def test_csv_round_trip_keys_first(spark):
    df = spark.createDataFrame([(1, "a", 2.5), (2, "b", None)], "k int, s string, v double")
    path = scratch_path(spark, "t_csv")
    csvsrc.write_csv(df, path, key_cols=["s"])
    back = csvsrc.read_csv(spark, path, "s string, k int, v double")
    assert back.columns == ["s", "k", "v"]
    assert sorted(map(tuple, back.collect())) == [("a", 1, 2.5), ("b", 2, None)]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    got = [r.v for r in csvsrc.nan_to_null(df).collect()]
    assert got[0] is None and got[1] == 1.0
    assert not any(isinstance(x, float) and math.isnan(x) for x in got)


def test_schema_shape_head(spark):
    df = spark.createDataFrame([(3, None), (1, "x"), (2, "y")], "id long, s string")
    sch = {r.col_name: (r.data_type, r.non_null) for r in insp.schema_frame(df).collect()}
    assert sch == {"id": ("bigint", 3), "s": ("string", 2)}
    shp = insp.shape_frame(df, "t").first()
    assert (shp.n_rows, shp.n_cols) == (3, 2)
    assert [r.id for r in insp.head(df, 2, [F.col("id")]).collect()] == [1, 2]


def test_parquet_sink_partitioned_by_date_prunes(spark):
    df = spark.createDataFrame([("2016-10-18", 1.0), ("2016-10-19", 2.0), ("2016-10-19", 3.0)],
                               "d string, v double").withColumn("date", F.to_date("d")).drop("d")
    path = scratch_path(spark, "t_parquet")
    csvsrc.write_parquet(df, path, partition_by=["date"])
    back = spark.read.parquet(path).filter(F.col("date") == F.lit("2016-10-19").cast("date"))
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert sorted(r.v for r in back.collect()) == [2.0, 3.0]
