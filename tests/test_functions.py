"""Scalar functions: hour bucket, holiday flag, window labels, dummies."""
import datetime as dt

from pyspark.sql import functions as F

from tollcast.functions import calendar as cal
from tollcast.functions import lists
from tollcast.functions import timefns as tf


def test_hour_bucket_fixture(spark):
    df = spark.range(24).select(F.col("id").cast("int").alias("h"))
    got = [r[0] for r in df.select(cal.hour_bucket("h")).orderBy(F.col("h")).collect()]
    assert got == [0, 0, 3, 3, 3, 6, 6, 6, 9, 9, 9, 12, 12, 12, 15, 15, 15, 18, 18, 18,
                   21, 21, 21, 0]


def test_bucket_date_roll(spark):
    df = spark.createDataFrame([(dt.date(2016, 10, 18), 23), (dt.date(2016, 10, 18), 22)],
                               "d date, h int")
    got = df.select(cal.bucket_date("d", "h", roll_date=True).alias("x")).collect()
    assert [r.x for r in got] == [dt.date(2016, 10, 19), dt.date(2016, 10, 18)]


def test_holiday_fixture(spark):
    days = ["2016-09-14", "2016-09-15", "2016-09-17", "2016-09-18", "2016-09-30",
            "2016-10-01", "2016-10-07", "2016-10-08"]
    df = spark.createDataFrame([(d,) for d in days], "d string")
    got = [r[0] for r in df.select(cal.is_holiday(F.to_date("d"))).collect()]
    assert got == [0, 1, 1, 0, 0, 1, 1, 0]
    table = cal.holiday_dates(spark).collect()
    assert len(table) == 10


def test_window_label_and_parse(spark):
    df = spark.createDataFrame([("2016-10-18 08:00:00",)], "s string") \
        .select(tf.parse_ts("s").alias("ts"))
    lab = df.select(tf.window_label("ts").alias("w")).first().w
    assert lab == "[2016-10-18 08:00:00,2016-10-18 08:20:00)"
    back = df.select(tf.window_label("ts").alias("w")).select(
        tf.fmt_ts(tf.shift(tf.parse_window_start("w"), hours=-2)).alias("p")).first().p
    assert back == "2016-10-18 06:00:00"


def test_bins_align_to_20_minutes(spark):
    df = spark.createDataFrame([("2016-10-18 08:19:59",), ("2016-10-18 08:20:00",)], "s string")
    got = df.select(tf.fmt_ts(tf.bin_start(tf.parse_ts("s"))).alias("b")).collect()
    assert [r.b for r in got] == ["2016-10-18 08:00:00", "2016-10-18 08:20:00"]


def test_dummies_fixed_domain(spark):
    df = spark.createDataFrame([("2016-10-18 17:40:00",)], "s string") \
        .select(tf.parse_ts("s").alias("ts"))
    row = cal.dummies(df, "ts").first().asDict()
    assert row["Tuesday"] == 1 and row["Monday"] == 0
    assert row["hour__17"] == 1 and sum(row[f"hour__{h}"] for h in range(24)) == 1
    assert row["minute_40"] == 1 and row["minute_0"] == 0


def test_list_helpers(spark):
    df = spark.createDataFrame([("r", "1,2,3"), ("s", ""), ("t", None)], "k string, l string")
    ex = lists.explode_list(df, "l", "item").orderBy("k", "pos").collect()
    assert [(r.k, r.pos, r.item) for r in ex] == [("r", 0, "1"), ("r", 1, "2"), ("r", 2, "3")]
    flags = [r[0] for r in df.select(lists.has_many("l")).collect()]
    assert flags == [1, 0, 0]


def test_labels_do_not_move_with_the_session_zone(spark):
    """Two windows around a daylight-saving gap keep their own labels under any zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    want = ["[2024-03-10 02:20:00,2024-03-10 02:40:00)", "[2024-03-10 03:20:00,2024-03-10 03:40:00)"]
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.sql("SELECT to_timestamp_ntz(s) AS t FROM VALUES ('2024-03-10 02:20:00'), "
                           "('2024-03-10 03:20:00') AS v(s)")
            got = df.select(tf.window_label("t").alias("w"),
                            tf.fmt_ts(tf.parse_window_start(tf.window_label("t"))).alias("p")).collect()
            assert sorted(r.w for r in got) == want
            assert all(r.w[1:20] == r.p for r in got)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
