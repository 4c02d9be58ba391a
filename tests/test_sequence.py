"""Balanced ordered scans against a plain pandas computation."""
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tollcast.operators.sequence import add_sequence, ordered_scan, time_levels


def _rows(seed, sizes):
    rnd = random.Random(seed)
    rows, i = [], 0
    for key, n in sizes:
        for j in range(n):
            v = None if rnd.random() < 0.45 else float(rnd.randint(0, 100))
            rows.append((i, key, j * 10 + rnd.randint(0, 5), v))
            i += 1
    rnd.shuffle(rows)
    return rows


def _expected(rows):
    pdf = pd.DataFrame(rows, columns=["id", "k", "t", "v"]).sort_values(["k", "t", "id"])
    pdf = pdf.reset_index(drop=True)
    g = pdf.groupby("k")["v"]
    return pdf, pd.DataFrame({
        "l1": g.shift(1), "l3": g.shift(3), "n1": g.shift(-1), "fi": g.ffill(),
        "fe": g.transform(lambda s: s.shift(1).ffill()), "bi": g.bfill(),
        "be": g.transform(lambda s: s.shift(-1).bfill())})


def _same(got, exp):
    a, b = got.astype(float).reset_index(drop=True), exp.astype(float).reset_index(drop=True)
    return ((a == b) | (a.isna() & b.isna())).all()


@pytest.mark.parametrize("width", [7, 30, 400, 1 << 20])
def test_scan_matches_pandas(spark, width):
    # one hot key holding most rows, tiny keys, a single-row key
    rows = _rows(width, [(1, 150), (2, 3), (3, 40), (4, 1), (5, 9)])
    df = spark.createDataFrame(rows, "id long, k long, t long, v double")
    out = ordered_scan(df, ["k"], ["t", "id"], lags={"l1": ("v", 1), "l3": ("v", 3)},
                       leads={"n1": ("v", 1), "n4": ("v", 4)}, ffill={"fi": ("v", True), "fe": ("v", False)},
                       bfill={"bi": ("v", True), "be": ("v", False)}, bucket_width=width)
    got = out.toPandas().sort_values(["k", "t", "id"]).reset_index(drop=True)
    pdf, exp = _expected(rows)
    exp["n4"] = pdf.groupby("k")["v"].shift(-4)
    assert list(got["id"]) == list(pdf["id"])
    for c in exp.columns:
        assert _same(got[c], exp[c]), c


@pytest.mark.parametrize("width", [5, 60, 1 << 20])
def test_rows_since_a_mark(spark, width):
    rows = [(i, k, t, v, bool(v is not None and v < 15)) for i, k, t, v in _rows(9, [(1, 120), (2, 30), (3, 1)])]
    df = spark.createDataFrame(rows, "id long, k long, t long, v double, m boolean")
    out = ordered_scan(df, ["k"], ["t", "id"], since={"n": ("m", "v")}, bucket_width=width).toPandas()
    got = {r.id: r.n for r in out.itertuples()}
    for key in (1, 2, 3):
        count, seen = 0, False
        for i, _, _, v, m in sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0])):
            count += v is not None
            if m:
                count, seen = 0, True
            assert (got[i] == count) if seen else pd.isna(got[i])


def test_null_keys_are_a_key(spark):
    rows = [(i, None if i % 2 else 7, i, float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, k long, t long, v double")
    out = ordered_scan(df, ["k"], ["t"], lags={"l": ("v", 1)}, bucket_width=3).collect()
    assert len(out) == 20
    assert all(r.l == (r.v - 2 if r.t >= 2 else None) for r in out)


def test_global_scan_without_keys(spark):
    rows = _rows(5, [(1, 60)])
    df = spark.createDataFrame(rows, "id long, k long, t long, v double")
    out = ordered_scan(df, [], ["t", "id"], lags={"l1": ("v", 1)}, bucket_width=40)
    pdf = pd.DataFrame(rows, columns=["id", "k", "t", "v"]).sort_values(["t", "id"])
    assert _same(out.toPandas().sort_values(["t", "id"])["l1"], pdf["v"].shift(1))


def test_order_without_time_or_integer_needs_buckets(spark):
    df = spark.createDataFrame([("a", 1.0)], "o string, v double")
    with pytest.raises(ValueError):
        ordered_scan(df, [], ["o"], lags={"l": ("v", 1)})
    assert ordered_scan(df, [], ["o"], lags={"l": ("v", 1)}, buckets=[F.substring("o", 1, 1)]).count() == 1


def test_add_sequence_dense_and_ordered(spark):
    df = spark.range(0, 1000).selectExpr("id", "(id * 7919) % 1000 AS o")
    out = add_sequence(df, ["o", "id"], num_partitions=9).toPandas()
    out = out.sort_values("_seq")
    assert out["_seq"].tolist() == list(range(1000))
    assert out["o"].is_monotonic_increasing


def test_volume_job_partition_invariant(spark):
    """The flagship job gives the same rows under any partitioning."""
    from tollcast.plans import catalogue as C
    from conftest import SF001
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        got = []
        for parts in (1, 4, 17):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            got.append(sorted(map(tuple, C.q_volume_features(spark, SF001).collect()), key=repr))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got[0] == got[1] == got[2]


def test_weighted_sequence(spark):
    df = spark.range(0, 300).selectExpr("id", "(id * 37) % 300 AS o", "id % 4 AS w")
    out = add_sequence(df, ["o"], num_partitions=5, weight="w").toPandas().sort_values("o")
    assert out["_seq"].tolist() == (out["w"].cumsum() - out["w"]).tolist()


def _tied_rows(seed, n):
    """Half of all rows in one hour of one key, a third of those at one instant."""
    import datetime as dt
    rnd, rows = random.Random(seed), []
    hot = dt.datetime(2024, 1, 1, 5)
    for i in range(n):
        if i % 2:
            ts, key = hot + dt.timedelta(seconds=0 if i % 3 == 0 else rnd.randint(0, 3599)), 1
        else:
            ts, key = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randint(0, 200_000)), rnd.choice((1, 2, 3))
        rows.append((i, key, ts, None if rnd.random() < 0.4 else float(rnd.randint(0, 100))))
    return rows


def _levels(kind):
    time = time_levels("t", "id", 16)
    return {"seconds": time[:2], "ties": time, "one": time[:1],
            "days": [[F.to_date("t")], [F.hour("t")], *time[1:]]}[kind]


@pytest.mark.parametrize("kind", ["one", "seconds", "ties", "days"])
def test_levels_match_pandas(spark, kind):
    rows = _tied_rows(3, 600)
    df = spark.createDataFrame(rows, "id long, k long, t timestamp_ntz, v double")
    df = df.withColumn("m", F.coalesce(F.col("v") < 15, F.lit(False)))
    scan = {"lags": {"l1": ("v", 1), "l3": ("v", 3), "l9": ("v", 9)}, "leads": {"n1": ("v", 1), "n4": ("v", 4)},
            "ffill": {"fi": ("v", True), "fe": ("v", False)}, "bfill": {"bi": ("v", True), "be": ("v", False)},
            "since": {"n": ("m", "v")}}
    got = ordered_scan(df, ["k"], ["t", "id"], levels=_levels(kind), **scan).toPandas()
    got = got.sort_values(["k", "t", "id"]).reset_index(drop=True)
    pdf, exp = _expected(rows)
    exp["n4"], exp["l9"] = pdf.groupby("k")["v"].shift(-4), pdf.groupby("k")["v"].shift(9)
    assert list(got["id"]) == list(pdf["id"])
    for c in exp.columns:
        assert _same(got[c], exp[c]), c
    flat = ordered_scan(df, ["k"], ["t", "id"], buckets=[F.lit(0)], since=scan["since"]).toPandas()
    flat = flat.sort_values(["k", "t", "id"]).reset_index(drop=True)
    assert flat["n"].notna().any() and _same(got["n"], flat["n"])


def test_levels_with_null_keys_and_ties(spark):
    rows = [(None if i % 5 == 0 else i, None if i % 2 else 7, i) for i in range(1, 60)]
    df = spark.createDataFrame(rows, "id long, k long, v long").withColumn("t", F.lit("2024-01-01").cast("timestamp_ntz"))
    out = ordered_scan(df, ["k"], ["t", "id", "v"], levels=time_levels("t", "id", 4), lags={"l": ("v", 1)}).collect()
    for key in (None, 7):
        mine = sorted((r for r in out if r.k == key), key=lambda r: (r.id is not None, r.id or 0, r.v))
        assert [r.l for r in mine] == [None] + [r.v for r in mine][:-1]


def test_levels_spread_a_hot_hour(spark):
    """A key's hour with half of all rows, a third of them at one instant: no task holds more than a few per cent."""
    n, parts = 40_000, 64
    ts = F.expr("timestamp_ntz '2024-01-01 05:00:00' + make_dt_interval(0, 0, 0, "
                "CASE WHEN id % 2 = 0 THEN id * 7 WHEN id % 3 = 0 THEN 0 ELSE id % 3600 END)")
    df = spark.range(n).select("id", F.when(F.col("id") % 2 == 0, F.col("id") % 97).otherwise(1).alias("k"), ts.alias("t"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        spark.conf.set("spark.sql.adaptive.enabled", "false")

        def largest(**cut):
            out = ordered_scan(df, ["k"], ["t", "id"], lags={"l": ("id", 1)}, **cut)
            # the look-up is used, or the scan would be pruned
            sizes = out.groupBy(F.spark_partition_id().alias("p")).agg(
                F.count(F.lit(1)).alias("rows"), F.max("l")).toPandas()["rows"]
            assert sizes.sum() == n
            return sizes.max() / n

        assert largest(bucket_hours=1) > 0.45
        assert largest(levels=time_levels("t", "id", 64)) < 0.05
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("whole", [1, 20, 1000])
def test_whole_keys_match_cut_ones(spark, whole):
    rows = [(i, None if k == 4 else k, t, v, bool(v is not None and v < 15))
            for i, k, t, v in _rows(whole, [(1, 150), (2, 3), (3, 40), (4, 9)])]
    df = spark.createDataFrame(rows, "id long, k long, t long, v double, m boolean")
    scan = {"lags": {"l3": ("v", 3)}, "leads": {"n2": ("v", 2)}, "ffill": {"fi": ("v", True), "fe": ("v", False)},
            "bfill": {"bi": ("v", True), "be": ("v", False)}, "since": {"n": ("m", "v")}}
    a, b = (sorted(map(repr, ordered_scan(df, ["k"], ["t", "id"], bucket_width=30, whole_keys=n, **scan).collect()))
            for n in (0, whole))
    assert a == b and len(b) == 202


def test_a_large_key_is_cut_and_small_ones_have_no_summaries(spark):
    """Many keys of a few rows each: no bucket is made for them."""
    from tollcast.operators import sequence
    seen, original = [], sequence._carries

    def watched(summary, *args):
        seen.append(summary.count())
        return original(summary, *args)
    df = spark.range(4000).selectExpr("IF(id < 1000, -1, id % 600) AS k", "id * 1000 AS t", "id", "double(id) AS v")
    sequence._carries = watched
    try:
        out = ordered_scan(df, ["k"], ["t"], lags={"l": ("v", 1)}, bucket_width=100_000, whole_keys=100)
    finally:
        sequence._carries = original
    assert seen == [10]
    assert out.count() == 4000 and out.filter("l IS NULL").count() == 601
