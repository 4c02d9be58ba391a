"""Sequential repairs: micro-fixtures and a plain-Python reference loop."""
import random

import pytest

from tollcast.operators.repair import outlier_repair, sentinel_repair

S = 999017.0


def loop_repair(xs, t):
    """Plain loop of the outlier rule (previous repaired, next raw)."""
    y = list(xs)
    anchored = False
    for k, x in enumerate(xs):
        if x <= t:
            anchored = True
            continue
        if not anchored:
            continue
        prev = y[k - 1]
        nxt = xs[k + 1] if k + 1 < len(xs) else None
        if prev < t:  # false for NaN, which stays
            y[k] = prev if nxt is None else (prev + nxt) / 2.0
        else:
            y[k] = prev
    return y


def loop_sentinel(xs, s=S):
    out = list(xs)
    n = len(xs)
    for k, x in enumerate(xs):
        if x != s:
            continue
        p = next((xs[j] for j in range(k - 1, -1, -1) if xs[j] != s), None)
        q = next((xs[j] for j in range(k + 1, n) if xs[j] != s), None)
        nx = xs[k + 1] if k + 1 < n else None
        if p is None and q is None:
            out[k] = x
        elif p is None:
            out[k] = q
        elif q is None:
            out[k] = p
        elif nx != s:
            out[k] = (p + nx) / 2.0
        else:
            out[k] = p
    return out


def _run(spark, fn, series, **kw):
    rows = [(key, i, float(v)) for key, xs in series.items() for i, v in enumerate(xs)]
    df = spark.createDataFrame(rows, "k long, pos long, x double")
    out = fn(df, "x", keys=["k"], order=["pos"], out="y", **kw).toPandas()
    res = {}
    for key in series:
        part = out[out.k == key].sort_values("pos")
        res[key] = part["y"].tolist()
    return res


FIXTURES = [
    ([100, 700, 200], [100, 150, 200], [100, 150, 200]),
    ([100, 700, 800, 200], [100, 450, 325, 200], [100, 450, 325, 200]),
    ([100, 1300, 1400, 200], [100, 750, 750, 200], [100, 425, 312.5, 200]),
    ([600, 700, 100], [600, 600, 100], [600, 600, 100]),
    ([100, 700, 600, 650, 200], [100, 350, 600, 600, 200], [100, 350, 600, 600, 200]),
    ([700, 800, 100], [700, 800, 100], [700, 800, 100]),
    ([100, 700], [100, 100], [100, 100]),
]


def test_outlier_fixtures(spark):
    series = {i: xs for i, (xs, _, _) in enumerate(FIXTURES)}
    one = _run(spark, outlier_repair, series, threshold=600.0, bucket_width=2)
    two = _run(spark, outlier_repair, series, threshold=600.0, passes=2, bucket_width=2)
    for i, (_, e1, e2) in enumerate(FIXTURES):
        assert one[i] == e1, (i, one[i])
        assert two[i] == e2, (i, two[i])


def test_sentinel_fixtures(spark):
    series = {0: [10, S, 20], 1: [10, S, S, 40], 2: [10, S, S, S, 30], 3: [S, S, 5, S],
              4: [S, S]}
    got = _run(spark, sentinel_repair, series, sentinel=S, bucket_width=2)
    assert got[0] == [10, 15, 20]
    assert got[1] == [10, 10, 25, 40]
    assert got[2] == [10, 10, 10, 20, 30]
    assert got[3] == [5, 5, 5, 5]
    assert got[4] == [S, S]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_outlier_random_runs(spark, seed):
    rnd = random.Random(seed)
    series = {}
    for key in range(6):
        n = rnd.choice([1, 2, 15, 80])
        xs = []
        while len(xs) < n:
            if rnd.random() < 0.3:
                xs += [rnd.choice([601.0, 700.0, 5000.0, 600.0]) for _ in range(rnd.randint(1, 12))]
            else:
                xs.append(float(rnd.choice([600, 599, 100, 10, 300])))
        series[key] = xs[:n]
    for passes in (1, 2, 3):
        got = _run(spark, outlier_repair, series, threshold=600.0, passes=passes, bucket_width=5)
        for key, xs in series.items():
            exp = xs
            for _ in range(passes):
                exp = loop_repair(exp, 600.0)
            assert got[key] == pytest.approx(exp), key


def test_sentinel_random(spark):
    rnd = random.Random(7)
    series = {k: [S if rnd.random() < 0.4 else float(rnd.randint(0, 360))
                  for _ in range(rnd.randint(1, 40))] for k in range(5)}
    got = _run(spark, sentinel_repair, series, sentinel=S, bucket_width=3)
    for key, xs in series.items():
        assert got[key] == pytest.approx(loop_sentinel(xs)), key


@pytest.mark.parametrize("width", [1, 4, 1 << 20])
def test_bucket_widths_agree_with_loop(spark, width):
    rnd = random.Random(11)
    series = {k: [float(rnd.choice([50, 99, 100, 101, 150, 400])) for _ in range(rnd.randint(1, 30))]
              for k in range(5)}
    got = _run(spark, outlier_repair, series, threshold=100.0, bucket_width=width)
    for key, xs in series.items():
        assert got[key] == pytest.approx(loop_repair(xs, 100.0)), key


INF = float("inf")


RUNS = [
    [0.0] + [600.0000000000001] * 2500 + [10.0],           # the distance halves to the last bit
    [-1.7e308] + [600.0000000000001] * 2400 + [INF, 700.0, 5.0],
    [-INF] + [700.0] * 2498 + [INF, 700.0, 800.0, 1.0],    # minus infinity stays until plus infinity
    [-INF, 700.0, 1.0], [1.0, INF, 700.0], [0.0, 700.0, -INF, 900.0]]


@pytest.mark.parametrize("passes", [1, 2, 3])
def test_runs_of_any_length_against_the_loop(spark, passes):
    got = _run(spark, outlier_repair, dict(enumerate(RUNS)), threshold=600.0, bucket_width=1000, passes=passes)
    for key, exp in enumerate(RUNS):
        for _ in range(passes):
            # a NaN, once reached, stays; in the next pass it is a missing reading and is passed over
            there = [i for i, x in enumerate(exp) if x == x]
            fixed = dict(zip(there, loop_repair([exp[i] for i in there], 600.0)))
            exp = [fixed.get(i, x) for i, x in enumerate(exp)]
        for i, (a, b) in enumerate(zip(got[key], exp)):
            assert a == b or (a != a and b != b), (key, i, a, b)


def test_missing_readings_stay_and_are_passed_over(spark):
    rows = [(0, 0, 100.0), (0, 1, 700.0), (0, 2, None), (0, 3, float("nan")), (0, 4, 800.0), (0, 5, None),
            (0, 6, 200.0)]
    df = spark.createDataFrame(rows, "k long, pos long, x double")
    for width in (2, 100):
        out = outlier_repair(df, "x", 600.0, keys=["k"], order=["pos"], out="y", bucket_width=width)
        y = [r.y for r in out.orderBy("pos").collect()]
        # 700: previous 100, next reading 800; 800: previous 450, next reading 200
        assert y[:3] == [100.0, 450.0, None] and y[3] != y[3] and y[4:] == [325.0, None, 200.0]
        s = sentinel_repair(df, "x", 800.0, keys=["k"], order=["pos"], out="y", bucket_width=width)
        z = [r.y for r in s.orderBy("pos").collect()]
        assert z[:3] == [100.0, 700.0, None] and z[3] != z[3] and z[4:] == [450.0, None, 200.0]


@pytest.mark.parametrize("key", ["a", None])
def test_no_row_is_lost_and_null_keys_repair(spark, key):
    rows = [(key, 1, 100.0), (key, 2, 700.0), (key, 3, 200.0), (None, 4, float("nan")), ("b", 5, 900.0)]
    df = spark.createDataFrame(rows, "k string, pos long, x double")
    for passes in (1, 2):
        out = outlier_repair(df, "x", 600.0, keys=["k"], order=["pos"], out="y", passes=passes).orderBy("pos").collect()
        assert len(out) == len(rows)
        assert [r.y for r in out[:3]] == [100.0, 150.0, 200.0] and out[4].y == 900.0


def _staged(df):
    from tollcast.sources.tables import written
    return written(df, "test-scan")


@pytest.mark.parametrize("passes", [1, 2])
@pytest.mark.parametrize("whole", [0, 10, 1000])
def test_whole_keys_and_a_written_scan_repair_alike(spark, passes, whole):
    """Small keys in one window each, larger ones cut, outliers alone joined: the same rows."""
    import random
    rnd = random.Random(passes)
    rows = [(i, k, i * 7200, rnd.choice([None, float("nan"), 5.0, 50.0, 150.0, 400.0, 9000.0, float("inf")]))
            for i, k in enumerate(rnd.choice([1, 1, 1, 1, 2, 3, None]) for _ in range(300))]
    df = spark.createDataFrame(rows, "id long, k long, s long, v double").selectExpr(
        "id", "k", "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s) AS t", "v")
    plain = outlier_repair(df, "v", 100.0, ["k"], ["t", "id"], passes=passes)
    fast = outlier_repair(df, "v", 100.0, ["k"], ["t", "id"], passes=passes, stage=_staged, whole_keys=whole)
    assert fast.columns == plain.columns
    a, b = ({r.id: (r.k, r.t, repr(r.v)) for r in x.collect()} for x in (plain, fast))
    assert a == b and len(b) == 300
