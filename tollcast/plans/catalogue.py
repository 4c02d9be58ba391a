"""Query catalogue: every operator run over the driver tables, with an
equivalent SQL text for an independent engine.

Output conventions (both sides): timestamps as ``yyyy-MM-dd HH:mm:ss`` text,
doubles rounded to 6 places (regression numbers to 4), counts as BIGINT.
Ties are broken by an id column so positional results are reproducible.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import timefns as tf
from ..operators import (align, bins, cells, encode, fill, joins, lags, metrics, models, profile, repair, routes,
                         states, tuning)
from ..operators.sequence import time_levels
from ..session import scratch_path
from ..sources import csv as csvsrc
from ..sources import inspect as insp
from ..sources import keyed
from ..sources.tables import table, written
from . import features, modeling
from . import standins as si

R6 = 6
R4 = 4
T_REPAIR = 100.0
SENTINEL = repair.WIND_SENTINEL
# Holiday ranges used on the January 2024 events (parameters of the flag).
EVENT_HOLIDAYS = [("2024-01-01", "2024-01-01"), ("2024-01-13", "2024-01-15")]
NUM_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# Ordered scans cut time into buckets of so many hours: every key spans many of
# them at any scale, so the SQL check covers look-ups across buckets.
BUCKET_HOURS = 6


def _s(c):
    return tf.fmt_ts(c)


def _r(c, n=R6):
    return F.round(c, n)


SQL_TS = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def _sql_ts(x: str) -> str:
    return SQL_TS.format(x)


def _sql_bucket(h: str) -> str:
    return f"CAST(floor((({h}) + 1) % 24 / 3) * 3 AS INTEGER)"


# ----------------------------------------------------------------- sources

def _csv_events(spark, d):
    """Events with quotes (JSON text), timestamps and NULLs (every tenth value)."""
    return si.events(spark, d).select(
        "event_id", "ts", "user_id", "event_type", "props",
        F.when(F.col("event_id") % 10 != 0, F.round("value", 6)).alias("value"))


def _csv_round_trip(spark, d, **how):
    path = scratch_path(spark, "src_csv")
    csvsrc.write_csv(_csv_events(spark, d), path, key_cols=["event_id"])
    back = csvsrc.read_csv(spark, path, **how)
    return back.select("event_id", F.substring(F.col("ts").cast("string"), 1, 19).alias("ts"),
                       "user_id", "event_type", "props", "value")


def q_src_csv(spark: SparkSession, d: str) -> DataFrame:
    return _csv_round_trip(spark, d, schema="event_id long, ts timestamp_ntz, user_id long, "
                                            "event_type string, props string, value double")


def q_src_csv_inferred(spark: SparkSession, d: str) -> DataFrame:
    """Types found by a pass over the files (whole numbers come back as int)."""
    out = _csv_round_trip(spark, d, infer=True)
    return out.withColumns({"event_id": F.col("event_id").cast("long"), "user_id": F.col("user_id").cast("long")})


def q_src_csv_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Lines with a broken number, a bad time or a missing field beside good ones, all accounted for."""
    ev = si.events(spark, d).select("event_id", tf.fmt_ts("ts").alias("ts"), "event_type",
                                    F.round("value", 6).cast("string").alias("value"))
    k = F.col("event_id") % 10
    line = F.concat_ws(",", F.col("event_id").cast("string"), F.when(k == 2, F.lit("noon")).otherwise(F.col("ts")),
                       F.col("event_type"), F.when(k == 3, F.lit("1.2.3")).otherwise(F.coalesce("value", F.lit(""))))
    path = scratch_path(spark, "src_csv_rejects")
    ev.select(F.when(k == 4, F.concat_ws(",", F.col("event_id").cast("string"), F.col("ts"))).otherwise(line)
              .alias("value")).write.text(path)
    rows, rejects = csvsrc.read_csv_rejects(
        spark, path, "event_id long, ts timestamp_ntz, event_type string, value double", header=False)
    good = rows.select("event_id", _s("ts").alias("ts"), "event_type", "value", F.lit(None).cast("string").alias("reason"))
    return good.unionAll(rejects.select(
        F.substring_index("line", ",", 1).cast("long"), F.lit(None).cast("string"), F.lit(None).cast("string"),
        F.lit(None).cast("double"), F.when(F.col("file") != "", F.col("reason"))))


SQL_SRC_CSV_REJECTS = f"""
SELECT event_id, CASE WHEN ok THEN {_sql_ts('ts')} END AS ts, CASE WHEN ok THEN event_type END AS event_type,
       CASE WHEN ok THEN round(value, 6) END AS value,
       CASE event_id % 10 WHEN 2 THEN 'bad ts' WHEN 3 THEN 'bad value' WHEN 4 THEN 'number of fields' END AS reason
FROM (SELECT *, event_id % 10 NOT IN (2, 3, 4) AS ok FROM events)"""

SQL_SRC_CSV = f"""
SELECT event_id, {_sql_ts('ts')} AS ts, user_id, event_type, props,
       CASE WHEN event_id % 10 <> 0 THEN round(value, 6) END AS value FROM events"""


def q_sql_project(spark: SparkSession, d: str) -> DataFrame:
    si.events(spark, d).createOrReplaceTempView("tollcast_events")
    return spark.sql("""
        SELECT event_id, user_id, event_type, round(value, 6) AS value,
               round(value, 6) AS label, date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS ts
        FROM tollcast_events""")


SQL_SQL_PROJECT = f"""
SELECT event_id, user_id, event_type, round(value, 6) AS value, round(value, 6) AS label,
       {_sql_ts('ts')} AS ts FROM events"""


def q_describe_schema(spark: SparkSession, d: str) -> DataFrame:
    return insp.schema_frame(si.events(spark, d))


_EVENT_TYPES = [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"),
                ("event_type", "string"), ("value", "double"), ("props", "string")]
SQL_DESCRIBE_SCHEMA = "\nUNION ALL\n".join(
    f"SELECT CAST({i} AS BIGINT) AS col_pos, '{n}' AS col_name, '{t}' AS data_type, "
    f"count({n}) AS non_null FROM events" for i, (n, t) in enumerate(_EVENT_TYPES))

_COUNT_COLS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6,
               "orders": 6, "lineitem": 11, "events": 6, "documents": 5, "embeddings": 3,
               "pages": 3, "benchmark": 2, "labels": 3, "conversations": 4}
_COUNT_TABLES = list(_COUNT_COLS)


def q_row_count(spark: SparkSession, d: str) -> DataFrame:
    frames = [insp.shape_frame(table(spark, d, t), t) for t in _COUNT_TABLES]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


SQL_ROW_COUNT = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST({_COUNT_COLS[t]} AS BIGINT) AS n_cols "
    f"FROM {t}" for t in _COUNT_TABLES)


def q_head_n(spark: SparkSession, d: str) -> DataFrame:
    ev = si.events(spark, d)
    return insp.head(ev, 5, ["event_id"]).select(
        "event_id", "user_id", "event_type", _r(F.col("value")).alias("value"),
        _s("ts").alias("ts"))


SQL_HEAD_N = f"""
SELECT event_id, user_id, event_type, round(value, 6) AS value, {_sql_ts('ts')} AS ts
FROM events ORDER BY event_id LIMIT 5"""


# -------------------------------------------------------- projections

def q_drop_rename(spark: SparkSession, d: str) -> DataFrame:
    o = align.drop_rename(table(spark, d, "orders"), drop=["o_orderpriority"],
                          rename={"o_totalprice": "total_price", "o_orderdate": "order_date"})
    return o.withColumn("order_date", _s("order_date"))


SQL_DROP_RENAME = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice AS total_price,
       {_sql_ts('o_orderdate')} AS order_date FROM orders"""


def q_key_first(spark: SparkSession, d: str) -> DataFrame:
    o = align.key_first(table(spark, d, "orders"), ["o_custkey", "o_orderkey"])
    return o.withColumn("o_orderdate", _s("o_orderdate"))


SQL_KEY_FIRST = f"""
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, {_sql_ts('o_orderdate')} AS o_orderdate,
       o_orderpriority FROM orders"""


def q_filter_keys(spark: SparkSession, d: str) -> DataFrame:
    ev = si.events(spark, d)
    return ev.filter((F.col("event_type") == "click") & (F.col("user_id") == 42)).select(
        "event_id", "user_id", "event_type", _r(F.col("value")).alias("value"))


SQL_FILTER_KEYS = """
SELECT event_id, user_id, event_type, round(value, 6) AS value FROM events
WHERE event_type = 'click' AND user_id = 42"""


def q_distinct_keys(spark: SparkSession, d: str) -> DataFrame:
    ev = si.events(spark, d)
    return ev.groupBy("user_id", "event_type").agg(F.min("event_id").alias("first_event_id"))


SQL_DISTINCT_KEYS = """
SELECT user_id, event_type, min(event_id) AS first_event_id FROM events GROUP BY 1, 2"""


# ------------------------------------------------------------------ bins

_SQL_BIN = "time_bucket(INTERVAL '20 minutes', ts)"


def _bins_mean(spark, d):
    return bins.bin_mean(si.events(spark, d), "ts", ["event_type"], "value", count_col="n")


def q_bin_mean(spark: SparkSession, d: str) -> DataFrame:
    b = _bins_mean(spark, d)
    return b.select(_s("bin_start").alias("bin_start"), "event_type",
                    _r(F.col("avg_value")).alias("avg_value"), "n")


SQL_BIN_MEAN = f"""
SELECT {_sql_ts('b')} AS bin_start, event_type, round(avg(value), 6) AS avg_value,
       count(*) AS n
FROM (SELECT {_SQL_BIN} AS b, event_type, value FROM events) GROUP BY b, event_type"""


def q_bin_count(spark: SparkSession, d: str) -> DataFrame:
    b = bins.bin_count(si.events(spark, d), "ts", ["event_type"])
    return b.withColumn("bin_start", _s("bin_start"))


SQL_BIN_COUNT = f"""
SELECT {_sql_ts('b')} AS bin_start, event_type, count(*) AS volume
FROM (SELECT {_SQL_BIN} AS b, event_type FROM events) GROUP BY b, event_type"""


def q_stream_bin_count(spark: SparkSession, d: str) -> DataFrame:
    """A2 as a Structured Streaming job over the events file; no watermark, so no
    row is ever late and every one is counted."""
    from ..streaming.bins import stream_bin_count
    schema = si.events(spark, d).schema
    out = stream_bin_count(spark, d, schema, "ts", ["event_type"], "events.parquet",
                           watermark=None)
    return out.withColumn("bin_start", _s("bin_start"))


def q_bin_count_fine(spark: SparkSession, d: str) -> DataFrame:
    b = bins.bin_count(si.events(spark, d), "ts", ["event_type", "user_id"])
    return b.withColumn("bin_start", _s("bin_start"))


SQL_BIN_COUNT_FINE = f"""
SELECT {_sql_ts('b')} AS bin_start, event_type, user_id, count(*) AS volume
FROM (SELECT {_SQL_BIN} AS b, event_type, user_id FROM events) GROUP BY b, event_type, user_id"""


def q_bin_offset(spark: SparkSession, d: str) -> DataFrame:
    b = bins.bin_count(si.events(spark, d), "ts", ["event_type"], offset_minutes=5,
                       label="right", bin_col="bin_label")
    return b.withColumn("bin_label", _s("bin_label"))


SQL_BIN_OFFSET = f"""
SELECT {_sql_ts('b')} AS bin_label, event_type, count(*) AS volume
FROM (SELECT time_bucket(INTERVAL '20 minutes', ts, INTERVAL '5 minutes')
             + INTERVAL '20 minutes' AS b, event_type FROM events) GROUP BY b, event_type"""


_SHIFTS = [(5, "right"), (-5, "left"), (3, "right"), (-3, "left")]


def q_bin_augmented(spark: SparkSession, d: str) -> DataFrame:
    """The plain bins and all shifted ones, from one scan."""
    b = bins.bin_count_augmented(si.events(spark, d), "ts", ["event_type"], _SHIFTS, bin_col="bin_label")
    return b.withColumn("bin_label", _s("bin_label"))


SQL_BIN_AUGMENTED = "\nUNION ALL\n".join(f"""
SELECT {_sql_ts('b')} AS bin_label, event_type, count(*) AS volume, '{off}/{label}' AS shift
FROM (SELECT time_bucket(INTERVAL '20 minutes', ts, INTERVAL '{off % 20} minutes')
             + INTERVAL '{20 if label == "right" else 0} minutes' AS b, event_type FROM events) GROUP BY b, event_type"""
                                         for off, label in [(0, "left"), *_SHIFTS])


# ------------------------------------------------------------------ lags

def _lag_select(df):
    return df.select(_s("bin_start").alias("bin_start"), "event_type",
                     _r(F.col("avg_value")).alias("avg_value"),
                     *[_r(F.col(f"lag{i}")).alias(f"lag{i}") for i in range(1, 8)])


def _lagged_by_key(spark, d):
    b = bins.bin_mean(si.events(spark, d), "ts", ["event_type"], "value")
    return lags.add_lags(b, "avg_value", 7, partition_by=["event_type"], order=["bin_start"],
                         bucket_hours=BUCKET_HOURS)


def q_lags_by_key(spark: SparkSession, d: str) -> DataFrame:
    return _lag_select(_lagged_by_key(spark, d))


def q_lags_global(spark: SparkSession, d: str) -> DataFrame:
    b = bins.bin_mean(si.events(spark, d), "ts", ["event_type"], "value")
    return _lag_select(lags.add_lags(b, "avg_value", 7, partition_by=(),
                                     order=["bin_start", "event_type"],
                                     bucket_hours=BUCKET_HOURS))


def _sql_lags(window: str) -> str:
    cols = ", ".join(f"round(lag(avg_value, {i}) OVER ({window}), 6) AS lag{i}"
                     for i in range(1, 8))
    return f"""
WITH b AS (SELECT {_SQL_BIN} AS bs, event_type, avg(value) AS avg_value
           FROM events GROUP BY 1, 2)
SELECT {_sql_ts('bs')} AS bin_start, event_type, round(avg_value, 6) AS avg_value, {cols}
FROM b"""


SQL_LAGS_BY_KEY = _sql_lags("PARTITION BY event_type ORDER BY bs")
SQL_LAGS_GLOBAL = _sql_lags("ORDER BY bs, event_type")


# ---------------------------------------------------------------- repair

def _repair_input(spark, d):
    return si.events(spark, d).select("event_id", "user_id", "ts", "value")


def _repair_out(df):
    return df.select("event_id", "user_id", _r(F.col("value")).alias("value"),
                     _r(F.col("repaired")).alias("repaired"))


def q_seq_repair(spark: SparkSession, d: str) -> DataFrame:
    r = repair.outlier_repair(_repair_input(spark, d), "value", T_REPAIR, keys=["user_id"],
                              order=["ts", "event_id"], out="repaired",
                              bucket_hours=BUCKET_HOURS)
    return _repair_out(r)


def q_seq_repair_twice(spark: SparkSession, d: str) -> DataFrame:
    r = repair.outlier_repair(_repair_input(spark, d), "value", T_REPAIR, keys=["user_id"],
                              order=["ts", "event_id"], out="repaired", passes=2,
                              bucket_hours=BUCKET_HOURS)
    return _repair_out(r)


def q_seq_repair_levels(spark: SparkSession, d: str) -> DataFrame:
    """The same repair with a key's hours cut into seconds, and instants by event."""
    r = repair.outlier_repair(_repair_input(spark, d), "value", T_REPAIR, keys=["user_id"],
                              order=["ts", "event_id"], out="repaired", levels=time_levels("ts", "event_id"))
    return _repair_out(r)


def _sql_repair_pass(name: str, src: str, t: float) -> str:
    """Recursive CTE: row by row per user, exactly the W2 recurrence."""
    return f"""
{name}_b AS (
  SELECT event_id, user_id, x,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
         lead(x) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nx, ts
  FROM {src}),
{name} AS (
  SELECT event_id, user_id, rn, x, nx, ts, x AS y, (x <= {t}) AS anchored
  FROM {name}_b WHERE rn = 1
  UNION ALL
  SELECT b.event_id, b.user_id, b.rn, b.x, b.nx, b.ts,
         CASE WHEN b.x <= {t} THEN b.x
              WHEN NOT r.anchored THEN b.x
              WHEN r.y < {t} THEN CASE WHEN b.nx IS NULL THEN r.y ELSE (r.y + b.nx) / 2.0 END
              ELSE r.y END,
         r.anchored OR b.x <= {t}
  FROM {name} r JOIN {name}_b b ON b.user_id = r.user_id AND b.rn = r.rn + 1)"""


SQL_SEQ_REPAIR = f"""
WITH RECURSIVE src AS (SELECT event_id, user_id, ts, value AS x FROM events),
{_sql_repair_pass('p1', 'src', T_REPAIR)}
SELECT p1.event_id, p1.user_id, round(e.value, 6) AS value, round(p1.y, 6) AS repaired
FROM p1 JOIN events e USING (event_id)"""

SQL_SEQ_REPAIR_TWICE = f"""
WITH RECURSIVE src AS (SELECT event_id, user_id, ts, value AS x FROM events),
{_sql_repair_pass('p1', 'src', T_REPAIR)},
src2 AS (SELECT event_id, user_id, ts, y AS x FROM p1),
{_sql_repair_pass('p2', 'src2', T_REPAIR)}
SELECT p2.event_id, p2.user_id, round(e.value, 6) AS value, round(p2.y, 6) AS repaired
FROM p2 JOIN events e USING (event_id)"""


def _with_missing(spark, d):
    """Events with NULL keys (every ninth user), NULL and NaN values."""
    v = (F.when(F.col("event_id") % 11 == 0, F.lit(None)).when(F.col("event_id") % 13 == 0, F.lit(float("nan")))
         .otherwise(F.col("value")))
    return si.events(spark, d).select(
        "event_id", F.when(F.col("user_id") % 9 != 0, F.col("user_id")).alias("user_id"), "ts", v.alias("value"))


def q_seq_repair_nulls(spark: SparkSession, d: str) -> DataFrame:
    """W2 with NULL keys and missing readings: none is lost, blanked or moved."""
    r = repair.outlier_repair(_with_missing(spark, d), "value", T_REPAIR, keys=["user_id"],
                              order=["ts", "event_id"], out="repaired", bucket_hours=BUCKET_HOURS)
    missing = F.when(F.col("value").isNull(), "null").when(F.isnan("value"), "nan").otherwise("no")
    return r.select("event_id", "user_id", missing.alias("missing"),
                    *[_r(F.when(~F.isnan(c), F.col(c))).alias(c) for c in ("value", "repaired")])


# The rule: readings that are there are repaired among themselves, key by key, NULL being a key.
SQL_SEQ_REPAIR_NULLS = f"""
WITH RECURSIVE all_rows AS (
  SELECT event_id, ts, CASE WHEN user_id % 9 <> 0 THEN user_id END AS user_id,
         CASE WHEN event_id % 11 = 0 THEN 'null' WHEN event_id % 13 = 0 THEN 'nan' ELSE 'no' END AS missing,
         CASE WHEN event_id % 11 <> 0 AND event_id % 13 <> 0 THEN value END AS value FROM events),
src AS (SELECT event_id, coalesce(user_id, -1) AS user_id, ts, value AS x FROM all_rows WHERE missing = 'no'),
{_sql_repair_pass('p1', 'src', T_REPAIR)}
SELECT a.event_id, a.user_id, a.missing, round(a.value, 6) AS value, round(p1.y, 6) AS repaired
FROM all_rows a LEFT JOIN p1 ON p1.event_id = a.event_id"""


def q_sentinel_repair(spark: SparkSession, d: str) -> DataFrame:
    ev = si.events(spark, d).select(
        "event_id", "user_id", "ts",
        F.when(F.col("event_type") == "error", F.lit(SENTINEL)).otherwise(F.col("value"))
        .alias("value"))
    r = repair.sentinel_repair(ev, "value", SENTINEL, keys=["user_id"],
                               order=["ts", "event_id"], out="repaired",
                               bucket_hours=BUCKET_HOURS)
    return _repair_out(r)


def q_lags_levels(spark: SparkSession, d: str) -> DataFrame:
    """Lags over the events of a type, of which there are few: a key's hours are cut into seconds."""
    out = lags.add_lags(si.events(spark, d).select("event_id", "event_type", "ts", "value"), "value", 7,
                        partition_by=["event_type"], order=["ts", "event_id"], levels=time_levels("ts", "event_id"))
    return out.select("event_id", "event_type", "value", *_LAG_COLS)


SQL_LAGS_LEVELS = f"""
SELECT event_id, event_type, value, {", ".join(f"lag(value, {i}) OVER w AS lag{i}" for i in range(1, 8))}
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)"""

SQL_SENTINEL_REPAIR = f"""
WITH x AS (
  SELECT event_id, user_id, ts,
         CASE WHEN event_type = 'error' THEN {SENTINEL} ELSE value END AS v FROM events),
w AS (
  SELECT *,
    last_value(CASE WHEN v <> {SENTINEL} THEN v END IGNORE NULLS) OVER (
      PARTITION BY user_id ORDER BY ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p,
    first_value(CASE WHEN v <> {SENTINEL} THEN v END IGNORE NULLS) OVER (
      PARTITION BY user_id ORDER BY ts, event_id
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS q,
    lead(v) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
  FROM x)
SELECT event_id, user_id, round(v, 6) AS value, round(
  CASE WHEN v <> {SENTINEL} THEN v
       WHEN p IS NULL AND q IS NULL THEN v
       WHEN p IS NULL THEN q
       WHEN q IS NULL THEN p
       WHEN n <> {SENTINEL} THEN (p + n) / 2.0
       ELSE p END, 6) AS repaired
FROM w"""


# ------------------------------------------------------- grids and fill

_SQL_GRID = f"""
b AS (SELECT event_type, {_SQL_BIN} AS bs, avg(value) AS avg_value FROM events GROUP BY 1, 2),
r AS (SELECT event_type, min(bs) AS lo, max(bs) AS hi FROM b GROUP BY 1),
g AS (SELECT event_type, unnest(generate_series(lo, hi, INTERVAL '20 minutes')) AS bs FROM r)"""


def q_missing_windows(spark: SparkSession, d: str) -> DataFrame:
    obs = bins.bin_count(si.events(spark, d), "ts", ["event_type"])
    m = fill.missing_windows(obs, ["event_type"])
    return m.select("event_type", _s("bin_start").alias("bin_start"))


SQL_MISSING_WINDOWS = f"""
WITH {_SQL_GRID}
SELECT event_type, {_sql_ts('bs')} AS bin_start FROM g
WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.event_type = g.event_type AND b.bs = g.bs)"""


def q_locf_grid(spark: SparkSession, d: str) -> DataFrame:
    obs = bins.bin_mean(si.events(spark, d), "ts", ["event_type"], "value")
    f = fill.locf_fill(obs, ["event_type"], "avg_value", bucket_hours=BUCKET_HOURS)
    return f.select("event_type", _s("bin_start").alias("bin_start"),
                    _r(F.col("avg_value")).alias("avg_value"), "filled")


SQL_LOCF_GRID = f"""
WITH {_SQL_GRID}
SELECT g.event_type, {_sql_ts('g.bs')} AS bin_start,
       round(last_value(b.avg_value IGNORE NULLS) OVER (
         PARTITION BY g.event_type ORDER BY g.bs
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS avg_value,
       CAST(b.avg_value IS NULL AS INTEGER) AS filled
FROM g LEFT JOIN b ON b.event_type = g.event_type AND b.bs = g.bs"""


_GRID_HOURS = (6, 7, 15, 16)


def _sparse_bins(spark, d):
    """Means per window with NULL means (windows of all-NULL values) and a NULL key."""
    ev = si.events(spark, d).select(
        "ts", F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"))
    return bins.bin_mean(ev, "ts", ["event_type"], "value")


def q_locf_grid_nulls(spark: SparkSession, d: str) -> DataFrame:
    """W4 over the forecast-input hours: an observed window is observed, whatever its mean."""
    f = fill.locf_fill(_sparse_bins(spark, d), ["event_type"], "avg_value", hours=_GRID_HOURS,
                       bucket_hours=BUCKET_HOURS)
    return f.select("event_type", _s("bin_start").alias("bin_start"),
                    _r(F.col("avg_value")).alias("avg_value"), "filled")


_SQL_SPARSE = f"""
b AS (SELECT CASE WHEN event_type <> 'error' THEN event_type END AS event_type, {_SQL_BIN} AS bs,
             avg(CASE WHEN event_id % 3 <> 0 THEN value END) AS v FROM events GROUP BY 1, 2)"""

SQL_LOCF_GRID_NULLS = f"""
WITH {_SQL_SPARSE},
r AS (SELECT event_type, min(bs) AS lo, max(bs) AS hi FROM b GROUP BY 1),
g AS (SELECT event_type, bs FROM (SELECT event_type, unnest(generate_series(lo, hi, INTERVAL '20 minutes')) AS bs
                                  FROM r) WHERE hour(bs) IN {_GRID_HOURS}),
w AS (SELECT g.event_type, g.bs, b.bs IS NOT NULL AS seen,
             last_value(b.v IGNORE NULLS) OVER (PARTITION BY g.event_type ORDER BY g.bs
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lv
      FROM g LEFT JOIN b ON b.event_type IS NOT DISTINCT FROM g.event_type AND b.bs = g.bs)
SELECT event_type, {_sql_ts('bs')} AS bin_start, round(v, 6) AS avg_value, 0 AS filled FROM b
UNION ALL
SELECT event_type, {_sql_ts('bs')} AS bin_start, round(lv, 6) AS avg_value, 1 AS filled FROM w WHERE NOT seen"""

# The window list of a forecast: all mornings first, then all afternoons (fixed parameter).
_LISTED = [f"2024-01-{day:02d} {h:02d}:{m:02d}:00" for block in ((8, 9), (17, 18))
           for day in range(16, 23) for h in block for m in (0, 20, 40)]


def q_locf_grid_positions(spark: SparkSession, d: str) -> DataFrame:
    """Given keys (also ones never observed) and a given window list, walked in the list's order."""
    users = si.events(spark, d).select((F.col("user_id") + F.lit(0)).alias("user_id")).distinct()
    key_table = users.unionByName(users.select((-F.col("user_id") - 1).alias("user_id")))
    obs = bins.bin_mean(si.events(spark, d), "ts", ["user_id"], "value")
    grid = fill.listed_grid(key_table, ["user_id"], _LISTED)
    f = fill.locf_fill(obs, ["user_id"], "avg_value", order=["position"], grid=grid, bucket_width=10)
    return f.filter("filled = 1").select("user_id", "position", _s("bin_start").alias("bin_start"),
                                         _r(F.col("avg_value")).alias("avg_value"))


SQL_LOCF_GRID_POSITIONS = f"""
WITH u AS (SELECT DISTINCT user_id FROM events),
k AS (SELECT user_id FROM u UNION ALL SELECT -user_id - 1 FROM u),
l AS (SELECT * FROM (VALUES {", ".join(f"({i}, TIMESTAMP '{t}')" for i, t in enumerate(_LISTED))}) t(position, bs)),
b AS (SELECT user_id, {_SQL_BIN} AS bs, avg(value) AS v FROM events GROUP BY 1, 2),
w AS (SELECT k.user_id, l.position, l.bs, b.bs IS NOT NULL AS seen,
             last_value(b.v IGNORE NULLS) OVER (PARTITION BY k.user_id ORDER BY l.position
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v
      FROM k, l LEFT JOIN b ON b.user_id = k.user_id AND b.bs = l.bs)
SELECT user_id, CAST(position AS INTEGER) AS position, {_sql_ts('bs')} AS bin_start, round(v, 6) AS avg_value
FROM w WHERE NOT seen"""


def q_append_sources(spark: SparkSession, d: str) -> DataFrame:
    ev = si.events(spark, d).select("event_id", "ts")
    train = ev.filter(F.col("ts") < F.lit(si.EVENTS_SPLIT).cast("timestamp_ntz"))
    test = ev.filter(F.col("ts") >= F.lit(si.EVENTS_SPLIT).cast("timestamp_ntz"))
    a = align.append_sources({"train": train, "test": test}, order=["event_id"])
    return a.select("event_id", "source", "index", "old_index")


SQL_APPEND_SOURCES = f"""
WITH u AS (
  SELECT event_id, 'train' AS source, 0 AS r FROM events WHERE ts < TIMESTAMP '{si.EVENTS_SPLIT}'
  UNION ALL
  SELECT event_id, 'test' AS source, 1 AS r FROM events WHERE ts >= TIMESTAMP '{si.EVENTS_SPLIT}')
SELECT event_id, source,
       CAST(row_number() OVER (ORDER BY r, event_id) - 1 AS BIGINT) AS "index",
       CAST(row_number() OVER (PARTITION BY r ORDER BY event_id) - 1 AS BIGINT) AS old_index
FROM u"""


# ------------------------------------------------------- time functions

def q_shift_time(spark: SparkSession, d: str) -> DataFrame:
    ev = si.events(spark, d)
    return ev.select("event_id", _s(tf.shift("ts", hours=2)).alias("plus_2h"),
                     _s(tf.shift("ts", minutes=-20)).alias("minus_20m"))


SQL_SHIFT_TIME = f"""
SELECT event_id, {_sql_ts("ts + INTERVAL '2 hours'")} AS plus_2h,
       {_sql_ts("ts - INTERVAL '20 minutes'")} AS minus_20m FROM events"""


def _labelled(spark, d):
    b = bins.bin_count(si.events(spark, d), "ts", ["event_type"])
    return b.select("event_type", tf.window_label("bin_start").alias("time_window"), "volume")


def q_time_window(spark: SparkSession, d: str) -> DataFrame:
    return _labelled(spark, d)


SQL_TIME_WINDOW = f"""
SELECT event_type, '[' || {_sql_ts('b')} || ',' || {_sql_ts("b + INTERVAL '20 minutes'")} || ')'
       AS time_window, count(*) AS volume
FROM (SELECT {_SQL_BIN} AS b, event_type FROM events) GROUP BY b, event_type"""


def q_parse_window(spark: SparkSession, d: str) -> DataFrame:
    lab = _labelled(spark, d)
    return lab.select("event_type", "time_window",
                      _s(tf.shift(tf.parse_window_start("time_window"), hours=-2))
                      .alias("forecast_start"))


SQL_PARSE_WINDOW = f"""
WITH l AS ({SQL_TIME_WINDOW})
SELECT event_type, time_window,
       {_sql_ts("strptime(substr(split_part(time_window, ',', 1), 2), '%Y-%m-%d %H:%M:%S')"
                " - INTERVAL '2 hours'")} AS forecast_start
FROM l"""


# ------------------------------------------------------------- calendar

def q_calendar_parts(spark: SparkSession, d: str) -> DataFrame:
    c = cal.calendar_parts(si.events(spark, d).select("event_id", "ts"), "ts")
    return c.select("event_id", F.col("date").cast("string").alias("date"), "weekday",
                    "hour", "minute")


SQL_CALENDAR_PARTS = """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, dayname(ts) AS weekday,
       CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute FROM events"""


def q_dummies(spark: SparkSession, d: str) -> DataFrame:
    b = bins.bin_count(si.events(spark, d), "ts", ["event_type"])
    dm = cal.dummies(b, "bin_start")
    return dm.withColumn("bin_start", _s("bin_start"))


def _sql_dummies(ts: str) -> str:
    parts = [f"CAST(dayname({ts}) = '{w}' AS INTEGER) AS {w}" for w in cal.WEEKDAYS]
    parts += [f"CAST(hour({ts}) = {h} AS INTEGER) AS hour__{h}" for h in range(24)]
    parts += [f"CAST(minute({ts}) = {m} AS INTEGER) AS minute_{m}" for m in cal.BIN_MINUTES]
    return ", ".join(parts)


SQL_DUMMIES = f"""
SELECT {_sql_ts('b')} AS bin_start, event_type, volume, {_sql_dummies('b')}
FROM (SELECT {_SQL_BIN} AS b, event_type, count(*) AS volume FROM events GROUP BY 1, 2)"""


def q_hour_bucket(spark: SparkSession, d: str) -> DataFrame:
    ev = si.events(spark, d)
    h = F.hour("ts")
    return ev.select(
        "event_id", h.cast("int").alias("hour"), cal.hour_bucket(h).alias("bucket"),
        cal.bucket_date(F.to_date("ts"), h).cast("string").alias("bucket_date"),
        cal.bucket_date(F.to_date("ts"), h, roll_date=True).cast("string")
        .alias("bucket_date_rolled"))


SQL_HOUR_BUCKET = f"""
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, {_sql_bucket('hour(ts)')} AS bucket,
       strftime(ts, '%Y-%m-%d') AS bucket_date,
       strftime(CASE WHEN hour(ts) = 23 THEN ts + INTERVAL '1 day' ELSE ts END, '%Y-%m-%d')
         AS bucket_date_rolled
FROM events"""


def q_holiday_flag(spark: SparkSession, d: str) -> DataFrame:
    """The flag two ways: a literal range test, and a join with the generated
    holiday date table (both must agree)."""
    ev = si.events(spark, d).select("event_id", F.to_date("ts").alias("d"))
    flagged = cal.holiday_flag_by_table(ev, "d", EVENT_HOLIDAYS, out="is_holiday_table")
    return flagged.select("event_id", F.col("d").cast("string").alias("date"),
                          cal.is_holiday("d", EVENT_HOLIDAYS).alias("is_holiday"),
                          "is_holiday_table")


_SQL_HOLIDAY = "CAST(" + " OR ".join(
    f"CAST(ts AS DATE) BETWEEN DATE '{lo}' AND DATE '{hi}'" for lo, hi in EVENT_HOLIDAYS
) + " AS INTEGER)"
SQL_HOLIDAY_FLAG = (f"SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, {_SQL_HOLIDAY} AS is_holiday, "
                    f"{_SQL_HOLIDAY} AS is_holiday_table FROM events")


# --------------------------------------------------------------- joins

def q_weather_join(spark: SparkSession, d: str) -> DataFrame:
    facts = bins.bin_count(si.events(spark, d), "ts", ["event_type"])
    j = joins.weather_join(facts, si.weather(spark, d), "bin_start")
    return j.select(_s("bin_start").alias("bin_start"), "event_type", "volume",
                    _r(F.col("temperature")).alias("temperature"),
                    _r(F.col("wind_speed")).alias("wind_speed"),
                    F.col("n_obs").cast("double").alias("n_obs"))


SQL_WEATHER_JOIN = f"""
WITH w AS (
  SELECT CAST(ts AS DATE) AS d, {_sql_bucket('hour(ts)')} AS h, avg(value) AS temperature,
         CASE WHEN count(*) % 7 = 0 THEN {SENTINEL} ELSE max(value) END AS wind_speed, count(*) AS n_obs
  FROM events GROUP BY 1, 2),
f AS (SELECT {_SQL_BIN} AS b, event_type, count(*) AS volume FROM events GROUP BY 1, 2),
ws AS (SELECT d, h, avg(temperature) AS temperature, avg(wind_speed) AS wind_speed,
              avg(n_obs) AS n_obs FROM w GROUP BY d, h)
SELECT {_sql_ts('f.b')} AS bin_start, f.event_type, f.volume,
       round(ws.temperature, 6) AS temperature, round(ws.wind_speed, 6) AS wind_speed,
       CAST(ws.n_obs AS DOUBLE) AS n_obs
FROM f LEFT JOIN ws ON ws.d = CAST(f.b AS DATE) AND ws.h = {_sql_bucket('hour(f.b)')}"""


_SQL_ROUTES = """
routes AS (
  SELECT l_orderkey AS o_orderkey,
         string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey, l_suppkey)
           AS link_seq
  FROM lineitem GROUP BY 1),
links AS (
  SELECT CAST(p_partkey AS VARCHAR) AS link_id, p_size AS length, p_size % 4 + 1 AS lanes,
         replace(p_name, ' ', ',') AS in_top, replace(p_type, ' ', ',') AS out_top
  FROM part),
rl AS (
  SELECT o_orderkey, generate_subscripts(string_split(link_seq, ','), 1) - 1 AS pos,
         unnest(string_split(link_seq, ',')) AS link_id
  FROM routes)"""


def q_route_links(spark: SparkSession, d: str) -> DataFrame:
    rl = routes.route_links(si.routes(spark, d), si.links(spark, d), ["o_orderkey"])
    return rl.select("o_orderkey", F.col("pos").cast("bigint").alias("pos"), "link_id",
                     "length", "lanes")


SQL_ROUTE_LINKS = f"""
WITH {_SQL_ROUTES}
SELECT rl.o_orderkey, CAST(rl.pos AS BIGINT) AS pos, rl.link_id, l.length,
       CAST(l.lanes AS INTEGER) AS lanes
FROM rl LEFT JOIN links l ON l.link_id = rl.link_id"""


def q_link_flags(spark: SparkSession, d: str) -> DataFrame:
    return routes.link_flags(si.links(spark, d)).select(
        "link_id", "in_top", "out_top", "crsin", "crsout")


SQL_LINK_FLAGS = f"""
WITH {_SQL_ROUTES}
SELECT link_id, in_top, out_top, CAST(coalesce(contains(in_top, ','), false) AS INTEGER) AS crsin,
       CAST(coalesce(contains(out_top, ','), false) AS INTEGER) AS crsout FROM links"""


def _route_features(spark, d, orders=None):
    rl = routes.route_links(si.routes(spark, d, orders), routes.link_flags(si.links(spark, d)),
                            ["o_orderkey"])
    return routes.route_features(rl, ["o_orderkey"])


def q_route_features(spark: SparkSession, d: str) -> DataFrame:
    return _route_features(spark, d)


_RF_COLS = ["inlink_crscount", "outlink_crscount", "length", "linkcnt"] + \
    [f"lane{n}_length" for n in routes.LANE_CLASSES] + \
    [f"lane{n}_count" for n in routes.LANE_CLASSES]


_SQL_ROUTE_FEATURES = ",\n".join([
    "CAST(coalesce(sum(CAST(contains(l.in_top, ',') AS INTEGER)), 0) AS BIGINT) AS inlink_crscount",
    "CAST(coalesce(sum(CAST(contains(l.out_top, ',') AS INTEGER)), 0) AS BIGINT) AS outlink_crscount",
    "CAST(coalesce(sum(l.length), 0) AS BIGINT) AS length",
    "count(*) AS linkcnt",
] + [f"CAST(coalesce(sum(CASE WHEN l.lanes = {n} THEN l.length END), 0) AS BIGINT) AS lane{n}_length"
     for n in routes.LANE_CLASSES]
  + [f"count(CASE WHEN l.lanes = {n} THEN 1 END) AS lane{n}_count" for n in routes.LANE_CLASSES])

SQL_ROUTE_FEATURES = f"""
WITH {_SQL_ROUTES}
SELECT rl.o_orderkey, {_SQL_ROUTE_FEATURES}
FROM rl LEFT JOIN links l ON l.link_id = rl.link_id GROUP BY rl.o_orderkey"""


def q_feature_join(spark: SparkSession, d: str) -> DataFrame:
    """Orders without links get NULL features, so (as after any left merge)
    the feature columns are doubles."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    j = joins.feature_join(o, _route_features(spark, d), ["o_orderkey"])
    return j.select("o_orderkey", "o_custkey", "o_totalprice",
                    *[F.col(c).cast("double").alias(c) for c in _RF_COLS])


SQL_FEATURE_JOIN = f"""
WITH {_SQL_ROUTES},
rf AS (SELECT rl.o_orderkey, {_SQL_ROUTE_FEATURES}
       FROM rl LEFT JOIN links l ON l.link_id = rl.link_id GROUP BY rl.o_orderkey)
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice,
       {", ".join(f"CAST(rf.{c} AS DOUBLE) AS {c}" for c in _RF_COLS)}
FROM orders o LEFT JOIN rf ON rf.o_orderkey = o.o_orderkey"""


def q_feature_join_stored(spark: SparkSession, d: str) -> DataFrame:
    """The same join between tables stored by key."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    found = written(_route_features(spark, d), "route-features")
    buckets = keyed.buckets_for(o, found)
    facts = keyed.store_facts(o, "orders_by_key", ["o_orderkey"], buckets)
    routes_ = keyed.store_features(found, "routes_by_key", ["o_orderkey"], buckets)
    j = keyed.stored_join(facts, routes_, ["o_orderkey"])
    return j.select("o_orderkey", "o_custkey", "o_totalprice",
                    *[F.col(c).cast("double").alias(c) for c in _RF_COLS])


# -------------------------------------------------- alignment, imputation

_TRAIN_COLS = ["event_id", "user_id", "value", "lag1", "label"]


def q_align_schema(spark: SparkSession, d: str) -> DataFrame:
    ev = si.events(spark, d)
    test = ev.filter(F.col("ts") >= F.lit(si.EVENTS_SPLIT).cast("timestamp_ntz")).select(
        "event_id", _r(F.col("value")).alias("value"), F.col("props").alias("extra"))
    return align.align_schema(test, _TRAIN_COLS, fill=0)


SQL_ALIGN_SCHEMA = f"""
SELECT event_id, 0 AS user_id, round(value, 6) AS value, 0 AS lag1, 0 AS label
FROM events WHERE ts >= TIMESTAMP '{si.EVENTS_SPLIT}'"""

_LAG_COLS = [f"lag{i}" for i in range(1, 8)]


def q_zero_impute(spark: SparkSession, d: str) -> DataFrame:
    return _lag_select(fill.zero_impute(_lagged_by_key(spark, d), _LAG_COLS))


def q_mean_impute(spark: SparkSession, d: str) -> DataFrame:
    return _lag_select(fill.mean_impute(_lagged_by_key(spark, d), _LAG_COLS))


def _sql_impute(mean: bool) -> str:
    def fill_expr(c):
        return f"coalesce({c}, avg({c}) OVER ())" if mean else f"coalesce({c}, 0)"
    inner = ", ".join(f"lag(avg_value, {i}) OVER (PARTITION BY event_type ORDER BY bs) AS lag{i}"
                      for i in range(1, 8))
    outer = ", ".join(f"round({fill_expr(c)}, 6) AS {c}" for c in _LAG_COLS)
    return f"""
WITH b AS (SELECT {_SQL_BIN} AS bs, event_type, avg(value) AS avg_value FROM events GROUP BY 1, 2),
l AS (SELECT bs, event_type, avg_value, {inner} FROM b)
SELECT {_sql_ts('bs')} AS bin_start, event_type, round(avg_value, 6) AS avg_value, {outer}
FROM l"""


SQL_ZERO_IMPUTE = _sql_impute(False)
SQL_MEAN_IMPUTE = _sql_impute(True)


# ------------------------------------------------------ profile and corr

def q_profile(spark: SparkSession, d: str) -> DataFrame:
    p = profile.profile(table(spark, d, "lineitem"), NUM_COLS)
    return p.select("col_name", "count", *[_r(F.col(c)).alias(c) for c in
                                           ["mean", "std", "min", "q25", "q50", "q75", "max"]])


SQL_PROFILE = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS col_name, count({c}) AS count, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, "
    f"round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, "
    f"round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM lineitem"
    for c in NUM_COLS)


def q_profile_merge(spark: SparkSession, d: str) -> DataFrame:
    """The profile from states of each shipping month; quantiles within the sketch's bound of the exact ranks."""
    li = table(spark, d, "lineitem")
    months = written(states.partial_states(li, F.trunc("l_shipdate", "month"), NUM_COLS), "profile-states")
    merged = states.merge_states(months)
    marks = F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(c).cast("double").alias("val")) for c in NUM_COLS])
    quartiles = ("q25", "q50", "q75")
    # exact ranks of the answers: how many values lie below, and at or below
    held = li.select(F.inline(marks)).join(F.broadcast(merged.select("col_name", *quartiles)), "col_name")
    ranks = held.groupBy("col_name").agg(F.count("val").alias("n"), *[
        F.count_if(cond).alias(f"{q}_{side}") for q in quartiles
        for side, cond in (("below", F.col("val") < F.col(q)), ("upto", F.col("val") <= F.col(q)))])
    e = F.lit(2 * states.rank_error())
    within = F.lit(True)
    for q, at in zip(quartiles, (0.25, 0.5, 0.75)):
        within = within & (F.col(f"{q}_below") / F.col("n") - e <= at) & (F.col(f"{q}_upto") / F.col("n") + e >= at)
    return merged.join(ranks, "col_name").select(
        "col_name", "count", *[_r(F.col(c), 7).alias(c) for c in ("mean", "std", "min", "max")],  # 7: no decimal ties
        within.alias("quartiles_within"))


SQL_PROFILE_MERGE = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS col_name, count({c}) AS count, round(avg({c}), 7) AS mean, round(stddev_samp({c}), 7) AS std, "
    f"round(min({c}), 7) AS min, round(max({c}), 7) AS max, true AS quartiles_within FROM lineitem" for c in NUM_COLS)


def q_corr_matrix(spark: SparkSession, d: str) -> DataFrame:
    c = profile.corr_matrix(table(spark, d, "lineitem"), NUM_COLS)
    return c.withColumn("corr", _r(F.col("corr")))


SQL_CORR_MATRIX = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
    for a in NUM_COLS for b in NUM_COLS)


# ------------------------------------------------------------------- ML

def _flag_status(spark, d):
    li = table(spark, d, "lineitem")
    return li.withColumn("flag_status", F.concat("l_returnflag", "l_linestatus"))


def q_string_index(spark: SparkSession, d: str) -> DataFrame:
    li = _flag_status(spark, d)
    m = models.index_stage("flag_status", "flag_index").fit(li)
    return m.transform(li).select("l_orderkey", "l_partkey", "l_suppkey", "flag_status",
                                  "flag_index")


_SQL_INDEX = """
fs AS (SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, l_quantity, l_discount, l_tax,
              l_returnflag || l_linestatus AS flag_status FROM lineitem),
ix AS (SELECT flag_status, CAST(row_number() OVER (ORDER BY n DESC, flag_status) - 1 AS DOUBLE)
              AS flag_index
       FROM (SELECT flag_status, count(*) AS n FROM fs GROUP BY 1))"""

SQL_STRING_INDEX = f"""
WITH {_SQL_INDEX}
SELECT l_orderkey, l_partkey, l_suppkey, fs.flag_status, ix.flag_index
FROM fs JOIN ix USING (flag_status)"""


ONEHOT_TOP = 40


def q_onehot_open(spark: SparkSession, d: str) -> DataFrame:
    """Window labels, whose number grows with history: the most frequent ones and one rest."""
    ev = si.events(spark, d).select("event_id", tf.window_label(tf.bin_start("ts")).alias("time_window"))
    known = encode.frequency_dictionary(ev, "time_window")
    out = encode.onehot_open(ev, "time_window", known, ONEHOT_TOP)
    places = vector_to_array("time_window_vec")
    return out.select("event_id", "time_window", F.col("time_window_index"), F.size(places).alias("width"),
                      (F.array_position(places, 1.0) - 1).alias("place"))


SQL_ONEHOT_OPEN = f"""
WITH e AS (SELECT event_id, '[' || {_sql_ts("time_bucket(INTERVAL '20 minutes', ts)")} || ',' ||
                  {_sql_ts("time_bucket(INTERVAL '20 minutes', ts) + INTERVAL '20 minutes'")} || ')' AS time_window FROM events),
r AS (SELECT time_window, row_number() OVER (ORDER BY count(*) DESC, time_window) - 1 AS i FROM e GROUP BY 1)
SELECT event_id, time_window, CAST(least(i, {ONEHOT_TOP}) AS DOUBLE) AS time_window_index, {ONEHOT_TOP} AS width,
       CASE WHEN i < {ONEHOT_TOP} THEN i ELSE -1 END AS place
FROM e JOIN r USING (time_window)"""


def q_onehot(spark: SparkSession, d: str) -> DataFrame:
    li = _flag_status(spark, d)
    pm = models.fit_encoder(li, ["flag_status"], [], features_col="feat",
                            handle_invalid="error")
    out = models.vector_columns(pm.transform(li), "feat", 5, prefix="oh_")
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "flag_status",
                      *[f"oh_{i}" for i in range(5)])


SQL_ONEHOT = f"""
WITH {_SQL_INDEX}
SELECT l_orderkey, l_partkey, l_suppkey, fs.flag_status,
       {", ".join(f"CASE WHEN flag_index = {i} THEN 1.0 ELSE 0.0 END AS oh_{i}" for i in range(5))}
FROM fs JOIN ix USING (flag_status)"""


def q_assemble(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    num = ["l_quantity", "l_discount", "l_tax"]
    pm = models.fit_encoder(li, ["l_returnflag"], num, handle_invalid="error")
    out = models.vector_columns(pm.transform(li), "features", 5)
    return out.select("l_orderkey", "l_partkey", "l_suppkey",
                      *[_r(F.col(f"f_{i}")).alias(f"f_{i}") for i in range(5)])


SQL_ASSEMBLE = """
WITH ix AS (SELECT l_returnflag, row_number() OVER (ORDER BY n DESC, l_returnflag) - 1 AS i
            FROM (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1))
SELECT l_orderkey, l_partkey, l_suppkey,
       CASE WHEN ix.i = 0 THEN 1.0 ELSE 0.0 END AS f_0,
       CASE WHEN ix.i = 1 THEN 1.0 ELSE 0.0 END AS f_1,
       round(l_quantity, 6) AS f_2, round(l_discount, 6) AS f_3, round(l_tax, 6) AS f_4
FROM lineitem JOIN ix USING (l_returnflag)"""


def _lr_frame(spark, d):
    """Learnable one-feature target: discounted price on list price (thousands)."""
    li = table(spark, d, "lineitem")
    x = F.col("l_extendedprice") / 1000.0
    return li.select("l_orderkey", "l_partkey", "l_suppkey", x.alias("x"),
                     (x * (1 - F.col("l_discount"))).alias("label"),
                     F.col("l_discount"))


def _lr_fit(spark, d):
    from pyspark.ml.feature import VectorAssembler
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(_lr_frame(spark, d))
    return df, models.fit(models.linear_regression(), df)


def q_lr_coefficients(spark: SparkSession, d: str) -> DataFrame:
    df, m = _lr_fit(spark, d)
    s = m.summary
    vals = [(float(m.coefficients[0]), float(m.intercept), float(s.r2),
             float(s.meanAbsoluteError), float(s.rootMeanSquaredError))]
    out = spark.createDataFrame(vals, "slope double, intercept double, r2 double, "
                                      "mae double, rmse double")
    return out.select(*[_r(F.col(c), R4).alias(c) for c in out.columns])


_SQL_LR = """
d AS (SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice / 1000.0 AS x,
             l_extendedprice / 1000.0 * (1 - l_discount) AS y FROM lineitem),
c AS (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS b, regr_r2(y, x) AS r2 FROM d),
p AS (SELECT d.*, c.s * d.x + c.b AS pred FROM d, c)"""

SQL_LR_COEFFICIENTS = f"""
WITH {_SQL_LR}
SELECT round(c.s, 4) AS slope, round(c.b, 4) AS intercept, round(c.r2, 4) AS r2,
       round(avg(abs(p.y - p.pred)), 4) AS mae, round(sqrt(avg((p.y - p.pred) ^ 2)), 4) AS rmse
FROM p, c GROUP BY c.s, c.b, c.r2"""


def _lr_pred(spark, d):
    df, m = _lr_fit(spark, d)
    return models.score(m, df, keep=["l_orderkey", "l_partkey", "l_suppkey"])


def q_lr_score(spark: SparkSession, d: str) -> DataFrame:
    p = _lr_pred(spark, d)
    # labels carry at most 7 decimals: rounding them at 4 would hit exact
    # decimal ties, which engines break differently; 8 places has none.
    return p.select("l_orderkey", "l_partkey", "l_suppkey", _r(F.col("label"), 8).alias("label"),
                    _r(F.col("prediction"), R4).alias("prediction"))


SQL_LR_SCORE = f"""
WITH {_SQL_LR}
SELECT l_orderkey, l_partkey, l_suppkey, round(y, 8) AS label, round(pred, 4) AS prediction
FROM p"""


def q_regression_metrics(spark: SparkSession, d: str) -> DataFrame:
    m = metrics.regression_metrics(_lr_pred(spark, d))
    return m.select("n", *[_r(F.col(c), R4).alias(c) for c in ["mae", "rmse", "r2", "mape"]])


SQL_REGRESSION_METRICS = f"""
WITH {_SQL_LR}
SELECT count(*) AS n, round(avg(abs(y - pred)), 4) AS mae,
       round(sqrt(avg((y - pred) ^ 2)), 4) AS rmse,
       round(1 - sum((y - pred) ^ 2) / (var_pop(y) * count(y)), 4) AS r2,
       round(avg(abs(CASE WHEN y = 0 THEN NULL ELSE (y - pred) / y END)), 4) AS mape
FROM p"""


def _tree_frame(spark, d):
    from pyspark.ml.feature import VectorAssembler
    df = _lr_frame(spark, d)
    return VectorAssembler(inputCols=["x", "l_discount"], outputCol="features").transform(df)


_LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "x", "label"]


def _tree_scores(spark, d, estimator):
    df = models.training_frame(_tree_frame(spark, d), _LINE_KEYS)
    return models.score(models.fit(estimator, df), df, keep=["l_orderkey", "l_partkey", "l_suppkey"])


def _label_range(scored):
    return scored.agg(F.struct(F.min("label").alias("lo"), F.max("label").alias("hi"))).scalar()


def q_rf_score(spark: SparkSession, d: str) -> DataFrame:
    """A forest's prediction is a mean of label means, so it lies in the labels' range."""
    p = _tree_scores(spark, d, models.random_forest())
    r = _label_range(p)
    return p.select("l_orderkey", "l_partkey", "l_suppkey", _r(F.col("label"), 8).alias("label"),
                    F.col("prediction").between(r.getField("lo") - 1e-9, r.getField("hi") + 1e-9).alias("in_range"))


SQL_RF_SCORE = f"""
WITH {_SQL_LR}
SELECT l_orderkey, l_partkey, l_suppkey, round(y, 8) AS label, true AS in_range FROM p"""


def q_gbt_score(spark: SparkSession, d: str) -> DataFrame:
    """Boosted trees: every row gets a number, and together they beat the mean label."""
    df = _tree_frame(spark, d)
    p = cells.boosted(models.gradient_boosted(), df, frame=lambda rows: models.training_frame(rows, _LINE_KEYS)).select(
        "l_orderkey", "l_partkey", "l_suppkey", "label", "prediction")
    beats = metrics.regression_metrics(p).select(F.col("r2") > 0.5).scalar()
    return p.select("l_orderkey", "l_partkey", "l_suppkey", _r(F.col("label"), 8).alias("label"),
                    (F.col("prediction").isNotNull() & ~F.isnan("prediction")).alias("scored"),
                    beats.alias("beats_mean"))


SQL_GBT_SCORE = f"""
WITH {_SQL_LR}
SELECT l_orderkey, l_partkey, l_suppkey, round(y, 8) AS label, true AS scored, true AS beats_mean FROM p"""


#: Partitions of the rows that the grids are fitted on: each level of a fit shuffles every node's
#: statistics once a partition.
TUNE_PARTITIONS = 8
#: A number made of a line's keys; eight tenths of its last digits train.
_LINE_NUMBER = "l_orderkey * 31 + l_partkey * 17 + l_suppkey"


def _parts(spark, d):
    """Lines fitted on and lines that validate."""
    return tuning.holdout(_tree_frame(spark, d), F.expr(_LINE_NUMBER))


def _tune_frame(train: DataFrame) -> DataFrame:
    """Rows dealt for a fit that needs them."""
    return models.training_frame(train, _LINE_KEYS, TUNE_PARTITIONS)


def _tuned(spark, d, grid, errors, exact: bool = False) -> DataFrame:
    """A row for each grid point, with the rows of both parts; a point beats the mean if its
    error is below the deviation of the validation labels."""
    train, valid = _parts(spark, d)
    out = tuning.table(spark, grid, errors(train, valid))
    facts = valid.agg(F.struct(F.count(F.lit(1)).alias("n"), F.stddev_pop("label").alias("dev"))).scalar()
    rmse = [_r(F.col("rmse"), R4).alias("rmse")] if exact else []
    return out.select(*grid, *rmse, train.agg(F.count(F.lit(1))).scalar().alias("n_train"),
                      facts.getField("n").alias("n_valid"), (F.col("rmse") < facts.getField("dev")).alias("beats_mean"))


_SQL_TUNE_ROWS = f"""
d AS (SELECT ({_LINE_NUMBER}) % 10 < 8 AS early, l_extendedprice / 1000.0 AS x, l_discount AS z,
             l_extendedprice / 1000.0 * (1 - l_discount) AS y FROM lineitem),
g AS (SELECT count(*) FILTER (early) AS n_train, count(*) FILTER (NOT early) AS n_valid,
             stddev_pop(y) FILTER (NOT early) AS dev FROM d)"""


def _sql_points(grid: dict) -> str:
    """The cross product of the grid's values."""
    lists = ", ".join(f"(VALUES {', '.join(f"('{v}')" for v in values)}) t{i}(\"{name}\")"
                      for i, (name, values) in enumerate(grid.items()))
    return f"SELECT {', '.join(chr(34) + n + chr(34) for n in grid)} FROM {lists}"


def _sql_grid(grid: dict) -> str:
    """Every point with the rows of both parts; every point beats the mean."""
    return f"""
WITH {_SQL_TUNE_ROWS.strip()}, pt AS ({_sql_points(grid)})
SELECT pt.*, n_train, n_valid, true AS beats_mean FROM pt, g"""


def _sql_linear_grid(grid: dict) -> str:
    """Every point of the elastic net on two columns: ridge points from the normal equations,
    the others by as many sweeps of coordinate descent as the operator makes."""
    soft = "sign({0}) * greatest(abs({0}) - l1, 0.0)"
    b1 = soft.format("(t1 - g12 * b2)") + " / (g11 + l2)"
    b2 = soft.format("(t2 - g12 * n1)") + " / (g22 + l2)"
    return f"""
WITH RECURSIVE {_SQL_TUNE_ROWS.strip()}, pt AS ({_sql_points(grid)}),
s AS (SELECT count(*) AS n, avg(x) AS mx, avg(z) AS mz, avg(y) AS my, stddev_samp(x) AS dx, stddev_samp(z) AS dz,
             stddev_samp(y) AS dy, var_pop(x) AS vx, var_pop(z) AS vz, covar_pop(x, z) AS vxz, covar_pop(x, y) AS vxy,
             covar_pop(z, y) AS vzy FROM d WHERE early),
q AS (SELECT pt.*, s.*, CASE WHEN "fitIntercept" = 'True' THEN 0 ELSE 1 END AS c,
             CAST("regParam" AS DOUBLE) * CAST("elasticNetParam" AS DOUBLE) / dy AS l1,
             CAST("regParam" AS DOUBLE) * (1 - CAST("elasticNetParam" AS DOUBLE)) / dy AS l2,
             CAST("maxIter" AS INTEGER) * {tuning.SWEEPS} AS sweeps FROM pt, s),
m AS (SELECT q.*, (vx + c * mx * mx) / (dx * dx) AS g11, (vz + c * mz * mz) / (dz * dz) AS g22,
             (vxz + c * mx * mz) / (dx * dz) AS g12, (vxy + c * mx * my) / (dx * dy) AS t1,
             (vzy + c * mz * my) / (dz * dy) AS t2 FROM q),
it AS (SELECT m.*, 0 AS k, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2 FROM m
       UNION ALL
       SELECT * EXCLUDE (n1) REPLACE (k + 1 AS k, n1 AS b1, {b2} AS b2)
       FROM (SELECT *, {b1} AS n1 FROM it WHERE k < sweeps)),
w AS (SELECT * REPLACE (CASE WHEN l1 > 0 THEN b1 ELSE (t1 * (g22 + l2) - t2 * g12) / ((g11 + l2) * (g22 + l2) - g12 * g12) END AS b1,
                        CASE WHEN l1 > 0 THEN b2 ELSE (t2 * (g11 + l2) - t1 * g12) / ((g11 + l2) * (g22 + l2) - g12 * g12) END AS b2)
      FROM it WHERE k = sweeps),
e AS (SELECT w.*, b1 * dy / dx AS wx, b2 * dy / dz AS wz FROM w),
r AS (SELECT {', '.join(chr(34) + k + chr(34) for k in grid)}, sqrt(avg((d.y - wx * d.x - wz * d.z
             - CASE WHEN c = 0 THEN my - wx * mx - wz * mz ELSE 0 END) ^ 2)) AS rmse
      FROM e, d WHERE NOT d.early GROUP BY ALL)
SELECT r.* REPLACE (round(rmse, 4) AS rmse), n_train, n_valid, rmse < dev AS beats_mean FROM r, g"""


def _linear_errors(grid):
    return lambda train, valid: tuning.linear_grid(train, valid, ["x", "l_discount"], "label", grid)


def q_tune_lr(spark: SparkSession, d: str) -> DataFrame:
    return _tuned(spark, d, models.LR_GRID, _linear_errors(models.LR_GRID), exact=True)


def q_tune_lr_volume(spark: SparkSession, d: str) -> DataFrame:
    return _tuned(spark, d, models.LR_GRID_VOLUME, _linear_errors(models.LR_GRID_VOLUME), exact=True)


def _boosted_errors(grid):
    return lambda train, valid: tuning.boosted_grid(models.gradient_boosted(), train, valid, grid, frame=_tune_frame)


def q_tune_gbt(spark: SparkSession, d: str) -> DataFrame:
    return _tuned(spark, d, models.GBT_GRID, _boosted_errors(models.GBT_GRID))


def q_tune_gbt_volume(spark: SparkSession, d: str) -> DataFrame:
    return _tuned(spark, d, models.GBT_GRID_VOLUME, _boosted_errors(models.GBT_GRID_VOLUME))


def _forest_errors(grid):
    return lambda train, valid: tuning.forest_grid(models.random_forest(), train, valid, grid, frame=_tune_frame)


def q_tune_rf(spark: SparkSession, d: str) -> DataFrame:
    return _tuned(spark, d, models.RF_GRID, _forest_errors(models.RF_GRID))


def q_tune_rf_volume(spark: SparkSession, d: str) -> DataFrame:
    return _tuned(spark, d, models.RF_GRID_VOLUME, _forest_errors(models.RF_GRID_VOLUME))


SQL_TUNE_LR = _sql_linear_grid(models.LR_GRID)
SQL_TUNE_LR_VOLUME = _sql_linear_grid(models.LR_GRID_VOLUME)
SQL_TUNE_GBT = _sql_grid(models.GBT_GRID)
SQL_TUNE_GBT_VOLUME = _sql_grid(models.GBT_GRID_VOLUME)
SQL_TUNE_RF = _sql_grid(models.RF_GRID)
SQL_TUNE_RF_VOLUME = _sql_grid(models.RF_GRID_VOLUME)


# ---------------------------------------------------- end-to-end jobs

def _round_doubles(df: DataFrame, n: int = R6) -> DataFrame:
    return df.select(*[_r(F.col(f"`{f.name}`"), n).alias(f.name)
                       if f.dataType.typeName() == "double" else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def _split_logs(spark, d):
    ev = si.events(spark, d)
    cut = F.lit(si.EVENTS_SPLIT).cast("timestamp_ntz")
    return ev.filter(F.col("ts") < cut), ev.filter(F.col("ts") >= cut)


def _volume_features(spark, d, test_rows="true") -> DataFrame:
    opts = features.JobOptions(holidays=EVENT_HOLIDAYS)
    train, test = _split_logs(spark, d)
    w = _weather(spark, d, opts)
    out = features.volume_features(train, test.filter(test_rows), w, ts="ts", keys=["event_type"],
                                   holiday_col="holiday", options=opts)
    return _round_doubles(out)


def q_volume_features(spark: SparkSession, d: str) -> DataFrame:
    return _volume_features(spark, d)


SQL_PLUS_20 = "bs + INTERVAL '20 minutes'"


# Readings of the training and then the test period, one series: a sentinel
# becomes the mean of the last good reading and the next raw one, or the one
# good reading on its side.
_SQL_WEATHER = f"""
wr AS (SELECT CAST(ts AS DATE) AS d, {_sql_bucket('hour(ts)')} AS h, avg(value) AS temperature,
              CASE WHEN count(*) % 7 = 0 THEN {SENTINEL} ELSE max(value) END AS raw_wind, count(*) AS n_obs
       FROM events GROUP BY 1, 2),
wp AS (SELECT *, lead(raw_wind) OVER o AS nx,
              last_value(CASE WHEN raw_wind <> {SENTINEL} THEN raw_wind END IGNORE NULLS) OVER (
                ORDER BY d, h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p,
              first_value(CASE WHEN raw_wind <> {SENTINEL} THEN raw_wind END IGNORE NULLS) OVER (
                ORDER BY d, h ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS q
       FROM wr WINDOW o AS (ORDER BY d, h)),
wx AS (SELECT d, h, temperature, CAST(n_obs AS DOUBLE) AS n_obs,
              CASE WHEN raw_wind <> {SENTINEL} THEN raw_wind WHEN p IS NULL AND q IS NULL THEN raw_wind
                   WHEN p IS NULL THEN q WHEN q IS NULL THEN p
                   WHEN nx <> {SENTINEL} THEN (p + nx) / 2.0 ELSE p END AS wind_speed FROM wp),"""


def _weather(spark, d, opts):
    w, cut = si.weather(spark, d), F.lit(si.EVENTS_SPLIT).cast("date")
    return features.weather_prepared(w.filter(F.col("date") < cut), w.filter(F.col("date") >= cut),
                                     sentinel_col="wind_speed", options=opts)


def _sql_volume_features(test_rows: str = "true") -> str:
    lag_cols = ", ".join(f"lag(volume, {i}) OVER w AS lag{i}" for i in range(1, 8))
    wcols = ["temperature", "wind_speed", "n_obs"]
    mean_cols = ", ".join([f"avg(lag{i}) AS lag{i}" for i in range(1, 8)] +
                          [f"avg({c}) AS {c}" for c in wcols])
    dummy_names = (cal.WEEKDAYS + [f"hour__{h}" for h in range(24)] +
                   [f"minute_{m}" for m in cal.BIN_MINUTES])
    hol = " OR ".join(f"CAST(x.bs AS DATE) BETWEEN DATE '{lo}' AND DATE '{hi}'"
                      for lo, hi in EVENT_HOLIDAYS)
    label = (f"'[' || {_sql_ts('bs')} || ',' || {_sql_ts(SQL_PLUS_20)} || ')'")
    dcols = ", ".join(dummy_names)

    def enrich(src):
        return (f"SELECT x.*, {_sql_dummies('x.bs')}, CAST({hol} AS INTEGER) AS holiday, "
                f"wx.temperature, wx.wind_speed, wx.n_obs FROM {src} x LEFT JOIN wx "
                f"ON wx.d = CAST(x.bs AS DATE) AND wx.h = {_sql_bucket('hour(x.bs)')}")
    fill_w = ", ".join(f"round(coalesce(f.{c}, m.{c}), 6) AS {c}" for c in wcols)
    tr_lags = ", ".join(f"round(coalesce(f.lag{i}, m.lag{i}), 6) AS lag{i}" for i in range(1, 8))
    te_lags = ", ".join(f"0 AS lag{i}" for i in range(1, 8))
    return f"""
WITH tr AS (SELECT {_SQL_BIN} AS bs, event_type, count(*) AS volume FROM events
            WHERE ts < TIMESTAMP '{si.EVENTS_SPLIT}' GROUP BY 1, 2),
te AS (SELECT {_SQL_BIN} AS bs, event_type, count(*) AS volume FROM events
       WHERE ts >= TIMESTAMP '{si.EVENTS_SPLIT}' AND {test_rows} GROUP BY 1, 2),
ap AS (SELECT bs, event_type, volume, 0 AS part FROM tr
       UNION ALL SELECT bs, event_type, volume, 1 AS part FROM te),
lg AS (SELECT bs, event_type, volume, {lag_cols} FROM ap
       WINDOW w AS (PARTITION BY event_type ORDER BY part, bs)),
fc AS (SELECT bs + INTERVAL '2 hours' AS bs, event_type FROM te),
{_SQL_WEATHER}
trf AS ({enrich('lg')}),
tef AS ({enrich('fc')}),
m AS (SELECT {mean_cols} FROM trf)
SELECT f.event_type, {label.replace('bs', 'f.bs')} AS time_window, f.volume, {tr_lags},
       {", ".join("f." + c for c in dummy_names)}, f.holiday, {fill_w}, 'train' AS split
FROM trf f, m
UNION ALL
SELECT f.event_type, {label.replace('bs', 'f.bs')} AS time_window, 0 AS volume, {te_lags},
       {", ".join("f." + c for c in dummy_names)}, f.holiday, {fill_w}, 'test' AS split
FROM tef f, m"""


SQL_VOLUME_FEATURES = _sql_volume_features()


def _sql_travel_time_features(test_rows: str = "true") -> str:
    """Whole task-1 job: repair (twice on train, once on test) by recursive
    CTE, bins, test grid in the forecast-input hours with walk-back fill,
    lags, forecast rows, calendar, weather, route features, alignment and
    mean fill from the training rows."""
    split = si.EVENTS_SPLIT
    hours = ", ".join(str(h) for h in features.JobOptions().grid_hours)
    lag_cols = ", ".join(f"lag(v, {i}) OVER w AS lag{i}" for i in range(1, 8))
    wcols = ["temperature", "wind_speed", "n_obs"]
    fill_cols = [f"lag{i}" for i in range(1, 8)] + wcols + _RF_COLS
    mean_cols = ", ".join(f"avg({c}) AS {c}" for c in fill_cols)
    dummy_names = (cal.WEEKDAYS + [f"hour__{h}" for h in range(24)] +
                   [f"minute_{m}" for m in cal.BIN_MINUTES])
    hol = " OR ".join(f"CAST(x.bs AS DATE) BETWEEN DATE '{lo}' AND DATE '{hi}'"
                      for lo, hi in EVENT_HOLIDAYS)
    label = f"'[' || {_sql_ts('f.bs')} || ',' || {_sql_ts('f.' + SQL_PLUS_20)} || ')'"
    rf_sel = ", ".join(f"rf.{c}" for c in _RF_COLS)

    def enrich(src):
        return (f"SELECT x.*, {_sql_dummies('x.bs')}, CAST({hol} AS INTEGER) AS is_holiday, "
                f"wx.temperature, wx.wind_speed, wx.n_obs, {rf_sel} FROM {src} x LEFT JOIN wx "
                f"ON wx.d = CAST(x.bs AS DATE) AND wx.h = {_sql_bucket('hour(x.bs)')} "
                f"LEFT JOIN rf ON rf.user_id = x.user_id")
    filled = ", ".join(f"round(coalesce(f.{c}, m.{c}), 6) AS {c}" for c in fill_cols
                       if not c.startswith("lag"))
    tr_lags = ", ".join(f"round(coalesce(f.lag{i}, m.lag{i}), 6) AS lag{i}" for i in range(1, 8))
    te_lags = ", ".join(f"round(coalesce(0, m.lag{i}), 6) AS lag{i}" for i in range(1, 8))
    dsel = ", ".join("f." + c for c in dummy_names)
    return f"""
WITH RECURSIVE
tr_src AS (SELECT event_id, user_id, ts, value AS x FROM events WHERE ts < TIMESTAMP '{split}'),
te_src AS (SELECT event_id, user_id, ts, value AS x FROM events WHERE ts >= TIMESTAMP '{split}' AND {test_rows}),
{_sql_repair_pass('a1', 'tr_src', T_REPAIR)},
a2_src AS (SELECT event_id, user_id, ts, y AS x FROM a1),
{_sql_repair_pass('a2', 'a2_src', T_REPAIR)},
{_sql_repair_pass('b1', 'te_src', T_REPAIR)},
trb AS (SELECT {_SQL_BIN} AS bs, user_id, avg(y) AS v FROM a2 GROUP BY 1, 2),
teb AS (SELECT {_SQL_BIN} AS bs, user_id, avg(y) AS v FROM b1 GROUP BY 1, 2),
rg AS (SELECT user_id, min(bs) AS lo, max(bs) AS hi FROM teb GROUP BY 1),
g AS (SELECT * FROM (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL '20 minutes')) AS bs
                     FROM rg) WHERE hour(bs) IN ({hours})),
gl AS (SELECT g.user_id, g.bs, teb.bs IS NOT NULL AS seen,
              last_value(teb.v IGNORE NULLS) OVER (PARTITION BY g.user_id ORDER BY g.bs
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fv
       FROM g LEFT JOIN teb ON teb.user_id = g.user_id AND teb.bs = g.bs),
te_all AS (SELECT bs, user_id, v FROM teb
           UNION ALL SELECT bs, user_id, fv AS v FROM gl WHERE NOT seen),
ap AS (SELECT bs, user_id, v, 0 AS part FROM trb
       UNION ALL SELECT bs, user_id, v, 1 AS part FROM te_all),
lg AS (SELECT bs, user_id, v, {lag_cols} FROM ap
       WINDOW w AS (PARTITION BY user_id ORDER BY part, bs)),
fc AS (SELECT bs + INTERVAL '2 hours' AS bs, user_id FROM te_all),
{_SQL_WEATHER}
{_SQL_ROUTES.strip()},
rf AS (SELECT rl.o_orderkey AS user_id, {_SQL_ROUTE_FEATURES}
       FROM rl LEFT JOIN links l ON l.link_id = rl.link_id GROUP BY rl.o_orderkey),
trf AS ({enrich('lg')}),
tef AS ({enrich('fc')}),
m AS (SELECT {mean_cols} FROM trf)
SELECT f.user_id, {label} AS time_window, round(f.v, 6) AS avg_travel_time, {tr_lags},
       {dsel}, f.is_holiday, {filled}, 'train' AS split
FROM trf f, m
UNION ALL
SELECT f.user_id, {label} AS time_window, 0.0 AS avg_travel_time, {te_lags},
       {dsel}, f.is_holiday, {filled}, 'test' AS split
FROM tef f, m"""


SQL_TRAVEL_TIME_FEATURES = _sql_travel_time_features()


def _travel_time_features(spark, d, test_rows="true", job=features.travel_time_features, routes_=None):
    """``job``: ``travel_time_features`` or ``travel_time_rows``; ``routes_``: the users' routes, if they are written."""
    opts = features.JobOptions(holidays=EVENT_HOLIDAYS, digits=R6)
    train, test = _split_logs(spark, d)
    w = _weather(spark, d, opts)
    return job(
        train, test.filter(test_rows), w, _user_routes(spark, d) if routes_ is None else routes_, ts="ts", keys=["user_id"], value="value",
        order_tiebreak="event_id", threshold=T_REPAIR, target="avg_travel_time",
        options=opts)


def _user_routes(spark, d) -> DataFrame:
    """Features of the routes of the events' users."""
    users = si.events(spark, d).select(F.col("user_id").alias("l_orderkey")).distinct()
    return _route_features(spark, d, users).withColumnRenamed("o_orderkey", "user_id")


def q_travel_time_features(spark: SparkSession, d: str) -> DataFrame:
    """Trips = events keyed by user, travel time = value (threshold 100);
    route features from the order whose key equals the user id."""
    return _travel_time_features(spark, d)


MODEL_CUTOFF = "2024-01-24 00:00:00"
TREES = {"gbt": {"maxIter": 10, "maxDepth": 4}, "rf": {"numTrees": 20, "maxDepth": 6}}


def _model_facts(m: DataFrame, exact: str | None = None) -> DataFrame:
    """What SQL can know: the metrics of the model that it solves by the normal
    equations, for all models the rows, the labels' sum, and whether the fit beats the mean."""
    solved = F.col("model") == F.lit(exact)
    figures = [_r(F.when(solved, F.col(c)), R4).alias(c) for c in ("mae", "rmse", "r2")] if exact else []
    return m.select("model", "part", "n", _r(F.col("label_sum"), 1).alias("label_sum"), *figures,
                    F.when(F.col("part") == "in_sample", F.col("r2") > 0).alias("beats_mean"))


def q_volume_model(spark: SparkSession, d: str) -> DataFrame:
    """Task 2 as a whole, on the key one-hot encoded and all numeric features, and a linear model on two of them that SQL can solve."""
    m = modeling.fit_and_report(
        q_volume_features(spark, d), ["event_type"], "volume", MODEL_CUTOFF,
        options=modeling.ModelOptions(**TREES, categories=("event_type",), linear_subset=["lag1", "temperature"]))
    return _model_facts(m, "linear_subset")


_SQL_PARTS = f"""
r AS (SELECT *, strptime(substr(time_window, 2, 19), '%Y-%m-%d %H:%M:%S') < TIMESTAMP '{MODEL_CUTOFF}' AS early
      FROM f WHERE split = 'train'),"""
_SQL_MODELS = "(VALUES ('linear'), ('boosted_trees'), ('random_forest')) m(model)"

SQL_VOLUME_MODEL = f"""
WITH f AS ({SQL_VOLUME_FEATURES}),{_SQL_PARTS}
c AS (SELECT covar_pop(lag1, volume) AS c1y, covar_pop(temperature, volume) AS c2y, covar_pop(lag1, temperature) AS c12,
             var_pop(lag1) AS c11, var_pop(temperature) AS c22, avg(lag1) AS ma, avg(temperature) AS mb, avg(volume) AS my
      FROM r WHERE early),
k AS (SELECT (c1y * c22 - c2y * c12) / (c11 * c22 - c12 * c12) AS ka, (c2y * c11 - c1y * c12) / (c11 * c22 - c12 * c12) AS kb, * FROM c),
p AS (SELECT r.early, r.volume AS y, my + ka * (lag1 - ma) + kb * (temperature - mb) AS z FROM r, k),
g AS (SELECT early, count(*) AS n, sum(y) AS label_sum, avg(abs(y - z)) AS mae, sqrt(avg((y - z) ^ 2)) AS rmse,
             1 - sum((y - z) ^ 2) / (var_pop(y) * count(*)) AS r2 FROM p GROUP BY 1)
SELECT model, CASE WHEN early THEN 'in_sample' ELSE 'holdout' END AS part, n, round(label_sum, 1) AS label_sum,
       CASE WHEN model = 'linear_subset' THEN round(mae, 4) END AS mae, CASE WHEN model = 'linear_subset' THEN round(rmse, 4) END AS rmse,
       CASE WHEN model = 'linear_subset' THEN round(r2, 4) END AS r2, CASE WHEN early THEN true END AS beats_mean
FROM g, (SELECT model FROM {_SQL_MODELS} UNION ALL SELECT 'linear_subset')"""


def q_travel_time_model(spark: SparkSession, d: str) -> DataFrame:
    """Task 1 as a whole, on all numeric features."""
    rows = _travel_time_features(spark, d, job=features.travel_time_rows)
    m = modeling.fit_and_report_vectors(rows, ["user_id"], "avg_travel_time", MODEL_CUTOFF,
                                        options=modeling.ModelOptions(**TREES))
    return _model_facts(m)


SQL_TRAVEL_TIME_MODEL = f"""
WITH f AS ({SQL_TRAVEL_TIME_FEATURES}),{_SQL_PARTS}
g AS (SELECT early, count(*) AS n, sum(avg_travel_time) AS label_sum FROM r WHERE avg_travel_time IS NOT NULL GROUP BY 1)
SELECT model, CASE WHEN early THEN 'in_sample' ELSE 'holdout' END AS part, n, round(label_sum, 1) AS label_sum,
       CASE WHEN early THEN true END AS beats_mean
FROM g, {_SQL_MODELS}"""

#: Windows to forecast: seven mornings, then seven afternoons, from the first test day.
FORECAST_WINDOWS = [f"2024-01-{day} {h:02d}:{m:02d}:00" for hours in ((8, 9), (17, 18)) for day in range(16, 23)
                    for h in hours for m in cal.BIN_MINUTES]
#: Test rows that are known: the two hours before each block of windows.
_KNOWN_HOURS = f"hour(ts) IN ({', '.join(map(str, features.JobOptions().grid_hours))})"
_SUBSET = ["lag1", "temperature"]


def _forecasts(f: DataFrame, key: str, label: str, exogenous, key_table: DataFrame, **buckets) -> DataFrame:
    """A linear model on two features, whose recursion SQL can follow, and a forest on all of
    them, whose predictions lie in the labels' range."""
    everything = modeling.numeric_columns(f, without=(label, key))
    out = modeling.forecast(f, [key], label, FORECAST_WINDOWS, exogenous, {
        "linear": (_SUBSET, models.linear_regression(label)),
        "random_forest": (everything, models.random_forest(label, **TREES["rf"]))}, key_table=key_table, **buckets)
    return _forecast_facts(out, f.filter((F.col("split") == "train") & F.col(label).isNotNull()), key, label)


def _forecast_facts(out: DataFrame, known: DataFrame, key: str, label: str) -> DataFrame:
    """The linear model's predictions, and whether the forest's lie within the known labels."""
    r = known.agg(F.struct(F.min(label).alias("lo"), F.max(label).alias("hi"))).scalar()
    linear, y = F.col("model") == "linear", F.col(label)
    return out.select("model", key, "time_window", F.when(linear, _r(y, R4)).alias(label),
                      F.when(~linear, y.between(r.getField("lo") - 1e-9, r.getField("hi") + 1e-9)).alias("in_range"))


def q_volume_forecast(spark: SparkSession, d: str) -> DataFrame:
    """Counts of the 84 listed windows for every key, each from the prediction before it."""
    opts = features.JobOptions(holidays=EVENT_HOLIDAYS)
    w = _weather(spark, d, opts)
    return _forecasts(_volume_features(spark, d, _KNOWN_HOURS), "event_type", "volume",
                      lambda g: features.calendar_weather(g, w, opts, "holiday"), si.events(spark, d))


def q_travel_time_forecast(spark: SparkSession, d: str) -> DataFrame:
    """Mean times of the 84 listed windows for every key, each from the prediction before it."""
    opts, label = features.JobOptions(holidays=EVENT_HOLIDAYS), "avg_travel_time"
    w, ev = _weather(spark, d, opts), si.events(spark, d)
    routes_ = written(_user_routes(spark, d), "user-routes")
    rows = _travel_time_features(spark, d, _KNOWN_HOURS, features.travel_time_rows, routes_)
    out = modeling.forecast_vectors(
        rows, ["user_id"], label, FORECAST_WINDOWS, lambda g: features.calendar_weather(g, w, opts, "is_holiday"), routes_,
        (_SUBSET, models.linear_regression(label)), ("random_forest", models.random_forest(label, **TREES["rf"])), ev,
        method="window")
    return _forecast_facts(out, rows.rows, "user_id", label)


def _sql_forecast(features_sql: str, key: str, label: str) -> str:
    from ..operators.forecast import blocks
    listed = ", ".join(f"(TIMESTAMP '{w}', {s}, TIMESTAMP '{b}')" for w, s, b in blocks(FORECAST_WINDOWS))
    window = f"'[' || {_sql_ts('bs')} || ',' || {_sql_ts(SQL_PLUS_20)} || ')'"
    step = "my + ka * (coalesce({0}, ma) - ma) + kb * (coalesce(g.temperature, mb) - mb)"
    return f"""
WITH RECURSIVE {_SQL_WEATHER.strip()}
f AS ({features_sql}),
r AS (SELECT *, strptime(substr(time_window, 2, 19), '%Y-%m-%d %H:%M:%S') AS bs FROM f
      WHERE split = 'train' AND {label} IS NOT NULL),
c AS (SELECT covar_pop(lag1, {label}) AS c1y, covar_pop(temperature, {label}) AS c2y, covar_pop(lag1, temperature) AS c12,
             var_pop(lag1) AS c11, var_pop(temperature) AS c22, avg(lag1) AS ma, avg(temperature) AS mb, avg({label}) AS my FROM r),
k AS (SELECT (c1y * c22 - c2y * c12) / (c11 * c22 - c12 * c12) AS ka, (c2y * c11 - c1y * c12) / (c11 * c22 - c12 * c12) AS kb, * FROM c),
w(bs, step, block) AS (VALUES {listed}),
ky AS (SELECT DISTINCT {key} FROM events),
g AS (SELECT ky.{key}, w.*, wx.temperature FROM ky CROSS JOIN w
      LEFT JOIN wx ON wx.d = CAST(w.bs AS DATE) AND wx.h = {_sql_bucket('hour(w.bs)')}),
og AS (SELECT b.{key}, b.block, arg_max(r.{label}, r.bs) AS lag1 FROM (SELECT DISTINCT {key}, block FROM g) b
       LEFT JOIN r ON r.{key} = b.{key} AND r.bs < b.block GROUP BY 1, 2),
p AS (SELECT g.{key}, g.bs, g.block, g.step, {step.format('og.lag1')} AS z
      FROM g JOIN og ON og.{key} = g.{key} AND og.block = g.block, k WHERE g.step = 1
      UNION ALL
      SELECT g.{key}, g.bs, g.block, g.step, {step.format('p.z')} AS z
      FROM p JOIN g ON g.{key} = p.{key} AND g.block = p.block AND g.step = p.step + 1, k)
SELECT 'linear' AS model, {key}, {window} AS time_window, round(z, 4) AS {label}, CAST(NULL AS BOOLEAN) AS in_range FROM p
UNION ALL
SELECT 'random_forest', {key}, {window}, NULL, true FROM g"""


SQL_VOLUME_FORECAST = _sql_forecast(_sql_volume_features(_KNOWN_HOURS), "event_type", "volume")
SQL_TRAVEL_TIME_FORECAST = _sql_forecast(_sql_travel_time_features(_KNOWN_HOURS), "user_id", "avg_travel_time")

HOLDOUT_CUTOFF = "1999-01-01 00:00:00"


def q_time_holdout(spark: SparkSession, d: str) -> DataFrame:
    """Q11: fitted on the lines shipped before a date, reported on those and on the later ones."""
    from pyspark.ml.feature import VectorAssembler
    x = F.col("l_extendedprice") / 1000.0
    li = table(spark, d, "lineitem").select("l_shipdate", x.alias("x"), (x * (1 - F.col("l_discount"))).alias("label"))
    early, late = models.time_split(VectorAssembler(inputCols=["x"], outputCol="features").transform(li),
                                    "l_shipdate", HOLDOUT_CUTOFF)
    model = models.fit(models.linear_regression(), early)
    out = modeling.report("linear", "in_sample", model.transform(early), "label").unionAll(
        modeling.report("linear", "holdout", model.transform(late), "label"))
    return out.select("part", "n", *[_r(F.col(c), R4).alias(c) for c in ("mae", "rmse", "r2", "mape")])


SQL_TIME_HOLDOUT = f"""
WITH d AS (SELECT l_shipdate < TIMESTAMP '{HOLDOUT_CUTOFF}' AS early, l_extendedprice / 1000.0 AS x,
                  l_extendedprice / 1000.0 * (1 - l_discount) AS y FROM lineitem),
c AS (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS b FROM d WHERE early),
p AS (SELECT early, y, c.s * x + c.b AS z FROM d, c)
SELECT CASE WHEN early THEN 'in_sample' ELSE 'holdout' END AS part, count(*) AS n, round(avg(abs(y - z)), 4) AS mae,
       round(sqrt(avg((y - z) ^ 2)), 4) AS rmse, round(1 - sum((y - z) ^ 2) / (var_pop(y) * count(*)), 4) AS r2,
       round(avg(abs(CASE WHEN y = 0 THEN NULL ELSE (y - z) / y END)), 4) AS mape
FROM p GROUP BY early"""

_CORR_FEATURES = (["volume"] + _LAG_COLS + [f"hour__{h}" for h in range(24)] + cal.WEEKDAYS
                  + [f"minute_{m}" for m in cal.BIN_MINUTES]
                  + ["holiday", "temperature", "wind_speed", "n_obs"])


def q_corr_features(spark: SparkSession, d: str) -> DataFrame:
    """A9 on the feature table: all its numeric columns in one pass."""
    rows = written(q_volume_features(spark, d).filter("split = 'train'").select(*_CORR_FEATURES), "corr-features")
    return profile.corr_matrix(rows, _CORR_FEATURES, by_pairs=False).select("col_a", "col_b", _r(F.col("corr")).alias("corr"))


def _sql_corr_features() -> str:
    cols = ", ".join(f"corr({a}, {b}) AS c{i}_{j}" for i, a in enumerate(_CORR_FEATURES)
                     for j, b in enumerate(_CORR_FEATURES) if j >= i)
    pairs = [(a, b, f"c{min(i, j)}_{max(i, j)}") for i, a in enumerate(_CORR_FEATURES)
             for j, b in enumerate(_CORR_FEATURES)]
    rows = ", ".join(f"{{'a': '{a}', 'b': '{b}', 'c': {n}}}" for a, b, n in pairs)
    return f"""
WITH f AS ({SQL_VOLUME_FEATURES}), w AS (SELECT {cols} FROM f WHERE split = 'train'),
u AS (SELECT unnest([{rows}]) AS x FROM w)
SELECT x.a AS col_a, x.b AS col_b, round(x.c, 6) AS corr FROM u"""


SQL_CORR_FEATURES = _sql_corr_features()


# ------------------------------------- linear grids on the feature tables

#: Tenths of the 20-minute windows that the linear grids are fitted on; a window's keys stay together.
_WINDOW_NUMBER = "floor(unix_timestamp({}) / 1200)"


def _tuned_features(features_: DataFrame, key: str, label: str, grid: dict) -> DataFrame:
    """A row for each point of a linear grid on all numeric features, with its error."""
    rows = modeling.training_rows(features_, [key], label)
    train, valid = tuning.holdout(rows, F.expr(_WINDOW_NUMBER.format("window_start")))
    numbers = modeling.numeric_columns(rows, without=(label, key))
    return _tuned_facts(train, valid, label, grid, tuning.linear_grid(train, valid, numbers, label, grid))


def _tuned_vectors(rows: features.FeatureRows, label: str, grid: dict) -> DataFrame:
    """``_tuned_features`` of rows with their features as vectors."""
    train, valid = tuning.holdout(rows.rows, F.expr(_WINDOW_NUMBER.format("bin_start")))
    return _tuned_facts(train, valid, label, grid, tuning.linear_grid(
        rows.vectors(train), rows.vectors(valid), rows.names, label, grid, vector="features"))


def _tuned_facts(train: DataFrame, valid: DataFrame, label: str, grid: dict, errors: list) -> DataFrame:
    out = tuning.table(train.sparkSession, grid, errors)
    facts = valid.agg(F.struct(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("dev"))).scalar()
    return out.select(*grid, _r(F.col("rmse"), R4).alias("rmse"),
                      train.agg(F.count(F.lit(1))).scalar().alias("n_train"), facts.getField("n").alias("n_valid"),
                      (F.col("rmse") < facts.getField("dev")).alias("beats_mean"))


def q_tune_lr_features(spark: SparkSession, d: str) -> DataFrame:
    """Task 1's linear grid on all numeric columns of its feature table."""
    rows = _travel_time_features(spark, d, job=features.travel_time_rows)
    return _tuned_vectors(rows, "avg_travel_time", models.LR_GRID)


def q_tune_lr_volume_features(spark: SparkSession, d: str) -> DataFrame:
    """Task 2's linear grid on all numeric columns of its feature table."""
    return _tuned_features(q_volume_features(spark, d), "event_type", "volume", models.LR_GRID_VOLUME)


def _sql_linear_features(features_sql: str, label: str, numbers: list, grid: dict) -> str:
    """Points without an L1 part by Gauss-Jordan elimination of the normal equations, a pivot a
    step; the others by as many sweeps of coordinate descent as the operator makes."""
    k = len(numbers)
    values = ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE)" for c in [*numbers, label])
    names = ", ".join(f'"{n}"' for n in grid)
    places = ", ".join(f"[{j}.0::DOUBLE]" for j in range(1, k + 1))
    at = "CAST(e[1] AS INTEGER)"
    rest = f"(gm[{at}][{k + 1}] - list_dot_product(gm[{at}][1:{k}], b) + gm[{at}][{at}] * b[{at}])"
    moved = f"sign({rest}) * greatest(abs({rest}) - l1, 0.0) / (gm[{at}][{at}] + l2)"
    return f"""
WITH RECURSIVE f AS ({features_sql}),
r AS (SELECT [{values}] AS v,
             (CAST(epoch(strptime(substr(time_window, 2, 19), '%Y-%m-%d %H:%M:%S')) AS BIGINT) // 1200) % 10 < 8 AS early
      FROM f WHERE split = 'train' AND {label} IS NOT NULL),
pt AS ({_sql_points(grid)}),
ix AS (SELECT unnest(range(1, {k + 2})) AS i),
m AS (SELECT i, avg(v[i]) AS mean, stddev_samp(v[i]) AS dev FROM r, ix WHERE early GROUP BY i),
c AS (SELECT a.i AS i, b.i AS j, covar_pop(v[a.i], v[b.i]) AS cov FROM r, ix a, ix b
      WHERE early AND a.i <= {k} GROUP BY 1, 2),
h AS (SELECT ic, i, list(cell ORDER BY j) AS line
      FROM (SELECT ic, c.i, c.j,
                   CASE WHEN mi.dev > 1e-12 * abs(mi.mean) AND mj.dev > 1e-12 * abs(mj.mean)
                        THEN (cov + CASE WHEN ic = 'True' THEN 0 ELSE mi.mean * mj.mean END) / (mi.dev * mj.dev)
                        WHEN c.i = c.j THEN 1.0 ELSE 0.0 END AS cell
            FROM c JOIN m mi ON mi.i = c.i JOIN m mj ON mj.i = c.j,
                 (SELECT DISTINCT "fitIntercept" AS ic FROM pt))
      GROUP BY ic, i),
sy AS (SELECT DISTINCT "regParam" AS reg, "fitIntercept" AS ic, "elasticNetParam" AS alpha,
              CAST("regParam" AS DOUBLE) * CAST("elasticNetParam" AS DOUBLE) / dev AS l1,
              CAST("regParam" AS DOUBLE) * (1 - CAST("elasticNetParam" AS DOUBLE)) / dev AS l2
       FROM pt, m WHERE m.i = {k + 1}),
e AS (SELECT 0 AS p, reg, h.ic, i, [line[q] + CASE WHEN q = i THEN l2 ELSE 0 END for q in range(1, {k + 2})] AS line
      FROM h JOIN sy ON sy.ic = h.ic WHERE l1 = 0
      UNION ALL
      SELECT p + 1, reg, ic, i,
             CASE WHEN i = p + 1 THEN [x / line[p + 1] for x in line]
                  ELSE [line[q] - lead_line[q] * line[p + 1] / lead_line[p + 1] for q in range(1, {k + 2})] END
      FROM (SELECT *, first_value(line) OVER (PARTITION BY reg, ic ORDER BY i <> p + 1) AS lead_line FROM e WHERE p < {k})),
hm AS (SELECT ic, list(line ORDER BY i) AS gm FROM h GROUP BY ic),
it AS (SELECT 0 AS sweep, reg, ic, alpha, l1, l2, [0.0::DOUBLE for q in range({k})] AS b FROM sy WHERE l1 > 0
       UNION ALL
       SELECT sweep + 1, reg, it.ic, alpha, l1, l2,
              list_reduce([{places}], lambda b, e: [CASE WHEN q = {at} THEN {moved} ELSE b[q] END for q in range(1, {k + 1})], b)
       FROM it JOIN hm ON hm.ic = it.ic WHERE sweep < {max(grid["maxIter"]) * tuning.SWEEPS}),
solved AS (SELECT reg, ic, '0.0' AS alpha, CAST(NULL AS INTEGER) AS sweep, list(line[{k + 1}] ORDER BY i) AS b
           FROM e WHERE p = {k} GROUP BY reg, ic
           UNION ALL
           SELECT reg, ic, alpha, sweep, b FROM it WHERE sweep IN ({", ".join(str(n * tuning.SWEEPS) for n in grid["maxIter"])})),
w AS (SELECT reg, ic, alpha, sweep, list(w ORDER BY i) AS ws,
             CASE WHEN ic = 'True' THEN any_value(my) - sum(w * mean) ELSE 0 END AS b
      FROM (SELECT s.*, m.i, m.mean, my.mean AS my,
                   CASE WHEN m.dev > 1e-12 * abs(m.mean) THEN s.b[m.i] * my.dev / m.dev ELSE 0 END AS w
            FROM solved s, m JOIN m my ON my.i = {k + 1} WHERE m.i <= {k}) GROUP BY reg, ic, alpha, sweep),
z AS (SELECT reg, ic, alpha, sweep, sqrt(avg((v[{k + 1}] - list_dot_product(v[1:{k}], ws) - b) ^ 2)) AS rmse
      FROM r, w WHERE NOT early GROUP BY reg, ic, alpha, sweep),
g AS (SELECT count(*) FILTER (early) AS n_train, count(*) FILTER (NOT early) AS n_valid,
             stddev_pop(v[{k + 1}]) FILTER (NOT early) AS sd FROM r)
SELECT {names}, round(rmse, 4) AS rmse, n_train, n_valid, rmse < sd AS beats_mean
FROM pt JOIN z ON z.reg = pt."regParam" AND z.ic = pt."fitIntercept" AND z.alpha = pt."elasticNetParam"
     AND coalesce(z.sweep = CAST(pt."maxIter" AS INTEGER) * {tuning.SWEEPS}, true), g"""


_CALENDAR_COLS = cal.WEEKDAYS + [f"hour__{h}" for h in range(24)] + [f"minute_{m}" for m in cal.BIN_MINUTES]
_WEATHER_COLS = ["temperature", "wind_speed", "n_obs"]
SQL_TUNE_LR_FEATURES = _sql_linear_features(
    SQL_TRAVEL_TIME_FEATURES, "avg_travel_time", _LAG_COLS + _CALENDAR_COLS + ["is_holiday"] + _WEATHER_COLS + _RF_COLS,
    models.LR_GRID)
SQL_TUNE_LR_VOLUME_FEATURES = _sql_linear_features(
    SQL_VOLUME_FEATURES, "volume", _LAG_COLS + _CALENDAR_COLS + ["holiday"] + _WEATHER_COLS, models.LR_GRID_VOLUME)


# ------------------------------------------------------------- registry

QUERIES = {
    "src_csv": q_src_csv, "sql_project": q_sql_project, "describe_schema": q_describe_schema,
    "row_count": q_row_count, "head_n": q_head_n, "drop_rename": q_drop_rename,
    "key_first": q_key_first, "filter_keys": q_filter_keys, "distinct_keys": q_distinct_keys,
    "bin_mean": q_bin_mean, "bin_count": q_bin_count, "bin_count_fine": q_bin_count_fine,
    "stream_bin_count": q_stream_bin_count,
    "bin_offset": q_bin_offset, "lags_by_key": q_lags_by_key, "lags_global": q_lags_global,
    "seq_repair": q_seq_repair, "seq_repair_twice": q_seq_repair_twice,
    "sentinel_repair": q_sentinel_repair, "missing_windows": q_missing_windows,
    "locf_grid": q_locf_grid, "append_sources": q_append_sources, "shift_time": q_shift_time,
    "time_window": q_time_window, "parse_window": q_parse_window,
    "calendar_parts": q_calendar_parts, "dummies": q_dummies, "hour_bucket": q_hour_bucket,
    "holiday_flag": q_holiday_flag, "weather_join": q_weather_join,
    "route_links": q_route_links, "link_flags": q_link_flags,
    "route_features": q_route_features, "feature_join": q_feature_join,
    "align_schema": q_align_schema, "zero_impute": q_zero_impute,
    "mean_impute": q_mean_impute, "profile": q_profile, "corr_matrix": q_corr_matrix,
    "string_index": q_string_index, "onehot": q_onehot, "assemble": q_assemble,
    "lr_coefficients": q_lr_coefficients, "lr_score": q_lr_score,
    "regression_metrics": q_regression_metrics, "rf_score": q_rf_score,
    "gbt_score": q_gbt_score, "tune_lr": q_tune_lr,
    "volume_features": q_volume_features, "travel_time_features": q_travel_time_features,
    "src_csv_inferred": q_src_csv_inferred, "seq_repair_nulls": q_seq_repair_nulls,
    "locf_grid_nulls": q_locf_grid_nulls, "locf_grid_positions": q_locf_grid_positions,
    "tune_lr_volume": q_tune_lr_volume, "tune_gbt": q_tune_gbt, "tune_gbt_volume": q_tune_gbt_volume,
    "tune_rf": q_tune_rf, "tune_rf_volume": q_tune_rf_volume, "volume_model": q_volume_model,
    "travel_time_model": q_travel_time_model, "time_holdout": q_time_holdout,
    "corr_features": q_corr_features, "volume_forecast": q_volume_forecast,
    "travel_time_forecast": q_travel_time_forecast, "bin_augmented": q_bin_augmented,
    "feature_join_stored": q_feature_join_stored, "lags_levels": q_lags_levels, "seq_repair_levels": q_seq_repair_levels,
    "tune_lr_features": q_tune_lr_features, "tune_lr_volume_features": q_tune_lr_volume_features,
    "src_csv_rejects": q_src_csv_rejects, "onehot_open": q_onehot_open, "profile_merge": q_profile_merge,
}

ORACLE_SQL = {
    "src_csv": SQL_SRC_CSV, "sql_project": SQL_SQL_PROJECT,
    "describe_schema": SQL_DESCRIBE_SCHEMA, "row_count": SQL_ROW_COUNT, "head_n": SQL_HEAD_N,
    "drop_rename": SQL_DROP_RENAME, "key_first": SQL_KEY_FIRST,
    "filter_keys": SQL_FILTER_KEYS, "distinct_keys": SQL_DISTINCT_KEYS,
    "bin_mean": SQL_BIN_MEAN, "bin_count": SQL_BIN_COUNT, "bin_count_fine": SQL_BIN_COUNT_FINE,
    "stream_bin_count": SQL_BIN_COUNT,
    "bin_offset": SQL_BIN_OFFSET, "lags_by_key": SQL_LAGS_BY_KEY,
    "lags_global": SQL_LAGS_GLOBAL, "seq_repair": SQL_SEQ_REPAIR,
    "seq_repair_twice": SQL_SEQ_REPAIR_TWICE, "sentinel_repair": SQL_SENTINEL_REPAIR,
    "missing_windows": SQL_MISSING_WINDOWS, "locf_grid": SQL_LOCF_GRID,
    "append_sources": SQL_APPEND_SOURCES, "shift_time": SQL_SHIFT_TIME,
    "time_window": SQL_TIME_WINDOW, "parse_window": SQL_PARSE_WINDOW,
    "calendar_parts": SQL_CALENDAR_PARTS, "dummies": SQL_DUMMIES,
    "hour_bucket": SQL_HOUR_BUCKET, "holiday_flag": SQL_HOLIDAY_FLAG,
    "weather_join": SQL_WEATHER_JOIN, "route_links": SQL_ROUTE_LINKS,
    "link_flags": SQL_LINK_FLAGS, "route_features": SQL_ROUTE_FEATURES,
    "feature_join": SQL_FEATURE_JOIN, "align_schema": SQL_ALIGN_SCHEMA,
    "zero_impute": SQL_ZERO_IMPUTE, "mean_impute": SQL_MEAN_IMPUTE, "profile": SQL_PROFILE,
    "corr_matrix": SQL_CORR_MATRIX, "string_index": SQL_STRING_INDEX, "onehot": SQL_ONEHOT,
    "assemble": SQL_ASSEMBLE, "lr_coefficients": SQL_LR_COEFFICIENTS,
    "lr_score": SQL_LR_SCORE, "regression_metrics": SQL_REGRESSION_METRICS,
    "volume_features": SQL_VOLUME_FEATURES,
    "travel_time_features": SQL_TRAVEL_TIME_FEATURES,
    "src_csv_inferred": SQL_SRC_CSV, "seq_repair_nulls": SQL_SEQ_REPAIR_NULLS,
    "locf_grid_nulls": SQL_LOCF_GRID_NULLS, "locf_grid_positions": SQL_LOCF_GRID_POSITIONS,
    "rf_score": SQL_RF_SCORE, "gbt_score": SQL_GBT_SCORE, "tune_lr": SQL_TUNE_LR,
    "tune_lr_volume": SQL_TUNE_LR_VOLUME, "tune_gbt": SQL_TUNE_GBT,
    "tune_gbt_volume": SQL_TUNE_GBT_VOLUME, "tune_rf": SQL_TUNE_RF,
    "tune_rf_volume": SQL_TUNE_RF_VOLUME, "volume_model": SQL_VOLUME_MODEL,
    "travel_time_model": SQL_TRAVEL_TIME_MODEL, "time_holdout": SQL_TIME_HOLDOUT,
    "corr_features": SQL_CORR_FEATURES, "volume_forecast": SQL_VOLUME_FORECAST,
    "travel_time_forecast": SQL_TRAVEL_TIME_FORECAST, "bin_augmented": SQL_BIN_AUGMENTED,
    "feature_join_stored": SQL_FEATURE_JOIN, "lags_levels": SQL_LAGS_LEVELS, "seq_repair_levels": SQL_SEQ_REPAIR,
    "tune_lr_features": SQL_TUNE_LR_FEATURES, "tune_lr_volume_features": SQL_TUNE_LR_VOLUME_FEATURES,
    "src_csv_rejects": SQL_SRC_CSV_REJECTS, "onehot_open": SQL_ONEHOT_OPEN, "profile_merge": SQL_PROFILE_MERGE,
}
