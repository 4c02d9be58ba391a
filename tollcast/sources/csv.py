"""CSV scans and sinks (S1-S3) with explicit schemas.

The traffic inputs are small quoted CSVs; the trip and vehicle logs are large.
Both are read with a fixed ``StructType`` so no inference job runs and
train/test schemas never drift.  ``infer=True`` is the opt-in for unknown
files (it costs a full extra scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed input schemas of the traffic tables (column names and types of the
# shipped and described CSV files).
LINKS_SCHEMA = T.StructType([
    T.StructField("link_id", T.StringType()),
    T.StructField("length", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("lanes", T.IntegerType()),
    T.StructField("in_top", T.StringType()),
    T.StructField("out_top", T.StringType()),
    T.StructField("lane_width", T.IntegerType()),
])

ROUTES_SCHEMA = T.StructType([
    T.StructField("intersection_id", T.StringType()),
    T.StructField("tollgate_id", T.IntegerType()),
    T.StructField("link_seq", T.StringType()),
])

WEATHER_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("pressure", T.DoubleType()),
    T.StructField("sea_pressure", T.DoubleType()),
    T.StructField("wind_direction", T.DoubleType()),
    T.StructField("wind_speed", T.DoubleType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("rel_humidity", T.DoubleType()),
    T.StructField("precipitation", T.DoubleType()),
])

TRAJECTORIES_SCHEMA = T.StructType([
    T.StructField("intersection_id", T.StringType()),
    T.StructField("tollgate_id", T.IntegerType()),
    T.StructField("vehicle_id", T.LongType()),
    T.StructField("starting_time", T.TimestampNTZType()),
    T.StructField("travel_seq", T.StringType()),
    T.StructField("travel_time", T.DoubleType()),
])

VOLUME_SCHEMA = T.StructType([
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("tollgate_id", T.IntegerType()),
    T.StructField("direction", T.IntegerType()),
    T.StructField("vehicle_model", T.IntegerType()),
    T.StructField("has_etc", T.IntegerType()),
    T.StructField("vehicle_type", T.IntegerType()),
])

TRAVEL_TIME_SAMPLE_SCHEMA = T.StructType([
    T.StructField("intersection_id", T.StringType()),
    T.StructField("tollgate_id", T.IntegerType()),
    T.StructField("time_window", T.StringType()),
    T.StructField("avg_travel_time", T.DoubleType()),
])

VOLUME_SAMPLE_SCHEMA = T.StructType([
    T.StructField("tollgate_id", T.IntegerType()),
    T.StructField("time_window", T.StringType()),
    T.StructField("direction", T.IntegerType()),
    T.StructField("volume", T.DoubleType()),
])

SCHEMAS = {
    "links": LINKS_SCHEMA,
    "routes": ROUTES_SCHEMA,
    "weather": WEATHER_SCHEMA,
    "trajectories": TRAJECTORIES_SCHEMA,
    "volume": VOLUME_SCHEMA,
    "travel_time_sample": TRAVEL_TIME_SAMPLE_SCHEMA,
    "volume_sample": VOLUME_SAMPLE_SCHEMA,
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             infer: bool = False, header: bool = True) -> DataFrame:
    """Distributed CSV scan.

    ``schema`` may be a ``StructType``, a DDL string or a key of ``SCHEMAS``.
    Timestamps are parsed as ``timestamp_ntz`` with ``yyyy-MM-dd HH:mm:ss``.
    Empty fields become NULL (never NaN).
    """
    if isinstance(schema, str) and schema in SCHEMAS:
        schema = SCHEMAS[schema]
    reader = _options(spark.read, header).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True).option("preferDate", True)
    return reader.csv(path)


def _options(reader, header: bool):
    return (reader.option("header", header).option("quote", '"').option("escape", '"')
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").option("dateFormat", "yyyy-MM-dd"))


def read_csv_rejects(spark: SparkSession, path: str, schema: T.StructType | str,
                     header: bool = True) -> tuple[DataFrame, DataFrame]:
    """S1 that goes on over bad lines: (rows, rejects).

    ``rejects`` has the file, the line as it is, and the reason: the columns
    whose text does not fit their type, or that the line has not the schema's
    number of fields.  Every line is in one of the two.
    """
    if isinstance(schema, str):
        schema = SCHEMAS.get(schema) or T.StructType.fromDDL(schema)
    names = schema.fieldNames()
    raw = T.StructType([*schema.fields, T.StructField("_line", T.StringType())])
    reader = (_options(spark.read, header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line")
              .option("columnPruning", False).option("enforceSchema", True))
    lines = reader.schema(raw).csv(path).withColumn("_file", F.input_file_name())
    # always true, and it names every column: whether a line is bad must not depend on the
    # columns that a query selects
    whole = F.xxhash64(*[F.col(f"`{n}`") for n in names]).bitwiseOR(F.lit(1)) != 0
    lines = lines.filter(whole)
    rows = lines.filter(F.col("_line").isNull()).select(*[F.col(f"`{n}`") for n in names])
    texts = ", ".join(f"`{n}` STRING" for n in [*names, "_more"])
    split = F.from_csv("_line", F.lit(texts), {"quote": '"', "escape": '"'})
    bad = [F.when(F.col("_t").getField(n).isNotNull() & F.col(f"`{n}`").isNull(), F.lit(n)) for n in names]
    found = lines.filter(F.col("_line").isNotNull()).withColumn("_t", split)
    wrong = F.concat_ws(", ", *bad)
    rejects = found.select(F.col("_file").alias("file"), F.col("_line").alias("line"),
                           F.when(wrong != "", F.concat(F.lit("bad "), wrong))
                           .otherwise(F.lit("number of fields")).alias("reason"))
    return rows, rejects


def write_csv(df: DataFrame, path: str, key_cols: list[str] | tuple = (),
              mode: str = "overwrite") -> None:
    """CSV sink (S3): key columns first, header row, one folder of part files."""
    keys = list(key_cols)
    rest = [c for c in df.columns if c not in keys]
    out = df.select(*keys, *rest)
    (out.write.mode(mode).option("header", True).option("escape", '"')  # quotes doubled, as read
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | tuple = (),
                  mode: str = "overwrite") -> None:
    """Default sink: parquet, optionally partitioned (e.g. by date) for pruning."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing values are SQL NULL throughout; turn NaN doubles into NULL."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
