"""The bin/count operator (A2) as a Structured Streaming job.

Events arrive as files; counts per (20-minute window, keys) are kept in
state, and the watermark bounds that state: a window is finalised (and its
state dropped) once event time has moved ``watermark`` past its end, and
later rows for it are discarded as late.  That loss is the ``watermark``
parameter's: with ``None`` state grows with the windows and no row is late.

Each micro-batch's updated windows are appended to a parquet table with the
batch id (``foreachBatch``; the checkpoint makes a restarted query resume
after its last committed batch).  The current answer is the latest row per
(window, keys).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def event_stream(spark: SparkSession, folder: str, schema: T.StructType,
                 file_glob: str = "*.parquet", max_files_per_trigger: int | None = None
                 ) -> DataFrame:
    """Streaming scan of the parquet files of ``folder`` matching ``file_glob``."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(folder)


_EPOCH = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _ntz_to_instant(c):
    """Wall-clock ``timestamp_ntz`` -> instant with the same UTC reading
    (watermarks need an instant); independent of the session time zone."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _EPOCH, c))


def _instant_to_ntz(c):
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), _EPOCH)


def windowed_counts(events: DataFrame, ts: str, keys, minutes: int = 20,
                    watermark: str | None = "1 hour", out: str = "volume") -> DataFrame:
    """Streaming aggregate: count per (window start, keys) with a watermark."""
    ev = events
    if dict(events.dtypes)[ts] == "timestamp_ntz":
        ev = events.withColumn("_et", _ntz_to_instant(F.col(ts)))
        et = "_et"
    else:
        et = ts
    w = F.window(F.col(et), f"{minutes} minutes")
    res = ((ev.withWatermark(et, watermark) if watermark else ev)
           .groupBy(w.alias("_w"), *keys)
           .agg(F.count(F.lit(1)).alias(out)))
    start = F.col("_w.start")
    if et != ts:
        start = _instant_to_ntz(start)
    return res.select(start.alias("bin_start"), *keys, out)


def run_available(counts: DataFrame, table_path: str, checkpoint_path: str) -> None:
    """Process everything available now, append each batch's updated windows."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("append").parquet(table_path)

    q = (counts.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def latest_counts(spark: SparkSession, table_path: str, keys, out: str = "volume"
                  ) -> DataFrame:
    """Current answer: the last emitted count of every (window, keys)."""
    t = spark.read.parquet(table_path)
    return t.groupBy("bin_start", *keys).agg(F.max_by(out, "_batch").alias(out))


def stream_bin_count(spark: SparkSession, folder: str, schema: T.StructType, ts: str,
                     keys, file_glob: str, minutes: int = 20, watermark: str | None = "1 hour",
                     out: str = "volume") -> DataFrame:
    """Run the streaming count over the available files and return the table."""
    base = scratch_path(spark, "stream-bins")
    counts = windowed_counts(event_stream(spark, folder, schema, file_glob), ts, keys,
                             minutes, watermark, out)
    run_available(counts, f"{base}/table", f"{base}/checkpoint")
    return latest_counts(spark, f"{base}/table", keys, out)
