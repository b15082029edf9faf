"""Streaming forms: sessions by gap, tumbling sums, and files that are picked up once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def sessions(events: DataFrame, key: str, time: str = "ts", gap: str = "1 hour", late: str = "1 day") -> DataFrame:
    """(key, start, end, n) of each key's sessions: a gap without events ends one. Events later than `late` are left out. The
    same on a batch and on a stream."""
    timed = events.withColumn("_t", F.col(time).cast("timestamp"))
    if timed.isStreaming:
        timed = timed.withWatermark("_t", late)
    grouped = timed.groupBy(key, F.session_window("_t", gap).alias("_w")).agg(F.count(F.lit(1)).alias("n"))
    return grouped.select(key, F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), "n")


def totals(events: DataFrame, key: str, value: str, time: str = "ts", width: str = "1 day", late: str = "1 day") -> DataFrame:
    """(key, start, n, total) in windows of fixed width."""
    timed = events.withColumn("_t", F.col(time).cast("timestamp"))
    if timed.isStreaming:
        timed = timed.withWatermark("_t", late)
    grouped = timed.groupBy(key, F.window("_t", width).alias("_w")).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return grouped.select(key, F.col("_w.start").alias("start"), "n", "total")


def read_folder(spark: SparkSession, path: str, schema: str, files_a_batch: int = 100) -> DataFrame:
    """Parquet files of a folder as a stream, so many a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


def resume(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Processes what has come since the last time and stops; the checkpoint remembers finished files."""
    return stream.writeStream.outputMode(mode).format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
