"""Structured Streaming forms: piece counts as text arrives, windows over events, sharded sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.pieces import piece_counts


def stream_table(spark: SparkSession, folder: str, schema, glob: str = "*.parquet", files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def streaming_piece_counts(lines: DataFrame, pattern: str, name: str, checkpoint: str, **options) -> StreamingQuery:
    """Running piece counts in a memory table; the offset log in `checkpoint` takes the place of a resume file."""
    return piece_counts(lines, pattern, **options).writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, ts: str = "ts", late: str = "10 minutes", width: str = "1 hour", slide: str | None = None, by: str = "event_type", value: str = "value") -> DataFrame:
    """Count and sum per window and kind.  On a stream, rows later than the watermark are dropped."""
    if events.isStreaming:
        events = events.withWatermark(ts, late)
    win = F.window(ts, width, slide) if slide else F.window(ts, width)
    return events.groupBy(win.alias("w"), by).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("window_start"), by, "n", "total")


def sessions(events: DataFrame, ts: str = "ts", gap: str = "30 minutes", by: str = "user_id", late: str = "1 hour") -> DataFrame:
    if events.isStreaming:
        events = events.withWatermark(ts, late)
    return events.groupBy(F.session_window(ts, gap).alias("w"), by).agg(F.count("*").alias("n")).select(by, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def into_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Each micro-batch to a writer that must be idempotent in its batch number."""
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
