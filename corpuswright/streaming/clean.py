"""Cleaning of streams: the shuffle-free stage on files as they come, and exact duplicates within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpuswright.functions.text import dedup_key
from corpuswright.plans.clean import stage_a
from corpuswright.plans.config import Cleaning
from corpuswright.sources.readers import DOCUMENT


def read_stream(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    """Documents of JSON lines as files arrive, with the time at which they are read."""
    return spark.readStream.schema(DOCUMENT).option("maxFilesPerTrigger", files_per_trigger).json(path).withColumn("read_at", F.current_timestamp())


def clean_stream(docs: DataFrame, config: Cleaning | None = None, watermark: str = "1 hour") -> DataFrame:
    """Kept and prepared documents; of equal texts within the watermark the first."""
    out = stage_a(docs, config or Cleaning()).withColumn("text_key", F.md5(dedup_key("text").cast("binary")))
    return out.withWatermark("read_at", watermark).dropDuplicatesWithinWatermark(["text_key"])


def event_counts(events: DataFrame, window: str = "1 hour", watermark: str = "10 minutes") -> DataFrame:
    """``(start, event_type, n, total)`` by tumbling windows of event time."""
    timed = events.withWatermark("ts", watermark) if events.isStreaming else events
    return timed.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def start(docs: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes all that is there, then stops."""
    return docs.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
