"""Structured Streaming entry points.

The row-level operators (adapters, P1-P16 cleaning, flatten, rationale, ChatML
texts, V27-style row checks, reward scoring) are narrow projections, so they run
unchanged on a streaming DataFrame. Exact dedup (D1) becomes
``dropDuplicatesWithinWatermark`` keyed on the dedup columns with an event-time
watermark, so state stays bounded. Whole-dataset operators (scorecard,
sampling, splits) run per micro-batch through ``foreachBatch``; the checkpoint
location of every query lives under the shared checkpoint folder so a restarted
driver or a lost executor resumes from committed offsets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vigil.operators import chatml as cm
from vigil.operators import normalize as nz
from vigil.session import ensure_checkpoint_dir
from vigil.sources import tables as tb

EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read_events_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 64) -> DataFrame:
    """Parquet event files as a stream (new files are picked up as they land)."""
    return (spark.readStream.schema(EVENTS_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


def findings_stream(events: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """events stream -> normalised findings, duplicates of an id dropped within the watermark."""
    f = tb.findings_from_events(events).withColumn("ts", F.col("ts").cast("timestamp"))
    f = f.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["id"])
    return nz.normalize_findings(f)


def training_rows_stream(events: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """events stream -> flattened training rows (P10); D1 duplicates dropped within the watermark."""
    f = tb.findings_from_events(events).withColumn("ts", F.col("ts").cast("timestamp"))
    flat = cm.flatten_findings(f, passthrough=("ts",))
    return (flat.withWatermark("ts", watermark)
            .dropDuplicatesWithinWatermark(["title", "description", "category", "rationale"]))


def checkpoint_location(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def start(df: DataFrame, name: str, sink: Callable[[DataFrame, int], None] | None = None,
          output_path: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Start a query writing to ``output_path`` (parquet, append) or through ``sink`` per micro-batch."""
    spark = df.sparkSession
    w = df.writeStream.queryName(name).option("checkpointLocation", checkpoint_location(spark, name))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    if sink is not None:
        return w.foreachBatch(sink).start()
    if output_path is None:
        raise ValueError("give output_path or sink")
    return w.format("parquet").outputMode("append").option("path", output_path).start()
