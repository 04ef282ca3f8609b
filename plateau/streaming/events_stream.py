"""Event cleaning (T05) as a Structured Streaming job.

The cleaning plan is row-wise (parse -> version rules -> union -> derived columns), so
the batch plan applies unchanged to ``readStream`` sources; no state, no watermark.
Progress is kept in a checkpoint location under the shared ``spark.checkpoint.dir``,
so a restarted job resumes from the last committed files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from plateau.plans.clean_events import combined_events_from_lines
from plateau.session import checkpoint_dir


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def start_clean_events(spark: SparkSession, v1_dir: str, v2_dir: str, out_path: str,
                       checkpoint_location: str | None = None, available_now: bool = True,
                       processing_time: str | None = None) -> StreamingQuery:
    """Start the streaming event-cleaning job writing Parquet to ``out_path``."""
    df = combined_events_from_lines(stream_lines(spark, v1_dir), stream_lines(spark, v2_dir))
    ckpt = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/stream-clean-events-{uuid.uuid4().hex}"
    w = df.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", ckpt) \
        .outputMode("append")
    w = w.trigger(availableNow=True) if available_now and not processing_time else w.trigger(processingTime=processing_time)
    return w.start()
