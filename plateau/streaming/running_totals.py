"""Running activity totals as a stateful stream.

The stream keeps one row per (user, event) in the state store: events so far, first and last time. Every micro-batch emits
the keys it changed (update mode); the sink writes them as one folder per batch, which a retried batch overwrites, so the
rows of a key with the largest batch are its totals whatever was repeated. State and progress lie under the shared
``spark.checkpoint.dir``: a restarted job goes on from its totals. A user with a third of all events is a few keys,
reduced in every map task before the shuffle. Events without user or name are keys like any other, as in the batch form.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plateau.config import RECIPE_EVENTS
from plateau.operators.explore import USER
from plateau.session import checkpoint_dir


def running_totals(events: DataFrame) -> DataFrame:
    """Totals per (user, event); over a stream these are its state."""
    return events.groupBy(USER, "event").agg(F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first_seen"),
                                             F.max("timestamp").alias("last_seen"))


def start_running_totals(events: DataFrame, out_path: str, checkpoint_location: str | None = None, available_now: bool = True,
                         processing_time: str | None = None) -> StreamingQuery:
    """Start the stream; changed totals go to ``out_path/batch=<number>``."""
    spark = events.sparkSession
    ckpt = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/stream-totals-{uuid.uuid4().hex}"

    def keep(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out_path}/batch={batch}")
    w = running_totals(events).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now and not processing_time else w.trigger(processingTime=processing_time)
    return w.start()


def latest_totals(spark: SparkSession, out_path: str) -> DataFrame:
    """The last row written for every key."""
    t = spark.read.parquet(out_path)
    last = F.max_by(F.struct("n", "first_seen", "last_seen"), "batch").alias("t")
    return t.groupBy(USER, "event").agg(last).select(USER, "event", "t.*")


def summary_of(totals: DataFrame, recipe_events: list[str] | None = None) -> DataFrame:
    """The per-user activity summary of ``explore.user_summary`` from totals."""
    names = list(recipe_events or RECIPE_EVENTS)
    base = totals.groupBy(USER).agg(
        F.sum("n").alias("total_events"), F.sum(F.when(F.col("event").isin(names), F.col("n")).otherwise(0)).alias("recipe_events"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("event", "n")))).alias("event_types"))
    days = F.greatest(F.lit(1), F.floor((F.col("last_seen") - F.col("first_seen")) / 86400)).cast("bigint")
    return base.withColumn("days_active", days)
