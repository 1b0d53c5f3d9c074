"""Resume and incremental runs: what is done, what is to do, and streams of newly arrived files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

DONE, SKIPPED, ERROR = "processed", "skipped", "error"


def to_do(inputs: DataFrame, outputs: DataFrame, status: DataFrame | None = None, key: str = "output_path", retry_errors: bool = False) -> DataFrame:
    """Inputs without an output and without a status that says they are done.

    Files that failed are not tried again unless asked for.
    """
    left = inputs.join(outputs.select(key).distinct(), key, "left_anti")
    if status is not None:
        closed = status.filter(F.col("status") != ERROR) if retry_errors else status
        left = left.join(closed.select(key).distinct(), key, "left_anti")
    return left


def status_counts(status: DataFrame) -> DataFrame:
    return status.groupBy("stage", "status").agg(F.count("*").alias("n"))


def latest_status(status: DataFrame, key: str = "output_path") -> DataFrame:
    """The last status of every path of a stage."""
    last = F.max(F.struct("updated", "status", "reason")).alias("last")
    return status.groupBy("stage", key).agg(last).select("stage", key, "last.status", "last.reason", "last.updated")


def state_name(conf: str, years: list[int] | None) -> str:
    """Name of a run's state: the venue with its years' span and number, or all."""
    return f"{conf}_all" if not years else f"{conf}_{min(years)}-{max(years)}_{len(years)}"


def process_new(spark: SparkSession, path: str, schema: str, file_format: str, step: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, **options: str) -> StreamingQuery:
    """Run ``step`` over the files that arrived since the last run and append its rows to ``out``.

    The checkpoint remembers which files are done; with ``availableNow`` the query ends by itself.
    """
    stream = spark.readStream.schema(schema).format(file_format).options(**options).load(path)

    def write(batch: DataFrame, number: int) -> None:
        # The batch number makes a repeated batch overwrite what a failed attempt left.
        step(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_counts(events: DataFrame, watermark: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Counts by event type in windows of event time; works on batches and, with late data cut off, on streams."""
    kept = events.withWatermark("ts", watermark) if events.isStreaming else events
    return kept.groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")
