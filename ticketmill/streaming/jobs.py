"""Streaming sources, sinks and the jobs that connect them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.time import with_event_time
from ..operators.monitor import progress
from ..operators.routing import bad_rows, good_rows, transactions, write_jsonl


TRIGGER_BYTES = 32 << 20


def stream_lines(
    spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """Text lines as ``(file, value)`` in triggers of whole files, bounded by number or by bytes, not both."""
    if max_files and max_bytes:
        raise ValueError("bound a trigger by max_files or by max_bytes")
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.text(path).select(F.col("_metadata.file_path").alias("file"), "value")


def stream_table(spark: SparkSession, folder: str, name: str, max_bytes: int = TRIGGER_BYTES) -> DataFrame:
    """A parquet table of ``folder`` as a stream, be it one file or a folder of part files.

    A trigger takes files up to ``max_bytes``, and one file at least.
    """
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    # The source takes a file only by a pattern; this one matches nothing but the table.
    pattern = f"{folder}/{name}.parque[t]"
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", max_bytes).parquet(pattern)


def append_to(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append to a parquet table; the file sink commits each batch exactly once."""
    return (
        stream.writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def upsert_to(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Write each batch's changed rows to its own directory.

    A repeated batch overwrites itself, so at-least-once delivery does no harm;
    `latest` gives the current row of each key.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )


def latest(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    """The newest version of each key of an upserted table: a map-side combined aggregate."""
    rows = spark.read.parquet(folder)
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    newest = F.max_by(F.struct(*values), F.col("batch")).alias("x")
    return rows.groupBy(*keys).agg(newest).select(*keys, "x.*")


def route_stream(
    routed: DataFrame, folder: str, checkpoint: str, response: str = "response"
) -> StreamingQuery:
    """Good, bad and transaction files per batch.

    Three sinks share a batch, which Spark delivers at least once: every batch
    owns its directories and overwrites them when it is repeated.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        stored_at = f"{folder}/routed/batch={batch_id}"
        batch.write.mode("overwrite").parquet(stored_at)
        stored = batch.sparkSession.read.parquet(stored_at)
        for name, rows in (
            ("good", good_rows(stored)),
            ("bad", bad_rows(stored)),
            ("transactions", transactions(stored, response)),
        ):
            write_jsonl(rows, f"{folder}/{name}/batch={batch_id}", "overwrite")

    return (
        routed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drain(
    start: Callable[[DataFrame, str, str], StreamingQuery], stream: DataFrame, folder: str
) -> str:
    """Run a streaming job over everything available; returns its output folder."""
    query = start(stream, f"{folder}/out", f"{folder}/checkpoint")
    query.awaitTermination()
    return f"{folder}/out"


def progress_stream(
    outcomes: DataFrame, ts: str, is_bad: Column, delay: str | None = None, interval: str = "30 seconds"
) -> DataFrame:
    """Progress per interval.

    With ``delay`` a window is final once the watermark passed its end, and later rows
    are dropped by Spark. Without, every row counts whenever it comes; the state has
    one small row per interval.
    """
    timed = with_event_time(outcomes, ts)
    return progress(timed.withWatermark(ts, delay) if delay else timed, ts, is_bad, interval)
