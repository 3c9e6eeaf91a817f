"""Streams of newly landed files: RAW appends and arrival statistics."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from attestry.sources.ledger import append_ledger, append_raw_idempotent, read_ledger


def file_stream(spark: SparkSession, folder: str, schema: StructType, pattern: str, kind: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """Files of ``folder`` as they land."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(kind).load(folder)


def batch_name(spark: SparkSession, checkpoint: str, table: str, number: int) -> str:
    """Ledger batch id of a micro-batch: the stream's own id, which Spark keeps in the checkpoint folder, the table and the number."""
    identity = spark.read.text(f"{checkpoint}/metadata").first()[0]
    return f"stream-{hashlib.sha256(f'{identity}/{table}'.encode()).hexdigest()[:16]}-{number:012d}"


def stream_raw_append(stream: DataFrame, to_raw: Callable[[DataFrame], DataFrame], root: str, table: str, checkpoint: str) -> StreamingQuery:
    """Append each micro-batch to RAW, once.

    The ledger's batch id names the stream, the table and the micro-batch: a batch that Spark runs
    again is published once, and a stream that starts anew has batches of its own. Records already loaded are left out by identity against the ledger, so there is no
    watermark and a late record is never lost.
    """

    def load(batch: DataFrame, number: int) -> None:
        append_raw_idempotent(to_raw(batch), root, table, batch_name(batch.sparkSession, checkpoint, table, number))

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def record_arrivals(stream: DataFrame, at: str, source: str, window: str, root: str, table: str, checkpoint: str) -> StreamingQuery:
    """Rows, first and last time per window and source, appended per micro-batch as partial counts.

    Partials of one window add up over batches (``arrivals``), so late rows count too and no
    state is kept between batches.
    """

    def load(batch: DataFrame, number: int) -> None:
        partial = batch.groupBy(F.window(at, window).alias("w"), F.col(source)).agg(
            F.count(F.lit(1)).alias("n"), F.min(at).alias("first_at"), F.max(at).alias("last_at")
        )
        rows = partial.select(F.col("w.start").alias("window_start"), source, "n", "first_at", "last_at")
        append_ledger(root, batch_name(batch.sparkSession, checkpoint, table, number), {table: rows})

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def arrivals(spark: SparkSession, root: str, table: str, source: str) -> DataFrame:
    """Totals per window and source over all published micro-batches."""
    return (
        read_ledger(spark, root, table)
        .groupBy("window_start", source)
        .agg(
            F.sum("n").alias("n"),
            F.min("first_at").alias("first_at"),
            F.max("last_at").alias("last_at"),
            F.count_distinct("batch_id").alias("n_batches"),
        )
    )


def windowed_counts(stream: DataFrame, at: str, source: str, window: str, lateness: str) -> DataFrame:
    """Live counts per window and source with bounded state, for dashboards.

    Rows later than ``lateness`` are not counted here; ``record_arrivals`` keeps the whole count.
    """
    # Watermarks are defined on zoned timestamps only.
    return (
        stream.withColumn(at, F.col(at).cast("timestamp"))
        .withWatermark(at, lateness)
        .groupBy(F.window(at, window).alias("w"), F.col(source))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), source, "n")
    )
