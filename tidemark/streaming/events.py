"""Single audit events as a file stream: late and repeated ones land once."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.payloads import event_fields
from tidemark.operators import transform
from tidemark.sinks import tables


def event_stream(spark: SparkSession, landed: str, max_files_per_batch: int = 10_000) -> DataFrame:
    """Landed events, one JSON object a line, as a stream of raw text."""
    return spark.readStream.option("maxFilesPerTrigger", max_files_per_batch).text(landed).withColumnRenamed("value", "raw")


def first_arrivals(events: DataFrame, kept_for: str = "1 hour", arrived: Column | None = None) -> DataFrame:
    """The stream without repeats of an event that arrive within ``kept_for`` of each other.

    The watermark follows the time of arrival (``arrived``, by default the batch's own time) and not that of the
    event, so no event is dropped for being old, and the state holds the ids of about ``kept_for`` only.
    """
    named = events.withColumn("event_id", event_fields(F.col("raw"))["Id"])
    timed = named.withColumn("arrived", F.current_timestamp() if arrived is None else arrived)
    return timed.withWatermark("arrived", kept_for).dropDuplicatesWithinWatermark(["event_id"]).select("raw")


def ingest_events(
    spark: SparkSession, landed: str, table: str, progress_path: str, tracked: tuple[str, ...] = (), kept_for: str = "1 hour", max_files_per_batch: int = 10_000
) -> None:
    """Merge the events of all files not seen so far.

    Of repeats that arrive close together the first one stays; the merge finds those that are stored already,
    whatever their age, in the table's id index if it has one. A batch repeated after a failure changes nothing.
    """
    tables.create_table(spark, table, tables.ACTIVITY_TABLE)

    def load(batch: DataFrame, _batch_id: int) -> None:
        rows = transform.activity_rows(batch, datetime.now(timezone.utc), list(tracked))
        tables.commit_events(batch.sparkSession, table, rows)

    query = (
        first_arrivals(event_stream(spark, landed, max_files_per_batch), kept_for)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", progress_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # Batches run in a session of their own, so the caller's list of files is renewed here.
    spark.catalog.refreshTable(table)
