"""Refresh envelopes as a file stream: each run takes the files landed since the last one."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import schemas
from tidemark.operators import registry, transform
from tidemark.session import materialize, small_side
from tidemark.sinks import files, tables
from tidemark.sources import landing
from tidemark.streaming.state import Carried

RECORDS = f"workspace_id string, dataset_id string, source_file string, {schemas.RAW_REFRESH}"


def refresh_stream(spark: SparkSession, landed: str, max_files_per_batch: int = 10_000) -> DataFrame:
    """Refresh envelopes of a landing folder as a stream, with the file of each."""
    envelopes = (
        spark.readStream.schema(schemas.REFRESH_ENVELOPE)
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .json(landed)
    )
    return envelopes.select("*", F.col("_metadata.file_path").alias("source_file"))


def ingest_refresh(
    spark: SparkSession,
    landed: str,
    datasets: DataFrame | Callable[[SparkSession], DataFrame],
    table: str,
    progress_path: str,
    quarantine: str | None = None,
    max_files_per_batch: int = 10_000,
) -> None:
    """Merge all files not seen so far into the table.

    The stream's progress folder replaces the high-water mark. A batch repeated after a failure merges to the
    same table. ``datasets`` may be a function, which every batch calls, so that the registry is the current one.
    Records of datasets that are not registered wait in a folder beside the progress, and are merged by the first
    batch (or the next run, before it looks for files) after their dataset was registered. Malformed documents
    and records without an id are listed in the folder ``quarantine``, which this stream must have for itself.
    """
    tables.create_table(spark, table, tables.REFRESH_TABLE)
    waiting = Carried(f"{progress_path}_waiting", RECORDS)

    def registered(session: SparkSession) -> DataFrame:
        return small_side(datasets(session) if callable(datasets) else datasets)

    def merge(records: DataFrame, attributes: DataFrame) -> None:
        known = registry.enrich(records, attributes)
        tables.commit_refresh(records.sparkSession, table, transform.refresh_rows(known, datetime.now(timezone.utc)))

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        arrived = materialize(batch, "envelopes")
        if quarantine is not None:
            damaged = arrived.filter(F.col(schemas.CORRUPT).isNotNull())
            damaged = damaged.select("source_file", F.lit("malformed document").alias("reason"), F.col(schemas.CORRUPT).alias("content"))
            nameless = landing.records_without_id(landing.records_of(arrived), "requestId")
            files.replace_quarantine(damaged.unionByName(nameless), quarantine, datetime.now(timezone.utc), batch_id)
        records = transform.require_id(landing.records_of(arrived), "requestId").unionByName(waiting.before(session, batch_id))
        records, attributes = materialize(records, "records"), registered(session)
        merge(records, attributes)
        waiting.write(batch_id, records.join(attributes.select("dataset_id"), "dataset_id", "left_anti").select(records.columns))

    numbers = waiting.numbers(spark)
    if numbers:
        left = waiting.before(spark, numbers[-1] + 1)
        attributes = registered(spark)
        newly = left.join(attributes.select("dataset_id"), "dataset_id", "left_semi")
        if not newly.isEmpty():
            merge(newly, attributes)

    query = (
        refresh_stream(spark, landed, max_files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", progress_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # Batches run in a session of their own, so the caller's list of files is renewed here.
    spark.catalog.refreshTable(table)
