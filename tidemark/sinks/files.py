"""CSV exports and the JSON report of endpoint statistics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.instants import month_bucket
from tidemark.operators import merge
from tidemark.session import materialize, measured, path_exists, small_side
from tidemark.sinks.id_index import IdIndex
from tidemark.sources.tables import CSV_WRITE, csv_history

FILE_KEY = "file_key"


def write_refresh_csv(rows: DataFrame, path: str) -> None:
    """Replace the refresh export."""
    rows.write.mode("overwrite").options(**CSV_WRITE).csv(path)


def new_for_export(events: DataFrame, known_ids: DataFrame) -> DataFrame:
    """Events not exported before, one per id."""
    return merge.one_per_event(events).join(known_ids.select("event_id"), "event_id", "left_anti")


def create_csv_index(spark: SparkSession, path: str, columns: list[str]) -> IdIndex:
    """Index the ids of a monthly export; from then on appends look ids up there instead of reading the history."""
    index = IdIndex(spark, path)
    index.create(csv_history(spark, path, columns).select("event_id", FILE_KEY), "event_id", FILE_KEY)
    return index


def append_monthly_csv(events: DataFrame, path: str) -> None:
    """Append new events to the folder of their month, ``file_key=activity_events_YYYY_MM``.

    An event without a usable time goes to the month of ``fetch_day``, if the events have that
    column, which is not written. The ids of the batch are looked up in the id index, if the export has one, and
    otherwise in the history, whose ids are only streamed past them.
    """
    spark = events.sparkSession
    columns = [name for name in events.columns if name != "fetch_day"]
    day = F.coalesce("creation_date", "fetch_day") if "fetch_day" in events.columns else F.col("creation_date")
    new = merge.one_per_event(events).withColumn(FILE_KEY, month_bucket(day)).select(*columns, FILE_KEY)
    index = IdIndex(spark, path)
    indexed = index.exists()
    if indexed:

        def stored(pending: DataFrame) -> DataFrame:
            months = [row[0] for row in pending.select(FILE_KEY).distinct().collect()]  # of one batch
            history = csv_history(spark, path, columns).filter(F.col(FILE_KEY).isin(months))
            return merge.known_ids(history, pending.select("event_id"), "event_id")

        index.settle(stored)
        batch = materialize(new)
        new = materialize(batch.join(small_side(index.lookup(batch).select("event_id")), "event_id", "left_anti").select(batch.columns), "new-events")
        announced = index.announce(new)
    elif path_exists(spark, path):
        batch = materialize(new)
        ids = measured(batch).frame.select("event_id")
        known = merge.known_ids(csv_history(spark, path, columns), ids, "event_id")
        new = batch.join(known, "event_id", "left_anti").select(batch.columns)
    (
        new.hint("rebalance", F.col(FILE_KEY))
        .write.mode("append")
        .partitionBy(FILE_KEY)
        .options(**CSV_WRITE)
        .csv(path)
    )
    if indexed:
        index.record(announced)


def file_summary(spark: SparkSession, path: str) -> DataFrame:
    """Rows and size of every file of an export."""
    return (
        csv_history(spark, path)
        .select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("size"))
        .groupBy("file_path", "size")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select("file_path", "n_rows", F.round(F.col("size") / F.lit(1024.0), 1).alias("size_kb"))
    )


def append_quarantine(found: DataFrame, path: str, run_at: datetime) -> None:
    """Append landed input that could not be loaded: file, reason, content and the time of the run."""
    found.withColumn("run_at", F.lit(run_at).cast("timestamp")).write.mode("append").parquet(path)


def replace_quarantine(found: DataFrame, path: str, run_at: datetime, batch_id: int) -> None:
    """What a stream's batch could not load, in a folder of the batch; a repeated batch replaces it."""
    found.withColumn("run_at", F.lit(run_at).cast("timestamp")).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def write_json_report(stats: DataFrame, path: str, generated_at: datetime, settings: dict[str, str]) -> None:
    """Write endpoint statistics with the settings of their run, one document per endpoint."""
    pairs = [F.lit(text) for item in settings.items() for text in item]
    stamped = stats.select(
        F.lit(generated_at).cast("timestamp").alias("generated_at_utc"),
        F.create_map(*pairs).cast("map<string,string>").alias("settings"),
        *stats.columns,
    )
    stamped.write.mode("overwrite").json(path)
