"""Activity pages as a file stream: pages wait, batch after batch, until the chain of their day is whole."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import schemas
from tidemark.operators import transform
from tidemark.session import materialize, remove_folder, small_side
from tidemark.sinks import files, tables
from tidemark.sources import landing
from tidemark.streaming.state import Carried

HELD = "day date, page_no long, activityEventEntities array<string>, continuationToken string, continuationUri string"
INDEX = "day date, page_no long, goes_on boolean, batch long, loaded boolean"


def page_stream(spark: SparkSession, landed: str, max_files_per_batch: int = 10_000) -> DataFrame:
    """Landed activity pages as a stream, with the file of each."""
    pages = (
        spark.readStream.schema(schemas.ACTIVITY_PAGE)
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .json(landed)
    )
    return pages.select("*", F.col("_metadata.file_path").alias("source_file"))


def due_pages(index: DataFrame, first_page: int | None) -> DataFrame:
    """Pages of the index (``INDEX``) that are not loaded and can be: day, page number and batch.

    A day can be loaded once its chain is whole from ``first_page`` to a page that does not go on. Pages that
    arrive for such a day later are due at once; only days with pages still to load are looked at.
    """
    waiting = index.filter(~F.col("loaded"))
    days = index.join(small_side(waiting.select("day").distinct()), "day", "left_semi")
    pages = days.groupBy("day", "page_no").agg(F.max("goes_on").alias("goes_on"), F.lit(False).alias("damaged"))
    whole = small_side(landing.whole_chains(materialize(pages, "page-index"), first_page))
    return waiting.join(whole, "day").filter(F.col("page_no") <= F.col("last_page")).select("day", "page_no", "batch")


def ingest_pages(
    spark: SparkSession,
    landed: str,
    table: str,
    progress_path: str,
    first_page: int | None = 1,
    tracked: tuple[str, ...] = (),
    quarantine: str | None = None,
    max_files_per_batch: int = 10_000,
) -> None:
    """Load the events of every day whose pages have all arrived, in whatever order they came.

    Three folders belong to the stream: its progress, the pages that wait (one folder a batch, removed when all its
    pages are loaded) and a small index of all pages seen. A batch that is repeated after a failure loads the
    same events, which the table already has then. The table ends up with the events that reading all files at once
    would give; a damaged file has no place in a chain, so it is only listed in the folder ``quarantine``, and its
    day waits for the page unless the chain is whole without it. Pages behind the end of a chain wait forever.
    """
    tables.create_table(spark, table, tables.ACTIVITY_TABLE)
    held, seen = Carried(f"{progress_path}_pages", HELD), Carried(f"{progress_path}_index", INDEX)

    def load(batch: DataFrame, batch_id: int) -> None:
        session, run_at = batch.sparkSession, datetime.now(timezone.utc)
        before = seen.before(session, batch_id)
        _remove_loaded(session, held, before, batch_id)
        arrived = materialize(batch, "pages")
        numbered = F.col("day").isNotNull() & F.col("page_no").isNotNull() & F.col(schemas.CORRUPT).isNull()
        if quarantine is not None:
            reason = F.when(F.col(schemas.CORRUPT).isNotNull(), "malformed document").otherwise("page without day or number")
            content = F.coalesce(F.col(schemas.CORRUPT), F.to_json(F.struct("day", "page_no", "activityEventEntities")))
            damaged = arrived.filter(~numbered).select("source_file", reason.alias("reason"), content.alias("content"))
            files.replace_quarantine(damaged, quarantine, run_at, batch_id)
        good = arrived.filter(numbered)
        held.write(batch_id, good.select(*(c.split()[0] for c in HELD.split(", "))))
        fresh = good.select("day", "page_no", landing.continues().alias("goes_on"), F.lit(batch_id).cast("long").alias("batch"), F.lit(False).alias("loaded"))
        index = materialize(before.unionByName(fresh), "page-index")
        due = materialize(due_pages(index, first_page).distinct(), "due-pages")
        numbers = sorted(row.batch for row in due.select("batch").distinct().collect())
        kept = [number for number in held.numbers(session) if number in numbers]
        if kept:
            pages = session.read.schema(f"{HELD}, batch long").option("basePath", held.path).parquet(*map(held.folder, kept))
            whole = pages.join(small_side(due), ["day", "page_no", "batch"], "left_semi")
            rows = transform.activity_rows(landing.page_events(whole), run_at, list(tracked))
            tables.commit_events(session, table, rows, immutable_days=True)
        marked = index.join(due.withColumn("due", F.lit(True)), ["day", "page_no", "batch"], "left")
        seen.write(batch_id, marked.select("day", "page_no", "goes_on", "batch", (F.col("loaded") | F.coalesce("due", F.lit(False))).alias("loaded")))

    query = (
        page_stream(spark, landed, max_files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", progress_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # Batches run in a session of their own, so the caller's list of files is renewed here.
    spark.catalog.refreshTable(table)


def _remove_loaded(spark: SparkSession, held: Carried, index: DataFrame, batch_id: int) -> None:
    """Remove the waiting pages of batches whose pages were all loaded before this batch."""
    earlier = [number for number in held.numbers(spark) if number < batch_id]
    if earlier:
        waiting = {row.batch for row in index.filter(~F.col("loaded")).select("batch").distinct().collect()}
        for number in set(earlier) - waiting:
            remove_folder(spark, held.folder(number))
