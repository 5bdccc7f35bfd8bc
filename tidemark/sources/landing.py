"""Readers of landed API responses: one JSON document per response."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark import schemas
from tidemark.functions.payloads import payload_row_count
from tidemark.operators.ranking import first_per_key
from tidemark.operators.transform import missing_id
from tidemark.session import materialize, small_side


def read_json(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """Read documents with a declared schema; a malformed one is kept in the corrupt column."""
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .option("multiLine", multi_line)
        .json(path)
    )


def refresh_records(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Refresh records of all envelopes; an envelope without ``value`` gives no rows."""
    envelopes = read_json(spark, path, schemas.REFRESH_ENVELOPE, multi_line)
    return records_of(envelopes.select("*", F.col("_metadata.file_path").alias("source_file")))


def records_of(envelopes: DataFrame) -> DataFrame:
    """The records of envelopes that carry the name of their file."""
    exploded = envelopes.select("workspace_id", "dataset_id", "source_file", F.explode("value").alias("record"))
    return exploded.select("workspace_id", "dataset_id", "source_file", "record.*")


def malformed_documents(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """Documents that do not fit their schema: file, ``reason`` and the text as it was landed."""
    landed = spark.read.option("wholetext", multi_line).text(path)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
    corrupt = F.from_json("value", schema, options)[schemas.CORRUPT]
    found = landed.select(F.col("_metadata.file_path").alias("source_file"), corrupt.alias("content"))
    return found.filter(F.col("content").isNotNull()).select("source_file", F.lit("malformed document").alias("reason"), "content")


def records_without_id(records: DataFrame, id_column: str) -> DataFrame:
    """Landed records whose id is missing, in the columns of ``malformed_documents``."""
    kept = [name for name in records.columns if name != "source_file"]
    return missing_id(records, id_column).select(
        "source_file", F.lit(f"missing {id_column}").alias("reason"), F.to_json(F.struct(*kept)).alias("content")
    )


def newest_per_dataset(records: DataFrame, instant: Column, tie: Column, top: int) -> DataFrame:
    """At most ``top`` newest records per dataset."""
    return first_per_key(records, ["dataset_id"], [instant.desc_nulls_last(), tie.asc()], top)


def dataset_listing(
    spark: SparkSession, path: str, multi_line: bool = False, name_by_id: bool = False
) -> DataFrame:
    """Datasets of each listed workspace with their position in the listing.

    A dataset without a name is called ``Unknown``, or by its id if ``name_by_id`` is set.
    """
    unnamed = F.col("item.id") if name_by_id else F.lit("Unknown")
    listing = read_json(spark, path, schemas.DATASET_LISTING, multi_line)
    return listing.select("workspace_id", F.posexplode("value").alias("item_pos", "item")).select(
        "workspace_id",
        "item_pos",
        F.col("item.id").alias("id"),
        F.coalesce("item.name", unnamed).alias("name"),
        F.col("item.isRefreshable").alias("is_refreshable"),
    )


def workspace_listing(
    spark: SparkSession, path: str, top: int | None = None, multi_line: bool = False
) -> DataFrame:
    """Visible workspaces, or the first ``top`` of them by id."""
    listing = read_json(spark, path, schemas.WORKSPACE_LISTING, multi_line)
    found = listing.select(F.explode("value").alias("item")).select(
        F.col("item.id").alias("id"), F.col("item.name").alias("name")
    )
    return found if top is None else found.orderBy("id").limit(top)


def activity_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All landed activity pages; ``day`` may be a directory, so a day filter prunes files."""
    return read_json(spark, path, schemas.ACTIVITY_PAGE, multi_line)


def continues() -> Column:
    """Whether a page names a page after it."""
    token, uri = F.col("continuationToken"), F.col("continuationUri")
    return F.coalesce((token != "") & (uri != ""), F.lit(False))


def page_index(pages: DataFrame) -> DataFrame:
    """One row per day and page number, with whether the chain goes on after it and whether a page is damaged.

    Computed once: it is far smaller than the pages, whose text is then read only for the events.
    A page fetched twice goes on if either copy does. A malformed page has no number.
    """
    damaged = F.col(schemas.CORRUPT).isNotNull() if schemas.CORRUPT in pages.columns else F.lit(False)
    found = pages.groupBy("day", "page_no").agg(F.max(continues()).alias("goes_on"), F.max(damaged).alias("damaged"))
    return materialize(found)


def chains(index: DataFrame) -> DataFrame:
    """First page of each day, and the first one that does not go on."""
    return index.groupBy("day").agg(
        F.min("page_no").alias("first_page"),
        F.min(F.when(~F.col("goes_on"), F.col("page_no"))).alias("last_page"),
    )


def follow_continuation(pages: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Pages of each day up to and including the first one that does not continue.

    The end of each chain is a small per-day minimum, so no day is gathered in one task.
    """
    ends = small_side(chains(page_index(pages) if index is None else index))
    return (
        pages.join(ends.select("day", "last_page"), "day", "left")
        .filter(F.col("last_page").isNull() | (F.col("page_no") <= F.col("last_page")))
        .drop("last_page")
    )


def unfinished_days(index: DataFrame, first_page: int | None = None) -> DataFrame:
    """Days of a page index that are not whole.

    Their chain has no last page or a gap, does not begin at ``first_page`` or before it (if given),
    or a page of the day is malformed or has no number, so that nobody knows what it held.
    """
    within = F.col("last_page").isNull() | (F.col("page_no") <= F.col("last_page"))
    spans = (
        index.join(small_side(chains(index)), "day")
        .groupBy("day", "first_page", "last_page")
        .agg(
            F.count_if(within & F.col("page_no").isNotNull()).alias("n_pages"),
            F.max(F.col("damaged") | F.col("page_no").isNull()).alias("damaged"),
        )
    )
    whole = F.col("n_pages") == F.col("last_page") - F.col("first_page") + 1
    late = F.lit(False) if first_page is None else F.col("first_page") > first_page
    return spans.filter(F.col("damaged") | F.col("last_page").isNull() | ~whole | late).select("day")


def whole_chains(index: DataFrame, first_page: int | None = None) -> DataFrame:
    """First and last page of the days of a page index that are whole."""
    return chains(index).join(unfinished_days(index, first_page), "day", "left_anti")


def page_events(pages: DataFrame) -> DataFrame:
    """Raw events of the pages as JSON text, with the day they were fetched for."""
    return pages.select(F.col("day").alias("fetch_day"), F.explode("activityEventEntities").alias("raw"))


def probe_row_counts(responses: DataFrame, payload: str = "payload") -> DataFrame:
    """Attach the row count of each probe response."""
    return responses.withColumn("row_count", payload_row_count(F.col(payload)))
