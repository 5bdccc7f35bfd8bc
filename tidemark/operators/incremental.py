"""High-water marks, fetch windows and the pruning they allow."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions.instants import day_bounds
from tidemark.session import materialize, small_side

# The audit source keeps 28 days.
RETENTION_DAYS = 28

# Days listed as literals, which prunes partitions when the plan is made; more are joined.
MAX_LISTED_DAYS = 2_000


def watermarks(refresh: DataFrame) -> DataFrame:
    """Newest start per dataset."""
    return (
        refresh.filter(F.col("start_time").isNotNull())
        .groupBy("dataset_id")
        .agg(F.max("start_time").alias("watermark"))
    )


def with_watermark(records: DataFrame, marks: DataFrame) -> DataFrame:
    """Attach each record's watermark, null where the dataset has none."""
    return records.join(marks.select("dataset_id", "watermark"), "dataset_id", "left")


def newer_than_watermark(
    records: DataFrame, marks: DataFrame, start: Column, lookback: timedelta | None = None
) -> DataFrame:
    """Records that start after the watermark of their dataset.

    ``start`` is a timestamp expression; records without a usable start are kept, and so is
    everything of a dataset without a watermark. ``lookback`` moves the mark back.
    """
    mark = F.col("watermark") if lookback is None else F.col("watermark") - F.lit(lookback)
    keep = F.col("watermark").isNull() | start.isNull() | (start > mark)
    return with_watermark(records, marks).filter(keep).drop("watermark")


def _holding(bins: DataFrame, offset: Column) -> DataFrame:
    """Of the counted bins (``bin``, ``n``) of each dataset the one that holds the element at ``offset``, and its place there."""
    whole = Window.partitionBy("dataset_id")
    before = F.coalesce(F.sum("n").over(whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = bins.withColumn("total", F.sum("n").over(whole)).withColumn("place", offset - before)
    return placed.filter((F.col("place") >= 0) & (F.col("place") < F.col("n"))).select("dataset_id", "bin", F.col("place").alias("offset"))


def midpoint_watermarks(refresh: DataFrame, chunk_seconds: int = 3600) -> DataFrame:
    """Element ``n div 2`` of the sorted starts of each dataset (the upper median), exact.

    Starts are counted by second once. Sums of these counts by chunk locate the chunk that holds the element,
    the counts inside it the second; only the rows of that second are read again. Rows are only ever counted, so
    a dataset with all its rows in one minute is neither sorted nor gathered in one task.
    """
    starts = refresh.filter(F.col("start_time").isNotNull()).select("dataset_id", F.unix_micros("start_time").alias("at"))
    second = F.floor(F.col("at") / 1_000_000)
    seconds = materialize(starts.groupBy("dataset_id", second.alias("second")).agg(F.count(F.lit(1)).alias("n")), "seconds")
    chunk = F.floor(F.col("second") / chunk_seconds)
    chunks = seconds.groupBy("dataset_id", chunk.alias("bin")).agg(F.sum("n").alias("n"))
    in_chunk = _holding(chunks, F.expr("total div 2")).withColumnRenamed("bin", "chunk")
    near = seconds.withColumn("chunk", chunk).join(in_chunk, ["dataset_id", "chunk"]).withColumnRenamed("second", "bin")
    in_second = small_side(_holding(near, F.col("offset")).withColumnRenamed("bin", "second"))
    instants = starts.withColumn("second", second).join(in_second, ["dataset_id", "second"]).groupBy("dataset_id", F.col("at").alias("bin"), "offset").agg(F.count(F.lit(1)).alias("n"))
    located = _holding(instants, F.col("offset"))
    return located.select("dataset_id", F.timestamp_micros("bin").alias("watermark"))


def max_activity_date(events: DataFrame) -> DataFrame:
    """One row: the newest stored activity day, null for an empty table."""
    return events.agg(F.max("creation_date").alias("max_date"))


def max_completed_day(fetch_log: DataFrame) -> DataFrame:
    """One row: the newest day before the first one not fetched completely.

    Unlike the newest stored day it moves past days without events.
    """
    open_day = fetch_log.filter(F.col("outcome") != "ok").agg(F.min("day")).scalar()
    before_open = F.col("day") < F.coalesce(open_day, F.lit(date.max))
    done = fetch_log.filter((F.col("outcome") == "ok") & before_open)
    return done.agg(F.max("day").alias("max_date"))


def _day_rows(one_row: DataFrame, first: Column, last: Column) -> DataFrame:
    # sequence() rejects reversed bounds, also while constants are folded, so the upper bound is
    # lifted first and the filter comes after.
    spread = F.sequence(first, F.greatest(first, last), F.expr("interval 1 day"))
    return one_row.select(F.explode(spread).alias("day"), last.alias("last")).filter("day <= last").select("day")


def dates_to_fetch(
    last_loaded: DataFrame, lookback_days: int, today: date, retention_days: int | None = None
) -> DataFrame:
    """Days to fetch, ending yesterday; ``last_loaded`` is one row with ``max_date``.

    The window opens ``lookback_days`` ago or at the newest loaded day, which is fetched again so
    that late events land. ``retention_days`` bounds it to what a source still holds; landed data
    needs no such bound. ``days_past_retention`` lists what the bound leaves out.
    """
    back = max(1, lookback_days if retention_days is None else min(lookback_days, retention_days))
    opens, closes = F.lit(today - timedelta(days=back)), F.lit(today - timedelta(days=1))
    resume = F.when(F.col("max_date") >= opens, F.col("max_date")).otherwise(opens)
    return _day_rows(last_loaded, resume, closes)


def days_past_retention(last_loaded: DataFrame, lookback_days: int, today: date, retention_days: int) -> DataFrame:
    """Days that ``dates_to_fetch`` would name without ``retention_days``, but doesn't with it."""
    wanted = dates_to_fetch(last_loaded, lookback_days, today)
    return wanted.filter(F.col("day") < F.lit(today - timedelta(days=max(1, retention_days))))


def limit_backfill(days: DataFrame, max_days: int | None) -> DataFrame:
    """The oldest ``max_days`` days; None or a non-positive number keeps all."""
    if not max_days or max_days <= 0:
        return days
    return days.orderBy("day").limit(max_days)


def with_bounds(days: DataFrame) -> DataFrame:
    """Attach the request bounds of each day."""
    first, last = day_bounds(F.col("day"))
    return days.withColumn("start_bound", first).withColumn("end_bound", last)


def export_range(
    spark: SparkSession,
    today: date,
    lookback_days: int = RETENTION_DAYS,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Days of an export, an explicit range or the last ``lookback_days`` (not clamped), with a
    flag for days the source no longer holds."""
    first = start or today - timedelta(days=lookback_days)
    last = (end if start else None) or today - timedelta(days=1)
    days = _day_rows(spark.range(1), F.lit(first), F.lit(last))
    return days.withColumn("past_retention", F.col("day") < F.lit(today - timedelta(days=RETENTION_DAYS)))


def listed_days(days: DataFrame, column: str = "day") -> list[date | None] | None:
    """The distinct days of a frame, or None for more than ``MAX_LISTED_DAYS`` of them."""
    listed = [row[0] for row in days.select(column).distinct().limit(MAX_LISTED_DAYS + 1).collect()]
    return listed if len(listed) <= MAX_LISTED_DAYS else None


def on_days(column: str, listed: list[date | None]) -> Column:
    """Whether a day is in a list; literals prune partitions when the plan is made."""
    keep = F.col(column).isin([day for day in listed if day is not None])
    return keep | F.col(column).isNull() if None in listed else keep


def only_days(rows: DataFrame, days: DataFrame, column: str = "day") -> DataFrame:
    """Rows on the days in the same-named column of ``days``, null being a day of its own.

    Few days become literals, many a semi-join; both keep the same rows.
    """
    listed = listed_days(days, column)
    if listed is None:
        wanted = days.select(F.col(column).alias("__day")).distinct()
        return rows.join(wanted, F.col(column).eqNullSafe(F.col("__day")), "left_semi")
    return rows.filter(on_days(column, listed))


def as_instant(day: date) -> datetime:
    """Midnight of a day, for comparisons that reach the scan."""
    return datetime(day.year, day.month, day.day)
