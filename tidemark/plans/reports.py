"""Analytical reports. "Today" is always a parameter, so results are reproducible.

Bounds on dates are literals: they reach the scan as partition or pushed filters.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.instants import minutes
from tidemark.operators.incremental import as_instant
from tidemark.operators.overlap import overlapping_pairs
from tidemark.operators.ranking import latest_rows

VIEW_ACTIVITY = "ViewReport"


def _days_before(as_of: date, days: int) -> Column:
    return F.lit(as_of - timedelta(days=days))


def _instant_before(as_of: date, days: int) -> Column:
    return F.lit(as_instant(as_of - timedelta(days=days))).cast("timestamp")


def _completed(refresh: DataFrame) -> DataFrame:
    return refresh.filter(F.col("status") == "Completed")


def started_since(refresh: DataFrame, as_of: date, days: int, ingested_after_start: bool = False) -> DataFrame:
    """Refreshes that started at most ``days`` before today.

    The table is partitioned by ingestion day. ``ingested_after_start`` states that no row was
    ingested more than a day before it started, so older partitions are not read.
    """
    recent = refresh.filter(F.col("start_time") >= _instant_before(as_of, days))
    return recent.filter(F.col("ingestion_date") >= _days_before(as_of, days + 1)) if ingested_after_start else recent


def latest_status(refresh: DataFrame) -> DataFrame:
    """Newest refresh of each dataset, critical datasets first."""
    return (
        latest_rows(refresh, "dataset_id", "start_time")
        .orderBy(F.desc("is_critical"), "dataset_name")
        .select(
            "dataset_name",
            "workspace_name",
            "status",
            "refresh_type",
            "start_time",
            "end_time",
            minutes(F.col("duration_seconds")).alias("duration_minutes"),
            "error_code",
        )
    )


def daily_status_counts(refresh: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Refreshes per ingestion day and status."""
    return (
        refresh.filter(F.col("ingestion_date") >= _days_before(as_of, days))
        .groupBy("ingestion_date", "status")
        .agg(F.count(F.lit(1)).alias("refresh_count"))
        .orderBy(F.desc("ingestion_date"), "status")
    )


def average_duration(
    refresh: DataFrame, as_of: date, days: int = 7, ingested_after_start: bool = False
) -> DataFrame:
    """Mean, longest and shortest completed refresh per dataset."""
    duration = F.col("duration_seconds")
    return (
        started_since(_completed(refresh), as_of, days, ingested_after_start)
        .groupBy("dataset_name", "workspace_name")
        .agg(
            F.count(F.lit(1)).alias("completed_refreshes"),
            minutes(F.avg(duration)).alias("avg_duration_minutes"),
            minutes(F.max(duration)).alias("max_duration_minutes"),
            minutes(F.min(duration)).alias("min_duration_minutes"),
        )
        .orderBy(F.desc("avg_duration_minutes"))
    )


def duration_trend(
    refresh: DataFrame, dataset_name: str, as_of: date, days: int = 30, ingested_after_start: bool = False
) -> DataFrame:
    """Mean duration of one dataset per day."""
    return (
        started_since(_completed(refresh), as_of, days, ingested_after_start)
        .filter(F.col("dataset_name") == dataset_name)
        .groupBy(F.to_date("start_time").alias("refresh_date"))
        .agg(
            minutes(F.avg("duration_seconds")).alias("avg_duration_minutes"),
            F.count(F.lit(1)).alias("refresh_count"),
        )
        .orderBy("refresh_date")
    )


def failures(refresh: DataFrame, as_of: date, days: int = 7, ingested_after_start: bool = False) -> DataFrame:
    """Failed refreshes with their error, critical ones first."""
    return (
        started_since(refresh.filter(F.col("status") == "Failed"), as_of, days, ingested_after_start)
        .select(
            "dataset_name", "workspace_name", "start_time", "error_code", "service_exception_json", "is_critical"
        )
        .orderBy(F.desc("is_critical"), F.desc("start_time"))
    )


def freshness(refresh: DataFrame, as_of_ts: datetime) -> DataFrame:
    """Hours since the last successful refresh; whole seconds count."""
    now = F.unix_timestamp(F.lit(as_of_ts).cast("timestamp"))
    last = F.col("last_successful_refresh")
    return (
        _completed(refresh)
        .groupBy("dataset_name", "workspace_name", "is_critical")
        .agg(F.max("end_time").alias("last_successful_refresh"))
        .withColumn(
            "hours_since_refresh", F.round((now - F.unix_timestamp(last)) / F.lit(3600.0), 1)
        )
        .orderBy(F.desc("is_critical"), F.desc("hours_since_refresh"))
    )


def weekly_means(refresh: DataFrame, as_of: date, ingested_after_start: bool = False) -> DataFrame:
    """Mean duration of the last week and of the one before, for datasets that ran in both.

    Both weeks come from one pass, which replaces a self-join of the weekly means.
    """
    this_week = F.col("start_time") >= _instant_before(as_of, 7)
    return (
        started_since(_completed(refresh), as_of, 14, ingested_after_start)
        .groupBy("dataset_name")
        .agg(
            F.avg(F.when(~this_week, F.col("duration_seconds"))).alias("last_week_mean"),
            F.avg(F.when(this_week, F.col("duration_seconds"))).alias("this_week_mean"),
        )
        .filter(F.col("last_week_mean").isNotNull() & F.col("this_week_mean").isNotNull())
    )


def week_over_week(refresh: DataFrame, as_of: date, ingested_after_start: bool = False) -> DataFrame:
    """Datasets whose mean duration rose; a mean of zero gives no percentage."""
    before, now = F.col("last_week_mean"), F.col("this_week_mean")
    return (
        weekly_means(refresh, as_of, ingested_after_start)
        .filter(now > before)
        .select(
            "dataset_name",
            minutes(before).alias("last_week_avg_min"),
            minutes(now).alias("this_week_avg_min"),
            F.round(F.try_divide(now - before, before) * 100, 1).alias("pct_change"),
        )
        .orderBy(F.desc("pct_change"))
    )


def overlapping_refreshes(
    refresh: DataFrame,
    as_of: date,
    days: int = 1,
    ingested_after_start: bool = False,
    longest_days: int | None = None,
) -> DataFrame:
    """Completed refreshes that ran at the same time; the date bound is on the first of a pair.

    Both runs of a pair end after the bound. If none lasts longer than ``longest_days``, none
    started earlier than that before the bound, and with ``ingested_after_start`` (see
    ``started_since``) older partitions are not read.
    """
    if ingested_after_start and longest_days is not None:
        refresh = refresh.filter(F.col("ingestion_date") >= _days_before(as_of, days + longest_days + 1))
    pairs = overlapping_pairs(
        _completed(refresh),
        "request_id",
        "start_time",
        "end_time",
        carry=["dataset_name"],
        first_since=as_instant(as_of - timedelta(days=days)),
    )
    return pairs.select(
        F.col("a.dataset_name").alias("dataset_a"),
        F.col("b.dataset_name").alias("dataset_b"),
        F.col("a.start").alias("a_start"),
        F.col("a.end").alias("a_end"),
        F.col("b.start").alias("b_start"),
        F.col("b.end").alias("b_end"),
    ).orderBy("a_start")


def _report_views(events: DataFrame, as_of: date, days: int) -> DataFrame:
    return events.filter(
        (F.col("activity") == VIEW_ACTIVITY)
        & (F.col("creation_date") >= _days_before(as_of, days))
        & F.col("report_name").isNotNull()
    )


def most_viewed(events: DataFrame, as_of: date, days: int = 30, top: int | None = None) -> DataFrame:
    """Views and distinct users per report, most viewed first; ``top`` keeps the first ones."""
    ranked = (
        _report_views(events, as_of, days)
        .groupBy("report_name", "workspace_name")
        .agg(F.count(F.lit(1)).alias("views"), F.count_distinct("user_id").alias("distinct_users"))
        .orderBy(F.desc("views"), "report_name", "workspace_name")
    )
    return ranked if top is None else ranked.limit(top)


def least_viewed(events: DataFrame, as_of: date, days: int = 30, top: int = 25) -> DataFrame:
    """The reports with the fewest views among those viewed at all."""
    return (
        _report_views(events, as_of, days)
        .groupBy("report_name", "workspace_name")
        .agg(F.count(F.lit(1)).alias("views"), F.max("creation_date").alias("last_viewed"))
        .orderBy("views", "report_name", "workspace_name")
        .limit(top)
    )


def daily_views(events: DataFrame) -> DataFrame:
    """Views and distinct users per day over all history."""
    return (
        events.filter(F.col("activity") == VIEW_ACTIVITY)
        .groupBy("creation_date")
        .agg(F.count(F.lit(1)).alias("views"), F.count_distinct("user_id").alias("distinct_users"))
        .orderBy("creation_date")
    )


def top_users(events: DataFrame, as_of: date, days: int = 30, top: int = 25) -> DataFrame:
    """The most active users and how many reports they touched."""
    return (
        events.filter((F.col("creation_date") >= _days_before(as_of, days)) & F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("total_activities"),
            F.count_distinct("report_id").alias("distinct_reports"),
        )
        .orderBy(F.desc("total_activities"), "user_id")
        .limit(top)
    )
