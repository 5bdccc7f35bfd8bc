"""The three pipelines from landed responses to stored tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import schemas
from tidemark.functions.instants import parse_instant
from tidemark.operators import incremental, merge, registry, transform, triage
from tidemark.plans.alerts import AlertSettings, all_alerts, routed, with_cards
from tidemark.session import materialize, small_side
from tidemark.sinks import files, tables
from tidemark.sources import landing
from tidemark.sources.tables import scan_if_present


@dataclass(frozen=True)
class UsageSettings:
    """Window and filter of the usage pipeline."""

    lookback_days: int = 28
    max_days_per_run: int | None = None
    retention_days: int | None = None
    tracked_activities: tuple[str, ...] = ()
    incremental: bool = True
    stop_on_denied: bool = False
    first_page: int | None = None


def new_refresh_rows(
    spark: SparkSession,
    landed: str,
    datasets: DataFrame,
    table: str,
    run_at: datetime,
    incremental_mode: bool = True,
    top: int | None = None,
) -> DataFrame:
    """Landed refresh records that are new or were still running, as table rows.

    Responses are capped when they are fetched; ``top`` caps each dataset again where several
    responses of it are landed and only the newest records are wanted.
    """
    landed_records = transform.require_id(landing.refresh_records(spark, landed), "requestId")
    records = registry.enrich(landed_records, small_side(datasets))
    start = parse_instant(F.col("startTime"))
    if top is not None:
        records = landing.newest_per_dataset(records, start, F.col("requestId"), top)
    if incremental_mode:
        stored = scan_if_present(spark, table, schemas.REFRESH_HISTORY)
        marks = small_side(tables.watermarks(spark, table) if spark.catalog.tableExists(table) else incremental.watermarks(stored))
        running = stored.filter(F.col("status") == merge.RUNNING).select(
            F.col("request_id").alias("requestId"), F.lit(True).alias("was_running")
        )
        fresh = F.col("watermark").isNull() | start.isNull() | (start > F.col("watermark"))
        records = (
            incremental.with_watermark(records, marks)
            .join(small_side(running), "requestId", "left")
            .filter(fresh | F.col("was_running"))
            .drop("watermark", "was_running")
        )
    return transform.refresh_rows(records, run_at)


def run_refresh(
    spark: SparkSession,
    landed: str,
    datasets: DataFrame,
    table: str,
    run_at: datetime,
    incremental_mode: bool = True,
    alerts_path: str | None = None,
    alert_settings: AlertSettings | None = None,
    location: str | None = None,
    top: int | None = None,
    ingested_after_start: bool = False,
    card_channel: bool = False,
    quarantine: str | None = None,
) -> DataFrame:
    """Load landed refresh envelopes and raise alerts; returns the row of ``triage.run_stats``.

    Datasets with a malformed document count as failed where the document still names them.
    Documents that do not fit and records without an id are listed in the folder ``quarantine``.
    Stored alerts carry log level, channel and card.

    Alerts are checked on every run, so staleness shows even when nothing arrives.
    ``ingested_after_start`` prunes what they read, see ``reports.started_since``.
    """
    tables.create_table(spark, table, tables.REFRESH_TABLE, location)
    rows = new_refresh_rows(spark, landed, datasets, table, run_at, incremental_mode, top)
    new = tables.commit_refresh(spark, table, rows)
    if quarantine is not None:
        files.append_quarantine(landing.malformed_documents(spark, landed, schemas.REFRESH_ENVELOPE), quarantine, run_at)
        nameless = landing.records_without_id(landing.refresh_records(spark, landed), "requestId")
        files.append_quarantine(nameless, quarantine, run_at)
    if alerts_path is not None:
        found = all_alerts(spark.table(table), run_at.date(), run_at, alert_settings, ingested_after_start)
        tables.append_alerts(with_cards(routed(found, card_channel)), alerts_path)
    failed = landing.read_json(spark, landed, schemas.REFRESH_ENVELOPE).filter(F.col(schemas.CORRUPT).isNotNull())
    return triage.run_stats(datasets, new, failed.select("dataset_id", schemas.CORRUPT))


def run_usage(
    spark: SparkSession,
    landed: str,
    fetch_log: DataFrame,
    table: str,
    run_at: datetime,
    today: date,
    settings: UsageSettings = UsageSettings(),
    completed: DataFrame | None = None,
    location: str | None = None,
    quarantine: str | None = None,
) -> DataFrame:
    """Load the landed activity pages of the due days; returns ``triage.day_counts`` of what was loaded.

    Malformed pages keep their day open and, if ``quarantine`` names a folder, are listed there.

    ``fetch_log`` holds this run's responses (day, kind, status, error). Loading ends before the
    first day that was throttled, failed, not fetched or cut off between pages; that day is due
    again in the next run. ``completed`` (one row, ``max_date``) is the newest day known to be
    complete, see ``incremental.max_completed_day``; it moves past days without events, which the
    newest stored day alone does not.
    """
    tables.create_table(spark, table, tables.ACTIVITY_TABLE, location)
    stored = spark.table(table)
    loaded = tables.max_activity_date(spark, table) if settings.incremental else incremental.max_activity_date(stored.limit(0))
    if completed is not None and settings.incremental:
        loaded = loaded.union(completed.select("max_date")).agg(F.max("max_date").alias("max_date"))
    window = materialize(
        incremental.limit_backfill(
            incremental.dates_to_fetch(loaded, settings.lookback_days, today, settings.retention_days),
            settings.max_days_per_run,
        )
    )
    pages = incremental.only_days(landing.activity_pages(spark, landed), window)
    index = landing.page_index(pages)
    cut_off = landing.unfinished_days(index, settings.first_page)
    due = triage.loadable_days(window, fetch_log, cut_off, settings.stop_on_denied, pages.select("day"))
    whole = landing.follow_continuation(incremental.only_days(pages, due), index)
    raw, tracked = landing.page_events(whole), list(settings.tracked_activities)
    rows = materialize(transform.activity_rows(raw, run_at, tracked))
    known = incremental.only_days(spark.table(table), rows, "creation_date").select("event_id")
    counts = materialize(triage.day_counts(raw, known, tracked))
    tables.commit_events(spark, table, rows, immutable_days=True)
    if quarantine is not None:
        files.append_quarantine(landing.malformed_documents(spark, landed, schemas.ACTIVITY_PAGE), quarantine, run_at)
    return counts


def export_refresh(spark: SparkSession, landed: str, listing: DataFrame, path: str, run_at: datetime) -> None:
    """Replace the refresh export with all landed records of the listed datasets (id, name)."""
    names = listing.select(
        F.col("id").alias("dataset_id"),
        F.col("name").alias("dataset_name"),
        "workspace_id",
        F.lit("").alias("workspace_name"),
        F.lit(False).alias("is_critical"),
    )
    records = registry.enrich(landing.refresh_records(spark, landed), small_side(names))
    files.write_refresh_csv(transform.refresh_rows(records, run_at), path)


def export_activity(spark: SparkSession, landed: str, days: DataFrame, path: str, run_at: datetime) -> None:
    """Append the events of the given days that were not exported before to the monthly files."""
    pages = landing.follow_continuation(incremental.only_days(landing.activity_pages(spark, landed), days))
    rows = transform.activity_rows(landing.page_events(pages), run_at, keep=("fetch_day",))
    files.append_monthly_csv(rows, path)


def run_probes(
    spark: SparkSession, responses: DataFrame, probes: DataFrame, table: str, location: str | None = None
) -> None:
    """Append the measurements of the active probes."""
    tables.create_table(spark, table, tables.PROBE_TABLE, location)
    keys = ["workspace_id", "dataset_id", "query_label"]
    names = registry.active_only(probes).select(*keys, "workspace_name", "dataset_name", "is_critical")
    rows = transform.probe_rows(responses.join(small_side(names), keys))
    tables.append_probes(spark, table, rows)


def probe_summary(probes: DataFrame) -> DataFrame:
    """One row: how many probes succeeded and failed."""
    succeeded = F.col("status") == "Success"
    return probes.agg(
        F.count_if(succeeded).alias("succeeded"),
        (F.count(F.lit(1)) - F.count_if(succeeded)).alias("failed"),
    )
