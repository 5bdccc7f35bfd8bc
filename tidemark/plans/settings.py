"""Pipeline settings from a configuration document."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import pipelines
from tidemark.plans.alerts import AlertSettings
from tidemark.plans.pipelines import UsageSettings
from tidemark.session import read_text


@dataclass(frozen=True)
class PipelineSettings:
    """Table names and the settings of the pipelines."""

    refresh_table: str
    probe_table: str
    activity_table: str
    incremental: bool = True
    alerts_enabled: bool = False
    card_channel: bool = False
    alerts: AlertSettings = field(default_factory=AlertSettings)
    usage: UsageSettings = field(default_factory=UsageSettings)


def _table_name(section: dict) -> str:
    parts = [section.get("catalog"), section.get("schema"), section["table_name"]]
    return ".".join(part for part in parts if part)


def from_document(document: dict) -> PipelineSettings:
    """Settings of a parsed document; absent entries keep their defaults."""
    alerting, usage = document.get("alerting", {}), document.get("usage", {})
    base, base_usage = AlertSettings(), UsageSettings()
    return PipelineSettings(
        refresh_table=_table_name(document["delta_table"]),
        probe_table=_table_name(document["query_performance_table"]),
        activity_table=_table_name(document["activity_events_table"]),
        incremental=document.get("extraction", {}).get("incremental", True),
        alerts_enabled=alerting.get("enabled", False),
        card_channel=bool(alerting.get("teams_webhook_url")),
        alerts=AlertSettings(
            check_failures=alerting.get("check_failures", base.check_failures),
            check_duration_anomalies=alerting.get("check_duration_anomalies", base.check_duration_anomalies),
            check_stale_data=alerting.get("check_stale_data", base.check_stale_data),
            threshold_multiplier=alerting.get("duration_anomaly_threshold_multiplier", base.threshold_multiplier),
            rolling_window_days=alerting.get("duration_anomaly_rolling_window_days", base.rolling_window_days),
            staleness_threshold_hours=alerting.get("staleness_threshold_hours", base.staleness_threshold_hours),
        ),
        usage=UsageSettings(
            lookback_days=usage.get("lookback_days", base_usage.lookback_days),
            max_days_per_run=usage.get("max_backfill_days_per_run", base_usage.max_days_per_run),
            tracked_activities=tuple(usage.get("tracked_activities") or ()),
            incremental=usage.get("incremental", True),
        ),
    )


def load(spark: SparkSession, path: str) -> PipelineSettings:
    """Settings of a JSON file on any file system Spark reads."""
    return from_document(json.loads(read_text(spark, path)))


def run_refresh(
    spark: SparkSession, settings: PipelineSettings, landed: str, datasets: DataFrame, run_at: datetime, alerts_path: str, **options
) -> DataFrame:
    """``pipelines.run_refresh`` with the table, checks and channels of the settings."""
    return pipelines.run_refresh(
        spark,
        landed,
        datasets,
        settings.refresh_table,
        run_at,
        settings.incremental,
        alerts_path if settings.alerts_enabled else None,
        settings.alerts,
        card_channel=settings.card_channel,
        **options,
    )


def run_usage(
    spark: SparkSession, settings: PipelineSettings, landed: str, fetch_log: DataFrame, run_at: datetime, today: date, **options
) -> DataFrame:
    """``pipelines.run_usage`` with the table and window of the settings."""
    return pipelines.run_usage(spark, landed, fetch_log, settings.activity_table, run_at, today, settings.usage, **options)
