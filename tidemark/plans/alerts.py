"""Alert checks over the refresh history. Each yields rows of the alert schema."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import schemas
from tidemark.functions.instants import instant_text
from tidemark.operators.rolling import MAX_ROWS_PER_TASK, mean_of_previous
from tidemark.plans.reports import started_since

# The rolling mean covers four rows per day of its window.
ROWS_PER_DAY = 4
CARD_COLORS = {"critical": "attention", "warning": "warning", "info": "good"}
UNKNOWN = "Unknown"


@dataclass(frozen=True)
class AlertSettings:
    """Which checks run, and their thresholds."""

    check_failures: bool = True
    check_duration_anomalies: bool = True
    check_stale_data: bool = True
    threshold_multiplier: float = 1.5
    rolling_window_days: int = 7
    staleness_threshold_hours: int = 26


def _text_or_unknown(name: str) -> Column:
    column = F.col(name)
    return F.when(F.coalesce(column, F.lit("")) == "", UNKNOWN).otherwise(column)


def _details(**entries: Column) -> Column:
    pairs = [item for key, value in entries.items() for item in (F.lit(key), value.cast("string"))]
    return F.create_map(*pairs)


def _whole(number: Column) -> Column:
    return F.bround(number, 0).cast("bigint").cast("string")


def _alerts(rows: DataFrame, severity: Column, alert_type: str, message: Column, details: Column, at: datetime):
    return rows.select(
        severity.alias("severity"),
        F.lit(alert_type).alias("alert_type"),
        _text_or_unknown("dataset_name").alias("dataset_name"),
        _text_or_unknown("workspace_name").alias("workspace_name"),
        message.alias("message"),
        details.alias("details"),
        F.lit(at).cast("timestamp").alias("alert_time"),
    )


def refresh_failures(
    refresh: DataFrame, as_of: date, at: datetime, recency: str = "ingestion_date"
) -> DataFrame:
    """Refreshes that failed in today's ingestion.

    ``recency="ingestion_timestamp"`` also finds a refresh first stored as running on an earlier
    day: a merge moves its timestamp but not its date.
    """
    today = F.col(recency) if recency == "ingestion_date" else F.to_date(recency)
    rows = refresh.filter((F.col("status") == "Failed") & (today == F.lit(as_of)))
    code = F.col("error_code")
    shown = F.when(F.coalesce(code, F.lit("")) == "", UNKNOWN).otherwise(code)
    return _alerts(
        rows,
        F.when(F.col("is_critical"), "critical").otherwise("warning"),
        "refresh_failure",
        F.concat(F.lit("Refresh failed with error: "), shown),
        _details(
            error_code=code,
            service_exception=F.col("service_exception_json"),
            start_time=F.coalesce(instant_text(F.col("start_time")), F.lit("None")),
        ),
        at,
    )


def duration_anomalies(
    refresh: DataFrame,
    as_of: date,
    at: datetime,
    threshold_multiplier: float = 1.5,
    rolling_window_days: int = 7,
    max_rows_per_task: int = MAX_ROWS_PER_TASK,
    ingested_after_start: bool = False,
) -> DataFrame:
    """Today's refreshes that took longer than a multiple of the rolling mean of their dataset.

    ``ingested_after_start`` prunes old partitions, see ``reports.started_since``.
    """
    measured = refresh.filter((F.col("status") == "Completed") & F.col("duration_seconds").isNotNull())
    recent = started_since(measured, as_of, rolling_window_days + 1, ingested_after_start).select(
        "request_id", "dataset_id", "dataset_name", "workspace_name", "start_time", "duration_seconds", "ingestion_date"
    )
    rolling = mean_of_previous(
        recent,
        "dataset_id",
        "start_time",
        "request_id",
        "duration_seconds",
        rolling_window_days * ROWS_PER_DAY,
        "rolling_mean",
        max_rows_per_task,
    )
    duration, mean = F.col("duration_seconds"), F.col("rolling_mean")
    flagged = rolling.filter(
        (F.col("ingestion_date") == F.lit(as_of)) & mean.isNotNull() & (duration > threshold_multiplier * mean)
    )
    ratio = F.coalesce(F.try_divide(duration, mean), F.lit(0.0))
    message = F.concat(
        F.lit("Refresh took "),
        _whole(duration),
        F.lit("s ("),
        F.bround(ratio, 1).cast("decimal(20,1)").cast("string"),
        F.lit(f"x the {rolling_window_days}-day rolling avg of "),
        _whole(mean),
        F.lit("s)."),
    )
    details = _details(duration_seconds=duration, rolling_avg_seconds=mean, ratio=F.round(ratio, 2))
    return _alerts(flagged, F.lit("warning"), "duration_anomaly", message, details, at)


def stale_data(
    refresh: DataFrame,
    at: datetime,
    staleness_threshold_hours: int = 26,
    registry: DataFrame | None = None,
) -> DataFrame:
    """Critical datasets whose last success is more than the threshold of whole hours ago.

    With a ``registry``, critical datasets that never succeeded are reported as well.
    """
    now = F.lit(at).cast("timestamp")
    last = F.col("last_success")
    hours = F.floor((F.unix_micros(now) - F.unix_micros(last)) / F.lit(3_600_000_000))
    late = (
        refresh.filter((F.col("status") == "Completed") & F.col("is_critical"))
        .groupBy("dataset_id", "dataset_name", "workspace_name")
        .agg(F.max("end_time").alias("last_success"))
    )
    overdue = late.withColumn("hours", hours).filter(F.col("hours") > staleness_threshold_hours)
    message = F.concat(
        F.lit("No successful refresh in "),
        F.col("hours").cast("string"),
        F.lit(f" hours (SLA threshold: {staleness_threshold_hours}h). Last success: "),
        instant_text(last),
        F.lit("."),
    )
    details = _details(hours_since_refresh=F.col("hours"), last_successful_refresh=instant_text(last))
    alerts = _alerts(overdue, F.lit("critical"), "stale_data", message, details, at)
    if registry is None:
        return alerts
    never = registry.filter(F.col("is_critical")).join(late.select("dataset_id"), "dataset_id", "left_anti")
    nothing = _details(hours_since_refresh=F.lit(None), last_successful_refresh=F.lit(None))
    message = F.lit(f"No successful refresh on record (SLA threshold: {staleness_threshold_hours}h).")
    return alerts.unionByName(_alerts(never, F.lit("critical"), "stale_data", message, nothing, at))


def all_alerts(
    refresh: DataFrame,
    as_of: date,
    at: datetime,
    settings: AlertSettings | None = None,
    ingested_after_start: bool = False,
) -> DataFrame:
    """The selected checks as one frame."""
    chosen = settings or AlertSettings()
    alerts = refresh.sparkSession.createDataFrame([], schemas.ALERTS)
    if chosen.check_failures:
        alerts = alerts.unionByName(refresh_failures(refresh, as_of, at))
    if chosen.check_duration_anomalies:
        alerts = alerts.unionByName(
            duration_anomalies(
                refresh,
                as_of,
                at,
                chosen.threshold_multiplier,
                chosen.rolling_window_days,
                ingested_after_start=ingested_after_start,
            )
        )
    if chosen.check_stale_data:
        alerts = alerts.unionByName(stale_data(refresh, at, chosen.staleness_threshold_hours))
    return alerts


def routed(alerts: DataFrame, card_channel: bool, critical_only: bool = False) -> DataFrame:
    """Attach the log level and whether a card is sent.

    Every alert goes to a configured card channel unless ``critical_only`` is set.
    """
    critical = F.col("severity") == "critical"
    sends = F.lit(card_channel) & (critical | F.lit(not critical_only))
    return alerts.withColumn("log_level", F.when(critical, "CRITICAL").otherwise("WARNING")).withColumn(
        "channel", F.when(sends, "log+card").otherwise("log")
    )


def log_line(severity: Column) -> Column:
    """The text logged for an alert."""
    return F.concat(
        F.lit("["),
        F.upper(severity),
        F.lit("] "),
        F.col("alert_type"),
        F.lit(" | "),
        F.col("workspace_name"),
        F.lit("/"),
        F.col("dataset_name"),
        F.lit(": "),
        F.col("message"),
    )


def card_json(heading: str = "Refresh Alert") -> Column:
    """The message card of an alert as JSON; ``heading`` opens its title."""
    color = F.element_at(F.create_map(*[F.lit(x) for item in CARD_COLORS.items() for x in item]), F.col("severity"))

    def fact(title: str, value: Column) -> Column:
        return F.struct(F.lit(title).alias("title"), value.alias("value"))

    def block(kind: str, **parts: Column) -> Column:
        # One struct type for all blocks; to_json leaves null parts out.
        kinds = {"size": "string", "weight": "string", "text": "string", "style": "string", "color": "string"}
        columns = [parts.get(name, F.lit(None)).cast(kind_).alias(name) for name, kind_ in kinds.items()]
        facts = parts.get("facts", F.lit(None)).cast("array<struct<title:string,value:string>>").alias("facts")
        wrap = parts.get("wrap", F.lit(None)).cast("boolean").alias("wrap")
        return F.struct(F.lit(kind).alias("type"), *columns, facts, wrap)

    title = F.concat(F.lit(f"{heading} — "), F.initcap(F.replace(F.col("alert_type"), F.lit("_"), F.lit(" "))))
    body = F.array(
        block(
            "TextBlock",
            size=F.lit("Large"),
            weight=F.lit("Bolder"),
            text=title,
            style=F.lit("heading"),
            color=F.coalesce(color, F.lit("default")),
        ),
        block(
            "FactSet",
            facts=F.array(
                fact("Severity", F.upper(F.col("severity"))),
                fact("Dataset", F.col("dataset_name")),
                fact("Workspace", F.col("workspace_name")),
                fact("Time (UTC)", F.date_format("alert_time", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")),
            ),
        ),
        block("TextBlock", text=F.col("message"), wrap=F.lit(True)),
    )
    # The envelope of a message card.
    card = F.struct(
        F.lit("http://adaptivecards.io/schemas/adaptive-card.json").alias("$schema"),
        F.lit("AdaptiveCard").alias("type"),
        F.lit("1.4").alias("version"),
        body.alias("body"),
    )
    return F.concat(
        F.lit(
            '{"type":"message","attachments":[{"contentType":'
            '"application/vnd.microsoft.card.adaptive","contentUrl":null,"content":'
        ),
        F.to_json(card),
        F.lit("}]}"),
    )


def with_cards(alerts: DataFrame, heading: str = "Refresh Alert") -> DataFrame:
    """Attach the card of each alert."""
    return alerts.withColumn("card", card_json(heading))
