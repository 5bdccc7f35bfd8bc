"""Landed records to table rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import schemas
from tidemark.functions import instants, payloads

# Field names of a landed event and the columns they fill.
EVENT_FIELDS = {
    "activity": ["Activity"],
    "user_id": ["UserId"],
    "user_key": ["UserKey"],
    "workspace_id": ["WorkspaceId", "WorkSpaceId"],
    "workspace_name": ["WorkspaceName", "WorkSpaceName"],
    "report_id": ["ReportId"],
    "report_name": ["ReportName"],
    "report_type": ["ReportType"],
    "dataset_id": ["DatasetId"],
    "dataset_name": ["DatasetName"],
    "capacity_id": ["CapacityId"],
    "consumption_method": ["ConsumptionMethod"],
    "distribution_method": ["DistributionMethod"],
    "item_name": ["ItemName"],
    "object_id": ["ObjectId"],
    "result_status": ["ResultStatus"],
}


def with_ingestion_stamp(rows: DataFrame, run_at: datetime) -> DataFrame:
    """One UTC timestamp and day for the whole batch."""
    stamp = F.lit(run_at).cast("timestamp")
    return rows.withColumn("ingestion_timestamp", stamp).withColumn("ingestion_date", F.to_date(stamp))


def require_id(rows: DataFrame, id_column: str) -> DataFrame:
    """Drop rows whose id is missing or empty."""
    return rows.filter(F.coalesce(F.col(id_column), F.lit("")) != "")


def missing_id(rows: DataFrame, id_column: str) -> DataFrame:
    """The rows ``require_id`` drops, for a quarantine table."""
    return rows.filter(F.coalesce(F.col(id_column), F.lit("")) == "")


def refresh_rows(records: DataFrame, run_at: datetime) -> DataFrame:
    """Landed refresh records, already joined with the registry, as table rows."""
    start, end = instants.parse_instant(F.col("startTime")), instants.parse_instant(F.col("endTime"))
    attempts = F.col("refreshAttempts")
    coded = payloads.with_error_code(require_id(records, "requestId"), "serviceExceptionJson")
    rows = coded.select(
        F.col("requestId").alias("request_id"),
        "dataset_id",
        "dataset_name",
        "workspace_id",
        "workspace_name",
        F.col("refreshType").alias("refresh_type"),
        "status",
        start.alias("start_time"),
        end.alias("end_time"),
        instants.seconds_between(start, end).alias("duration_seconds"),
        F.col("serviceExceptionJson").alias("service_exception_json"),
        "error_code",
        payloads.attempts_json(attempts).alias("refresh_attempts_json"),
        payloads.attempt_count(attempts).alias("attempt_count"),
        "is_critical",
    )
    return with_ingestion_stamp(rows, run_at).select(schemas.REFRESH_HISTORY.fieldNames())


def parsed_events(raw_events: DataFrame) -> DataFrame:
    """Raw event text parsed once into a case-sensitive field map; other columns are kept."""
    return raw_events.withColumn("fields", payloads.event_fields(F.col("raw"))).withColumn(
        "event_id", F.col("fields")["Id"]
    )


def tracked_activity(activity: Column, activities: list[str] | None) -> Column:
    """Whether an activity is listed, ignoring case; no list or an empty one accepts all."""
    if not activities:
        return F.lit(True)
    wanted = sorted({name.lower() for name in activities})
    return F.lower(F.coalesce(activity, F.lit(""))).isin(wanted)


def keep_tracked(rows: DataFrame, activities: list[str] | None, column: str = "activity") -> DataFrame:
    """Keep the rows of the listed activities."""
    return rows.filter(tracked_activity(F.col(column), activities))


def activity_rows(
    raw_events: DataFrame, run_at: datetime, tracked: list[str] | None = None, keep: tuple = ()
) -> DataFrame:
    """Raw event text (column ``raw``) as table rows; ``keep`` names extra columns to carry."""
    fields = F.col("fields")
    created = instants.parse_instant(fields["CreationTime"])
    rows = require_id(parsed_events(raw_events), "event_id").select(
        "event_id",
        created.alias("creation_time"),
        F.to_date(created).alias("creation_date"),
        *[payloads.first_of(fields, *names).alias(column) for column, names in EVENT_FIELDS.items()],
        *keep,
    )
    stamped = with_ingestion_stamp(keep_tracked(rows, tracked), run_at)
    return stamped.select(*schemas.ACTIVITY_EVENTS.fieldNames(), *keep)


def probe_rows(responses: DataFrame, error_chars: int | None = None) -> DataFrame:
    """Logged probe responses as table rows.

    A response with a transport error or a status of 400 and above is ``Failed`` and has no
    measures. The id is a hash of what identifies a run, so a replay gives the same row.
    ``error_chars`` cuts the text of an error, which is whole otherwise.
    """
    error = F.col("error") if error_chars is None else F.substring("error", 1, error_chars)
    failed = F.col("error").isNotNull() | F.coalesce(F.col("http_status") >= 400, F.lit(True))
    message = F.when(
        F.col("error").isNull() & F.col("http_status").isNotNull(),
        F.concat(F.lit("HTTP "), F.col("http_status").cast("string")),
    ).otherwise(error)
    identity = F.concat_ws(
        "|",
        "workspace_id",
        "dataset_id",
        F.coalesce("query_label", F.lit("")),
        F.unix_micros("sent_at").cast("string"),
    )
    return responses.select(
        F.sha2(identity, 256).alias("probe_id"),
        "workspace_id",
        "workspace_name",
        "dataset_id",
        "dataset_name",
        "query_label",
        F.when(failed, F.lit("Failed")).otherwise(F.lit("Success")).alias("status"),
        F.when(~failed, instants.round_trip_ms(F.col("sent_at"), F.col("received_at"))).alias("duration_ms"),
        F.when(~failed, payloads.payload_row_count(F.col("payload"))).alias("row_count"),
        F.when(failed, message).alias("error_message"),
        F.coalesce("is_critical", F.lit(False)).alias("is_critical"),
        F.col("sent_at").alias("probe_timestamp"),
        F.to_date("sent_at").alias("probe_date"),
    )
