"""Stored tables and landed payloads as explicit schemas."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "string": StringType(),
    "timestamp": TimestampType(),
    "date": DateType(),
    "double": DoubleType(),
    "int": IntegerType(),
    "boolean": BooleanType(),
}

# Column names, order, types and required columns of the stored tables.
_REFRESH = [
    ("request_id", "string", True, "identifier of the refresh attempt"),
    ("dataset_id", "string", True, "dataset that was refreshed"),
    ("dataset_name", "string", False, "dataset name from the registry"),
    ("workspace_id", "string", True, "workspace holding the dataset"),
    ("workspace_name", "string", False, "workspace name from the registry"),
    ("refresh_type", "string", False, "Scheduled, ViaApi, OnDemand or ViaEnhancedApi"),
    ("status", "string", False, "Completed, Failed, Unknown (running), Disabled or Cancelled"),
    ("start_time", "timestamp", False, "start, UTC"),
    ("end_time", "timestamp", False, "end, UTC; null while running"),
    ("duration_seconds", "double", False, "end minus start; null while running"),
    ("service_exception_json", "string", False, "error payload as received"),
    ("error_code", "string", False, "errorCode taken from the payload"),
    ("refresh_attempts_json", "string", False, "attempt list as received"),
    ("attempt_count", "int", False, "length of the attempt list"),
    ("is_critical", "boolean", False, "critical flag from the registry"),
    ("ingestion_timestamp", "timestamp", True, "time of the batch that wrote the row last"),
    ("ingestion_date", "date", True, "day of the batch that inserted the row"),
]
_PROBE = [
    ("probe_id", "string", True, "identifier of the measurement"),
    ("workspace_id", "string", True, "workspace holding the dataset"),
    ("workspace_name", "string", False, "workspace name"),
    ("dataset_id", "string", True, "dataset that was queried"),
    ("dataset_name", "string", False, "dataset name"),
    ("query_label", "string", False, "label of the probe query"),
    ("status", "string", False, "Success or Failed"),
    ("duration_ms", "double", False, "round trip in milliseconds"),
    ("row_count", "int", False, "rows the query returned"),
    ("error_message", "string", False, "error text of a failed probe"),
    ("is_critical", "boolean", False, "critical flag from the registry"),
    ("probe_timestamp", "timestamp", True, "time of the probe, UTC"),
    ("probe_date", "date", True, "day of the probe"),
]
_ACTIVITY = [
    ("event_id", "string", True, "identifier of the audit event"),
    ("creation_time", "timestamp", False, "time of the activity, UTC"),
    ("creation_date", "date", False, "day of the activity, UTC"),
    ("activity", "string", False, "activity type, such as ViewReport"),
    ("user_id", "string", False, "principal name of the user"),
    ("user_key", "string", False, "stable key of the user"),
    ("workspace_id", "string", False, "workspace, where one applies"),
    ("workspace_name", "string", False, "workspace name"),
    ("report_id", "string", False, "report, where one applies"),
    ("report_name", "string", False, "report name"),
    ("report_type", "string", False, "report type"),
    ("dataset_id", "string", False, "dataset, where one applies"),
    ("dataset_name", "string", False, "dataset name"),
    ("capacity_id", "string", False, "capacity hosting the item"),
    ("consumption_method", "string", False, "how the content was consumed"),
    ("distribution_method", "string", False, "how the content was distributed"),
    ("item_name", "string", False, "name of the item acted on"),
    ("object_id", "string", False, "identifier of the item acted on"),
    ("result_status", "string", False, "Succeeded or Failed"),
    ("ingestion_timestamp", "timestamp", True, "time of the batch that wrote the row"),
    ("ingestion_date", "date", True, "day of the batch that wrote the row"),
]


def _table(columns) -> StructType:
    return StructType(
        [StructField(name, _TYPES[kind], not required, {"comment": text}) for name, kind, required, text in columns]
    )


REFRESH_HISTORY = _table(_REFRESH)
QUERY_PERFORMANCE = _table(_PROBE)
ACTIVITY_EVENTS = _table(_ACTIVITY)

ALERTS = StructType(
    [
        StructField("severity", StringType()),
        StructField("alert_type", StringType()),
        StructField("dataset_name", StringType()),
        StructField("workspace_name", StringType()),
        StructField("message", StringType()),
        StructField("details", MapType(StringType(), StringType())),
        StructField("alert_time", TimestampType()),
    ]
)

CORRUPT = "_corrupt_record"

# Landed payloads. Unknown fields are ignored, absent ones are null.
RAW_REFRESH = (
    "requestId string, refreshType string, startTime string, endTime string, status string, "
    "serviceExceptionJson string, refreshAttempts string"
)
REFRESH_ENVELOPE = (
    f"workspace_id string, dataset_id string, value array<struct<{RAW_REFRESH}>>, {CORRUPT} string"
)
DATASET_LISTING = (
    "workspace_id string, value array<struct<id string, name string, isRefreshable boolean>>, "
    f"{CORRUPT} string"
)
WORKSPACE_LISTING = f"value array<struct<id string, name string>>, {CORRUPT} string"
ACTIVITY_PAGE = (
    "day date, page_no long, activityEventEntities array<string>, "
    f"continuationToken string, continuationUri string, {CORRUPT} string"
)
DATASET_CONFIG = (
    "datasets array<struct<workspace_id string, workspace_name string, dataset_id string, "
    "dataset_name string, is_critical boolean, is_active boolean>>, "
    "workspaces array<struct<workspace_id string, workspace_name string, "
    "is_critical_default boolean, is_active boolean, exclude_datasets array<string>>>"
)
PROBE_CONFIG = (
    "probes array<struct<workspace_id string, workspace_name string, dataset_id string, "
    "dataset_name string, query_label string, dax_query string, is_critical boolean, "
    "is_active boolean>>"
)
