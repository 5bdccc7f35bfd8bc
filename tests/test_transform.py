import json
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import schemas
from tidemark.functions.instants import parse_instant
from tidemark.operators import incremental, transform
from tidemark.sources.tables import split_on_required, typed_rows

RUN_AT = datetime(2024, 6, 2, 3, 4, 5)
RAW = schemas.RAW_REFRESH + ", dataset_id string, dataset_name string, workspace_id string, workspace_name string, is_critical boolean"
NAMES = {"dataset_id": "ds", "dataset_name": "Sales", "workspace_id": "ws", "workspace_name": "Finance", "is_critical": True}


def raw(spark, *records):
    return spark.createDataFrame([{**NAMES, **r} for r in records], RAW)


def one(frame):
    found = frame.collect()
    assert len(found) == 1
    return found[0]


def test_completed_refresh(spark):
    row = one(
        transform.refresh_rows(
            raw(
                spark,
                {
                    "requestId": "r1",
                    "refreshType": "Scheduled",
                    "startTime": "2024-06-01T08:00:00.000Z",
                    "endTime": "2024-06-01T08:05:00.000Z",
                    "status": "Completed",
                    "refreshAttempts": '[{"attemptId":1}]',
                },
            ),
            RUN_AT,
        )
    )
    assert row.duration_seconds == 300.0
    assert row.attempt_count == 1 and json.loads(row.refresh_attempts_json) == [{"attemptId": 1}]
    assert row.is_critical and row.dataset_name == "Sales" and row.workspace_name == "Finance"
    assert row.error_code is None
    assert row.ingestion_timestamp == RUN_AT and row.ingestion_date == date(2024, 6, 2)


def test_running_and_failed_refresh(spark):
    frame = transform.refresh_rows(
        raw(
            spark,
            {"requestId": "run", "startTime": "2024-06-01T08:00:00Z", "status": "Unknown"},
            {
                "requestId": "bad",
                "startTime": "2024-06-01T08:00:00Z",
                "endTime": "2024-06-01T08:02:00Z",
                "status": "Failed",
                "serviceExceptionJson": '{"errorCode":"Boom"}',
            },
        ),
        RUN_AT,
    )
    assert rows(frame, "request_id", "end_time", "duration_seconds", "error_code", "attempt_count") == [
        ("bad", datetime(2024, 6, 1, 8, 2), 120.0, "Boom", 0),
        ("run", None, None, None, 0),
    ]
    assert frame.columns == schemas.REFRESH_HISTORY.fieldNames()


def test_missing_request_id(spark):
    frame = raw(spark, {"requestId": None}, {"requestId": ""}, {"requestId": "ok"})
    assert rows(transform.refresh_rows(frame, RUN_AT), "request_id") == [("ok",)]
    assert transform.missing_id(frame, "requestId").count() == 2


def watermark_case(spark, starts, mark, **options):
    frame = raw(spark, *[{"requestId": str(i), "startTime": s} for i, s in enumerate(starts)])
    marks = spark.createDataFrame([("ds", mark)] if mark else [], "dataset_id string, watermark timestamp")
    kept = incremental.newer_than_watermark(frame, marks, parse_instant(F.col("startTime")), **options)
    return [int(r[0]) for r in rows(kept, "requestId")]


def test_watermark_filter(spark):
    mark = datetime(2024, 6, 1, 8)
    starts = ["2024-06-01T07:59:59Z", "2024-06-01T08:00:00Z", "2024-06-01T08:00:00.000001Z", None, "", "soon"]
    assert watermark_case(spark, starts, mark) == [2, 3, 4, 5]
    assert watermark_case(spark, starts, None) == [0, 1, 2, 3, 4, 5]
    assert watermark_case(spark, starts, mark, lookback=timedelta(seconds=1)) == [1, 2, 3, 4, 5]


EVENT = {
    "Id": "e1",
    "CreationTime": "2024-06-01T10:00:00Z",
    "Activity": "ViewReport",
    "UserId": "a@example.com",
    "WorkSpaceName": "Finance",
    "ReportName": "Sales",
}


def events(spark, *found):
    return spark.createDataFrame([(json.dumps(e),) for e in found], "raw string")


def test_activity_rows(spark):
    row = one(transform.activity_rows(events(spark, EVENT), RUN_AT))
    assert (row.event_id, row.workspace_name, row.report_name) == ("e1", "Finance", "Sales")
    assert row.creation_date == date(2024, 6, 1) and row.ingestion_date == date(2024, 6, 2)
    assert row.capacity_id is None
    assert list(row.asDict()) == schemas.ACTIVITY_EVENTS.fieldNames()


def test_tracked_activities(spark):
    other = {**EVENT, "Id": "e2", "Activity": "EditReport"}
    silent = {"Id": "e3"}
    frame = events(spark, EVENT, other, silent)
    for tracked in (["ViewReport"], ["viewreport"]):
        assert rows(transform.activity_rows(frame, RUN_AT, tracked), "event_id") == [("e1",)]
    for tracked in (None, []):
        assert transform.activity_rows(frame, RUN_AT, tracked).count() == 3


def test_bad_events(spark):
    frame = events(spark, {"Activity": "ViewReport"}, {"Id": ""}, {"Id": "e4", "CreationTime": "not-a-date"})
    frame = frame.union(spark.createDataFrame([("broken{",)], "raw string"))
    row = one(transform.activity_rows(frame, RUN_AT))
    assert (row.event_id, row.creation_time, row.creation_date) == ("e4", None, None)


def test_typed_rows_and_required_columns(spark):
    frame = spark.createDataFrame(
        [("r1", "ds", "ws", "12", "2024-06-01T08:00:00Z", "2024-06-01"), ("r2", "ds", "ws", "many", "soon", None)],
        "request_id string, dataset_id string, workspace_id string, attempt_count string, ingestion_timestamp string, ingestion_date string",
    )
    typed = typed_rows(frame, schemas.REFRESH_HISTORY)
    assert typed.columns == schemas.REFRESH_HISTORY.fieldNames()
    assert rows(typed, "request_id", "attempt_count", "ingestion_date") == [("r1", 12, date(2024, 6, 1)), ("r2", None, None)]
    good, bad = split_on_required(typed, schemas.REFRESH_HISTORY)
    assert rows(good, "request_id") == [("r1",)] and rows(bad, "request_id") == [("r2",)]


PROBE = (
    "workspace_id string, workspace_name string, dataset_id string, dataset_name string, query_label string, "
    "http_status int, error string, payload string, is_critical boolean, sent_at timestamp, received_at timestamp"
)


def test_probe_rows(spark):
    sent, got = datetime(2024, 6, 1, 8), datetime(2024, 6, 1, 8, 0, 0, 123400)
    five = '{"results":[{"tables":[{"rows":[1,2,3,4,5]}]}]}'
    base = {"workspace_id": "w", "dataset_id": "d", "sent_at": sent, "received_at": got}
    frame = spark.createDataFrame(
        [
            {**base, "query_label": "ok", "http_status": 200, "payload": five, "is_critical": True},
            {**base, "query_label": "denied", "http_status": 403},
            {**base, "query_label": "broken", "error": "x" * 600},
        ],
        PROBE,
    )
    found = {r.query_label: r for r in transform.probe_rows(frame).collect()}
    ok, denied, broken = found["ok"], found["denied"], found["broken"]
    assert (ok.status, ok.duration_ms, ok.row_count, ok.error_message) == ("Success", 123.4, 5, None)
    assert (denied.status, denied.duration_ms, denied.row_count, denied.error_message) == ("Failed", None, None, "HTTP 403")
    assert broken.error_message == "x" * 600 and broken.is_critical is False and broken.workspace_name is None
    assert ok.probe_date == date(2024, 6, 1) and len({r.probe_id for r in found.values()}) == 3
