import json
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_merge import refresh
from tidemark.plans import alerts

AS_OF = date(2024, 6, 10)
AT = datetime(2024, 6, 10, 12)


def timeline(spark, durations, last=AT, **more):
    entries = []
    for i, seconds in enumerate(durations):
        start = last - timedelta(hours=len(durations) - i)
        entries.append(
            {
                "request_id": f"r{i:03d}",
                "status": "Completed",
                "start_time": start,
                "end_time": start + timedelta(seconds=seconds),
                "duration_seconds": float(seconds),
                "dataset_name": "Sales",
                "workspace_name": "Finance",
                "ingestion_timestamp": start,
                **more,
            }
        )
    return refresh(spark, *entries)


def test_failures(spark):
    frame = refresh(
        spark,
        {"request_id": "a", "status": "Failed", "is_critical": True, "error_code": "Boom", "ingestion_timestamp": AT, "dataset_name": "Sales"},
        {"request_id": "b", "status": "Failed", "ingestion_timestamp": AT},
        {"request_id": "c", "status": "Failed", "ingestion_timestamp": AT - timedelta(days=1)},
        {"request_id": "d", "status": "Completed", "ingestion_timestamp": AT},
    )
    found = rows(alerts.refresh_failures(frame, AS_OF, AT), "severity", "dataset_name", "workspace_name", "message")
    assert found == [
        ("critical", "Sales", "Unknown", "Refresh failed with error: Boom"),
        ("warning", "Unknown", "Unknown", "Refresh failed with error: Unknown"),
    ]


def test_failure_of_a_refresh_first_seen_running(spark):
    entry = {"request_id": "a", "status": "Failed", "ingestion_timestamp": AT, "ingestion_date": AS_OF - timedelta(days=1)}
    frame = refresh(spark, entry)
    assert alerts.refresh_failures(frame, AS_OF, AT).count() == 0
    assert alerts.refresh_failures(frame, AS_OF, AT, recency="ingestion_timestamp").count() == 1


def test_duration_anomaly(spark):
    found = alerts.duration_anomalies(timeline(spark, [100, 100, 100, 151]), AS_OF, AT).collect()
    assert [r.message for r in found] == ["Refresh took 151s (1.5x the 7-day rolling avg of 100s)."]
    assert found[0].details["ratio"] == "1.51" and found[0].severity == "warning"
    assert alerts.duration_anomalies(timeline(spark, [100, 100, 100, 150]), AS_OF, AT).count() == 0
    assert alerts.duration_anomalies(timeline(spark, [100]), AS_OF, AT).count() == 0


def test_anomaly_messages_round_half_to_even(spark):
    message = alerts.duration_anomalies(timeline(spark, [0.5, 0.5, 2.5]), AS_OF, AT).first().message
    assert message == "Refresh took 2s (5.0x the 7-day rolling avg of 0s)."


def test_anomaly_window_is_28_rows(spark):
    old, recent = [10_000] * 5, [100] * 28
    assert alerts.duration_anomalies(timeline(spark, old + recent + [151]), AS_OF, AT).count() == 1
    assert alerts.duration_anomalies(timeline(spark, old + recent[1:] + [151]), AS_OF, AT).count() == 0


def test_anomaly_result_does_not_depend_on_the_split(spark):
    frame = timeline(spark, [(i * 7919) % 300 + 1 for i in range(150)])
    plain = rows(alerts.duration_anomalies(frame, AS_OF, AT).drop("details"))
    assert plain and rows(alerts.duration_anomalies(frame, AS_OF, AT, max_rows_per_task=20).drop("details")) == plain


def stale(spark, hours, **options):
    frame = timeline(spark, [0], last=AT - timedelta(hours=hours) + timedelta(hours=1), is_critical=True)
    return alerts.stale_data(frame, AT, **options).collect()


def test_stale(spark):
    assert stale(spark, 26.99) == []
    (found,) = stale(spark, 27)
    assert found.message == "No successful refresh in 27 hours (SLA threshold: 26h). Last success: 2024-06-09 09:00:00."
    assert found.severity == "critical" and found.details["hours_since_refresh"] == "27"


def test_stale_can_include_datasets_that_never_succeeded(spark):
    registry = spark.createDataFrame([("d", "Sales", "Finance", True), ("x", "Never", "Ops", True), ("y", "No", "Ops", False)], "dataset_id string, dataset_name string, workspace_name string, is_critical boolean")
    assert [r.dataset_name for r in stale(spark, 1, registry=registry)] == ["Never"]


def test_settings_select_checks(spark):
    frame = timeline(spark, [100, 100, 500], is_critical=True)
    only = {"check_failures": False, "check_duration_anomalies": False, "check_stale_data": False}

    def kinds(**on):
        return [r[0] for r in rows(alerts.all_alerts(frame, AS_OF, AT, alerts.AlertSettings(**{**only, **on})), "alert_type")]

    assert kinds() == []
    assert kinds(check_duration_anomalies=True) == ["duration_anomaly"]
    assert kinds(check_stale_data=True, staleness_threshold_hours=-1) == ["stale_data"]


def test_routes_and_card(spark):
    frame = refresh(
        spark,
        {"request_id": "a", "status": "Failed", "is_critical": True, "error_code": 'quote"d', "ingestion_timestamp": AT, "dataset_name": "Sales"},
        {"request_id": "b", "status": "Failed", "ingestion_timestamp": AT},
    )
    found = alerts.refresh_failures(frame, AS_OF, AT)
    assert rows(alerts.routed(found, True), "log_level", "channel") == [("CRITICAL", "log+card"), ("WARNING", "log+card")]
    assert rows(alerts.routed(found, False), "channel") == [("log",), ("log",)]
    assert rows(alerts.routed(found, True, critical_only=True), "channel") == [("log",), ("log+card",)]

    card = json.loads(alerts.with_cards(found, "Nightly Alert").filter(F.col("severity") == "critical").first().card)
    attachment = card["attachments"][0]
    assert card["type"] == "message" and attachment["contentUrl"] is None
    heading, facts, text = attachment["content"]["body"]
    assert heading == {
        "type": "TextBlock", "size": "Large", "weight": "Bolder", "text": "Nightly Alert — Refresh Failure",
        "style": "heading", "color": "attention",
    }
    assert {f["title"]: f["value"] for f in facts["facts"]} == {
        "Severity": "CRITICAL", "Dataset": "Sales", "Workspace": "Unknown", "Time (UTC)": "2024-06-10T12:00:00+00:00",
    }
    assert text == {"type": "TextBlock", "text": 'Refresh failed with error: quote"d', "wrap": True}
