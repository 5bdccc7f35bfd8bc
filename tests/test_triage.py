import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import triage
from tidemark.sinks.files import write_json_report

LOG = (
    "endpoint string, kind string, seq long, day date, status int, headers map<string,string>, latency_ms double, "
    "body string, error string"
)
D = [date(2024, 6, d) for d in range(1, 8)]


def log(spark, *entries):
    return spark.createDataFrame([{"endpoint": "e", "kind": "activity", **e} for e in entries], LOG)


@pytest.mark.parametrize(
    ("kind", "status", "error", "expected"),
    [
        ("dataset", 200, None, "ok"),
        ("dataset", 404, None, "skip_empty"),
        ("workspace", 403, None, "skip_empty"),
        ("dataset", 401, None, "failed"),
        ("dataset", 429, None, "failed"),
        ("workspace", 500, None, "failed"),
        ("activity", 401, None, "denied_empty"),
        ("activity", 403, None, "denied_empty"),
        ("activity", 429, None, "throttled"),
        ("activity", 404, None, "failed"),
        ("activity", None, "timed out", "failed"),
    ],
)
def test_outcomes(spark, kind, status, error, expected):
    frame = log(spark, {"kind": kind, "status": status, "error": error})
    assert rows(triage.with_outcome(frame), "outcome") == [(expected,)]


def test_cutoff_keeps_no_day_from_the_first_throttled_one(spark):
    frame = log(spark, *[{"day": d, "seq": i, "status": s} for i, (d, s) in enumerate(zip(D, [200, 403, 200, 429, 200, 429, 200]))])
    assert [r[0] for r in rows(triage.before_throttling(frame), "day")] == D[:3]
    assert [r[0] for r in rows(triage.before_throttling(frame, stop_on_denied=True), "day")] == D[:1]
    assert triage.before_throttling(frame.filter("status <> 429")).count() == 5


def test_loadable_days_end_at_the_first_open_day(spark):
    window = spark.createDataFrame([(d,) for d in D], "day date")
    none = spark.createDataFrame([], "day date")

    def loadable(statuses, cut_off=none, **options):
        frame = log(spark, *[{"day": d, "status": s} for d, s in zip(D, statuses) if s])
        return len(rows(triage.loadable_days(window, frame, cut_off, **options)))

    assert loadable([200] * 7) == 7
    assert loadable([200, 403, 200, 429, 200, 200, 200]) == 3
    assert loadable([200, 403, 200, 429, 200, 200, 200], stop_on_denied=True) == 1
    assert loadable([200, 200, 500, 200, 200, 200, 200]) == 2
    assert loadable([200, 200, 200, 200, None, 200, 200]) == 4
    assert loadable([200] * 7, spark.createDataFrame([(D[5],)], "day date")) == 5


def burst(*statuses, endpoint="e", **more):
    return [
        {"endpoint": endpoint, "seq": i + 1, "status": s, "latency_ms": 10.0 + i, "headers": {"X-RateLimit-Limit": "9"}, **more}
        for i, s in enumerate(statuses)
    ]


def stats_of(spark, entries, **options):
    return {r.endpoint: r for r in triage.endpoint_stats(log(spark, *entries), **options).collect()}


def test_stats_of_a_throttled_burst(spark):
    entries = burst(200, 200, 429, 200)
    entries[2]["headers"] = {"Retry-After": "60", "Content-Type": "x"}
    found = stats_of(spark, entries)["e"]
    assert (found.requests_made, found.throttled, found.first_429_at_request) == (3, True, 3)
    assert (found.retry_after_seconds, found.rate_limit_headers) == ("60", {"Retry-After": "60"})
    assert (found.min_latency_ms, found.max_latency_ms, found.avg_latency_ms) == (10.0, 12.0, 11.0)
    assert found.status_counts == {"200": 2, "429": 1} and found.error is None


def test_stats_of_other_ends(spark):
    entries = burst(200, 200, endpoint="quiet")
    entries += burst(200, 403, 200, endpoint="denied")
    entries += burst(500, endpoint="broken", body="x" * 300)
    entries += burst(200, None, 200, endpoint="cut")
    entries[-2]["error"] = "timed out"
    found = stats_of(spark, entries)
    assert found["quiet"].requests_made == 2 and found["quiet"].error is None
    assert found["quiet"].rate_limit_headers == {"X-RateLimit-Limit": "9"}
    assert found["denied"].error.startswith("HTTP 403 - authenticated but not authorized")
    assert found["broken"].error == "HTTP 500: " + "x" * 300
    assert stats_of(spark, entries, body_chars=200)["broken"].error == "HTTP 500: " + "x" * 200
    assert found["cut"].error == "request #2 raised: timed out"
    assert (found["cut"].requests_made, found["cut"].max_latency_ms, found["cut"].status_counts) == (1, 10.0, {"200": 1})


def test_every_landed_response_counts(spark):
    found = stats_of(spark, burst(*[200] * 59, 429, *[200] * 19))["e"]
    assert (found.requests_made, found.throttled, found.first_429_at_request) == (60, True, 60)
    assert stats_of(spark, burst(*[200] * 60), max_requests=30)["e"].requests_made == 30


def test_stats_without_headers_or_status(spark):
    entries = burst(None, endpoint="gone")
    entries[0].update(error="no route", headers=None)
    found = stats_of(spark, entries)["gone"]
    assert (found.requests_made, found.rate_limit_headers, found.status_counts) == (0, {}, {})


def test_prefix_equals_running_definition(spark):
    frame = log(spark, *burst(200, 429, 429, endpoint="a"), *burst(200, 200, endpoint="b"), *burst(404, 200, endpoint="c"))
    found = rows(triage.until_first_stop(frame), "endpoint", "seq")
    assert found == [("a", 1), ("a", 2), ("b", 1), ("b", 2), ("c", 1)]


def test_run_stats(spark):
    registry = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "dataset_id string")
    new = spark.createDataFrame([("a",), ("a",), ("d",)], "dataset_id string")
    failed = spark.createDataFrame([("d",), ("d",)], "dataset_id string")
    assert rows(triage.run_stats(registry, new, failed)) == [(1, 2, 1)]


def test_day_counts(spark):
    def event(day, event_id, activity="ViewReport"):
        return (D[day], json.dumps({"Id": event_id, "Activity": activity}))

    raw = spark.createDataFrame(
        [event(0, "a"), event(0, "a"), event(0, "b"), event(0, ""), event(1, "a"), event(1, "c", "Edit"), event(2, "c")],
        "fetch_day date, raw string",
    )
    known = spark.createDataFrame([("b",), ("b",)], "event_id string")
    assert rows(triage.day_counts(raw, known, ["viewreport"])) == [(D[0], 4, 3, 1), (D[1], 2, 1, 0), (D[2], 1, 1, 1)]
    assert rows(triage.day_counts(raw, known)) == [(D[0], 4, 3, 1), (D[1], 2, 2, 1), (D[2], 1, 1, 0)]


def test_json_report(spark, tmp_path):
    path = str(tmp_path / "report")
    stats = triage.endpoint_stats(log(spark, *burst(200, 429)))
    write_json_report(stats, path, datetime(2024, 6, 1), {"max_requests": "50"})
    found = spark.read.json(path).select("endpoint", "settings.max_requests", F.col("status_counts.`429`")).first()
    assert tuple(found) == ("e", "50", 1)
