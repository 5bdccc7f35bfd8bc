from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import column, values
from tidemark.functions import headers, instants, payloads


def test_parse_instant_forms(spark):
    cases = {
        "2024-06-01T08:00:00.000Z": datetime(2024, 6, 1, 8),
        "2024-06-01T08:00:00.123456Z": datetime(2024, 6, 1, 8, 0, 0, 123456),
        "2024-06-01T08:00:00+02:00": datetime(2024, 6, 1, 6),
        "20240601T080000Z": datetime(2024, 6, 1, 8),
        "20240601T080000.250Z": datetime(2024, 6, 1, 8, 0, 0, 250000),
        "20240601": datetime(2024, 6, 1),
        "2024-06-01": datetime(2024, 6, 1),
        "2024": datetime(2024, 1, 1),
        "2024-13-01": None,
        "not-a-date": None,
        "10:30": None,
        "now": None,
        "": None,
        None: None,
    }
    text = F.date_format(instants.parse_instant(F.col("v")), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    expected = [None if v is None else v.strftime("%Y-%m-%d %H:%M:%S.%f") for v in cases.values()]
    assert values(column(spark, list(cases)), text) == expected


@pytest.mark.parametrize(
    ("start", "end", "expected"),
    [
        ("2024-06-01T09:00:00.000Z", "2024-06-01T09:05:30.000Z", 330.0),
        ("2024-06-01T09:00:00.000Z", "2024-06-01T09:00:00.500Z", 0.5),
        ("2024-06-01T09:00:01Z", "2024-06-01T09:00:00Z", -1.0),
        (None, "2024-06-01T09:05:30Z", None),
        ("2024-06-01T09:00:00Z", None, None),
        ("", "2024-06-01T09:05:30Z", None),
        ("2024-06-01T09:00:00Z", "", None),
        ("soon", "2024-06-01T09:05:30Z", None),
    ],
)
def test_duration(spark, start, end, expected):
    frame = spark.createDataFrame([(start, end)], "s string, e string")
    assert frame.select(instants.duration_seconds(F.col("s"), F.col("e"))).first()[0] == expected


def test_error_code(spark):
    cases = {
        '{"errorCode":"CredentialsMissing"}': "CredentialsMissing",
        '{"message":"something"}': None,
        None: None,
        "": None,
        "not-json{": "PARSE_ERROR",
        "{'errorCode':'single'}": "PARSE_ERROR",
        '{"errorCode":"cut"': "PARSE_ERROR",
        "   ": "PARSE_ERROR",
        '{"errorCode":"a","errorCode":"b"}': "b",
        '{"errorCode":7}': "7",
        '{"errorCode":null}': None,
        "[]": None,
        "null": None,
    }
    frame = column(spark, list(cases))
    assert values(frame, payloads.error_code(F.col("v"))) == list(cases.values())
    assert values(payloads.with_error_code(frame, "v"), "error_code") == list(cases.values())


def test_attempts(spark):
    frame = column(spark, ['[{"attemptId":1},{"attemptId":2}]', "[]", "null", None, '{"a":1}'])
    assert values(frame, payloads.attempt_count(F.col("v"))) == [2, 0, 0, 0, 0]
    assert values(frame, payloads.attempts_json(F.col("v"))) == ['[{"attemptId":1},{"attemptId":2}]', None, None, None, None]


def test_payload_row_count(spark):
    three = '{"results":[{"tables":[{"rows":[{"a":1},{"a":2},{"a":3}]}]}]}'
    texts = [three, '{"results":[{"tables":[{"rows":[]}]}]}', "{}", '{"results":[]}', '{"results":[{}]}', "bad", None]
    assert values(column(spark, texts), payloads.payload_row_count(F.col("v"))) == [3, 0, 0, 0, 0, 0, 0]


def test_first_of_spellings(spark):
    frame = column(spark, ['{"WorkspaceName":"a"}', '{"WorkSpaceName":"b"}', '{"WorkspaceName":null,"WorkSpaceName":"c"}', "{}"])
    name = payloads.first_of(payloads.event_fields(F.col("v")), "WorkspaceName", "WorkSpaceName")
    assert values(frame, name) == ["a", "b", "c", None]


def test_quota_headers_and_retry_after(spark):
    sent = {
        "Content-Type": "x",
        "Retry-After": "60",
        "RateLimit-Remaining": "0",
        "x-ms-throttle-scope": "tenant",
        "X-RateLimit-Limit": "200",
    }
    frame = column(spark, [sent, {"retry-after": "120"}, {"Retry-After": "Wed, 31 Jan 2024 00:00:00 GMT"}, {}], "map<string,string>")
    kept = values(frame, headers.quota_headers(F.col("v")))
    assert kept[0] == {k: v for k, v in sent.items() if k != "Content-Type"}
    assert values(frame, headers.retry_after_seconds(F.col("v"))) == [60, 120, None, None]


def test_retryable(spark):
    frame = spark.createDataFrame([(429, "GET"), (503, "GET"), (429, "POST"), (404, "GET"), (None, "GET")], "s int, m string")
    found = [r[0] for r in frame.select(headers.retryable(F.col("s"), F.col("m"))).collect()]
    assert found == [True, True, False, False, False]


def test_day_expressions(spark):
    frame = column(spark, [date(2024, 6, 1)], "date")
    first, last = instants.day_bounds(F.col("v"))
    assert values(frame, first) == ["2024-06-01T00:00:00"]
    assert values(frame, last) == ["2024-06-01T23:59:59"]
    assert values(frame, instants.month_bucket(F.col("v"))) == ["activity_events_2024_06"]


def test_instant_text(spark):
    frame = column(spark, ["2024-06-01T08:00:00Z", "2024-06-01T08:00:00.12Z"])
    text = instants.instant_text(instants.parse_instant(F.col("v")))
    assert values(frame, text) == ["2024-06-01 08:00:00", "2024-06-01 08:00:00.120000"]
