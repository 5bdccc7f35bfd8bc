from datetime import date, datetime, timedelta
from statistics import median_high

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import incremental as inc


def fetch(spark, lookback, today, last=None, **bounds):
    loaded = spark.createDataFrame([(last,)], "max_date date")
    return [r[0] for r in rows(inc.dates_to_fetch(loaded, lookback, today, **bounds))]


def days(first, n):
    return [first + timedelta(days=i) for i in range(n)]


@pytest.mark.parametrize(
    ("lookback", "today", "last", "first", "n"),
    [
        (3, date(2024, 6, 10), None, date(2024, 6, 7), 3),
        (100, date(2024, 6, 30), None, date(2024, 6, 2), 28),
        (0, date(2024, 6, 10), None, date(2024, 6, 9), 1),
        (28, date(2024, 6, 10), date(2024, 6, 7), date(2024, 6, 7), 3),
        (3, date(2024, 6, 10), date(2024, 1, 1), date(2024, 6, 7), 3),
        (28, date(2024, 6, 10), date(2024, 6, 9), date(2024, 6, 9), 1),
        (28, date(2024, 6, 10), date(2024, 6, 10), date(2024, 6, 10), 0),
    ],
)
def test_dates_to_fetch(spark, lookback, today, last, first, n):
    assert fetch(spark, lookback, today, last, retention_days=28) == days(first, n)


def test_landed_days_have_no_retention(spark):
    assert fetch(spark, 100, date(2024, 6, 30)) == days(date(2024, 3, 22), 100)
    loaded = spark.createDataFrame([(None,)], "max_date date")
    skipped = inc.days_past_retention(loaded, 100, date(2024, 6, 30), 28)
    assert [r[0] for r in rows(skipped)] == days(date(2024, 3, 22), 72)


def test_listed_and_joined_days_keep_the_same_rows(spark, monkeypatch):
    data = spark.createDataFrame([(1, date(2024, 6, 1)), (2, None), (3, date(2024, 6, 3)), (4, date(2024, 6, 9))], "i int, day date")
    wanted = spark.createDataFrame([(date(2024, 6, 1),), (None,), (date(2024, 6, 3),), (None,)], "day date")
    listed = rows(inc.only_days(data, wanted), "i")
    monkeypatch.setattr(inc, "MAX_LISTED_DAYS", 1)
    assert inc.listed_days(wanted) is None
    assert listed == rows(inc.only_days(data, wanted), "i") == [(1,), (2,), (3,)]


@pytest.mark.parametrize(("cap", "n"), [(3, 3), (None, 10), (0, 10), (-5, 10), (50, 10)])
def test_limit_backfill(spark, cap, n):
    window = days(date(2024, 6, 1), 10)
    frame = spark.createDataFrame([(d,) for d in reversed(window)], "day date")
    assert [r[0] for r in rows(inc.limit_backfill(frame, cap))] == window[:n]
    assert inc.limit_backfill(frame.limit(0), cap).count() == 0


def test_chunks_cover_the_backfill(spark):
    today, loaded, seen = date(2024, 6, 30), None, set()
    for _ in range(6):
        frame = inc.dates_to_fetch(spark.createDataFrame([(loaded,)], "max_date date"), 28, today)
        chunk = [r[0] for r in rows(inc.limit_backfill(frame, 7))]
        seen.update(chunk)
        loaded = max(chunk)
    assert sorted(seen) == days(date(2024, 6, 2), 28)


def test_completed_day_passes_empty_days(spark):
    log = [(date(2024, 6, d), "ok") for d in range(1, 6)] + [(date(2024, 6, 6), "throttled"), (date(2024, 6, 7), "ok")]
    frame = spark.createDataFrame(log, "day date, outcome string")
    assert rows(inc.max_completed_day(frame)) == [(date(2024, 6, 5),)]
    assert rows(inc.max_completed_day(frame.filter("outcome = 'ok'"))) == [(date(2024, 6, 7),)]
    assert rows(inc.max_completed_day(frame.limit(0))) == [(None,)]


def test_export_range(spark):
    today = date(2024, 6, 30)
    assert len(rows(inc.export_range(spark, today, lookback_days=40))) == 40
    explicit = rows(inc.export_range(spark, today, start=date(2024, 6, 1), end=date(2024, 6, 3)))
    assert explicit == [(date(2024, 6, 1), True), (date(2024, 6, 2), False), (date(2024, 6, 3), False)]
    assert rows(inc.export_range(spark, today, start=today, end=date(2024, 6, 1))) == []


def test_only_days_prunes_or_joins(spark, monkeypatch):
    frame = spark.createDataFrame([(d, i) for i, d in enumerate(days(date(2024, 6, 1), 5))], "day date, n int")
    wanted = frame.filter("n in (1, 3)").select("day")
    assert rows(inc.only_days(frame, wanted), "n") == [(1,), (3,)]
    assert inc.only_days(frame, wanted.limit(0)).count() == 0
    monkeypatch.setattr(inc, "MAX_LISTED_DAYS", 1)
    assert rows(inc.only_days(frame, wanted), "n") == [(1,), (3,)]


def starts(spark, groups):
    base = datetime(2024, 1, 1)
    data = [(key, None if m is None else base + timedelta(minutes=m)) for key, ms in groups.items() for m in ms]
    return spark.createDataFrame(data, "dataset_id string, start_time timestamp")


def test_watermarks(spark):
    frame = starts(spark, {"a": [5, 9, None], "b": [1], "c": [None]})
    assert rows(inc.watermarks(frame)) == [("a", datetime(2024, 1, 1, 0, 9)), ("b", datetime(2024, 1, 1, 0, 1))]


@pytest.mark.parametrize("chunk", [1, 60, 100_000])
def test_midpoint_is_the_upper_median(spark, chunk):
    groups = {"a": [7, 1, 3, 3, 200, 90], "b": [4], "c": [2, 1], "d": [None], "e": [5] * 9, "f": list(range(101))}
    found = dict(rows(inc.midpoint_watermarks(starts(spark, groups), chunk)))
    known = {k: [m for m in ms if m is not None] for k, ms in groups.items()}
    expected = {k: datetime(2024, 1, 1) + timedelta(minutes=median_high(ms)) for k, ms in known.items() if ms}
    assert found == expected


def test_max_activity_date(spark):
    frame = spark.createDataFrame([(date(2024, 6, 1),), (date(2024, 6, 4),), (None,)], "creation_date date")
    assert rows(inc.max_activity_date(frame)) == [(date(2024, 6, 4),)]
    assert rows(inc.max_activity_date(frame.limit(0))) == [(None,)]


def test_bounds(spark):
    frame = inc.with_bounds(spark.createDataFrame([(date(2024, 6, 1),)], "day date"))
    assert frame.filter(F.col("start_bound") == "2024-06-01T00:00:00").count() == 1
