"""Roll-ups give what the reports over all events give."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_text, rows
from tidemark.checks import adapters as a
from tidemark.plans import reports, rollups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    return a.activity_events(spark, SF)


def same(found, events, as_of=a.AS_OF, days=30):
    assert rows(rollups.daily_views(found)) == rows(reports.daily_views(events))
    assert rollups.most_viewed(found, as_of, days).collect() == reports.most_viewed(events, as_of, days).collect()
    assert rollups.top_users(found, as_of, days).collect() == reports.top_users(events, as_of, days).collect()


def test_late_events_of_some_days(spark, tmp_path, events):
    found = rollups.Rollups(spark, str(tmp_path))
    late = F.xxhash64("event_id") % 3 == 0
    found.roll_up(events.filter(~late))
    same(found, events.filter(~late))
    days = sorted(r[0] for r in events.select("creation_date").distinct().collect())[-4:]
    arrived = events.filter(~late | F.col("creation_date").isin(days))
    found.roll_up(events, days)
    same(found, arrived)
    same(found, arrived, as_of=days[1], days=3)
    found.roll_up(events, days)  # again
    same(found, arrived)
    numbers = [r[0] for r in rows(found.users(), "number")]
    assert sorted(numbers) == list(range(len(numbers)))


def test_a_run_that_died_after_giving_numbers(spark, tmp_path, events):
    found = rollups.Rollups(spark, str(tmp_path))
    rollups.dense_numbers(events.filter("user_id is not null"), "user_id").limit(5).write.parquet(f"{tmp_path}/users")
    found.users().withColumn("number", F.col("number") + 100_000).write.mode("append").parquet(f"{tmp_path}/users")
    found.roll_up(events)
    same(found, events)


def test_nothing_and_users_beyond_one_bitmap(spark, tmp_path):
    day = date(2024, 6, 1)
    made = spark.range(80_000).select(
        F.concat(F.lit("u"), (F.col("id") % 40_000).cast("string")).alias("user_id"),
        F.lit("ViewReport").alias("activity"),
        F.concat(F.lit("r"), (F.col("id") % 2).cast("string")).alias("report_name"),
        F.lit("w").alias("workspace_name"),
        F.lit("id").alias("report_id"),
        F.lit(day).alias("creation_date"),
    )
    found = rollups.Rollups(spark, str(tmp_path))
    found.roll_up(made.limit(0))
    assert rows(rollups.daily_views(found)) == []
    found.roll_up(made.unionByName(made.limit(1).withColumn("user_id", F.lit(None).cast("string"))).withColumn("creation_date", F.lit(day)))
    assert rows(rollups.daily_views(found)) == [(day, 80_001, 40_000)]
    assert sorted(r.distinct_users for r in rollups.most_viewed(found, day).collect()) == [20_000, 20_000]


def test_only_the_roll_ups_of_the_window_are_read(spark, tmp_path, events):
    found = rollups.Rollups(spark, str(tmp_path))
    found.roll_up(events)
    plan = plan_text(rollups.most_viewed(found, a.AS_OF, 3))
    assert "/views" in plan and "PartitionFilters: [" in plan and str(a.AS_OF - timedelta(days=3)) in plan
    assert "event_id" not in plan
