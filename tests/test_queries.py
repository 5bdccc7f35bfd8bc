"""Every registered query against its SQL, and the plans of the reports on a stored table."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tests.conftest import plan_text, rows
from tidemark.checks import adapters
from tidemark.checks.oracles import ORACLES
from tidemark.checks.queries import QUERIES
from tidemark.checks.compare import connect, differences
from tidemark.operators import incremental, merge, ranking, transform
from tidemark.plans import reports
from tidemark.session import sized_side
from tidemark.sinks import tables

SF = "/root/testdata/sf0.001"
# Nothing overlaps on the last day at this scale.
EMPTY = {"rpt_overlap"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    found = differences(spark, duck, name, SF)
    assert found == (["no rows"] if name in EMPTY else [])


def test_entry(spark):
    assert entry_module.entry(spark).count() == 15


@pytest.fixture(scope="module")
def activity_table(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("activity"))
    tables.create_table(spark, "plan_activity", tables.ACTIVITY_TABLE, place)
    tables.append(spark, "plan_activity", transform.activity_rows(adapters.raw_events(spark, SF), adapters.RUN_AT), tables.ACTIVITY_TABLE)
    return spark.table("plan_activity")


@pytest.fixture(scope="module")
def refresh_table(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("refresh"))
    tables.create_table(spark, "plan_refresh", tables.REFRESH_TABLE, place)
    tables.append(spark, "plan_refresh", adapters.refresh_history(spark, SF), tables.REFRESH_TABLE)
    return spark.table("plan_refresh")


def scan_part(plan, label):
    return plan.split(label, 1)[1].split("]", 1)[0]


@pytest.mark.parametrize("report", [reports.most_viewed, reports.least_viewed, reports.top_users])
def test_usage_reports_prune_partitions(activity_table, report):
    plan = plan_text(report(activity_table, date(2024, 1, 30), days=3))
    assert "creation_date" in scan_part(plan, "PartitionFilters: [")
    assert report(activity_table, date(2024, 1, 30), days=3).count() > 0


def test_daily_counts_prune_partitions(refresh_table):
    plan = plan_text(reports.daily_status_counts(refresh_table, date(2024, 1, 30), days=3))
    assert "ingestion_date" in scan_part(plan, "PartitionFilters: [")
    assert scan_part(plan, "ReadSchema: ").startswith("struct<status:string>")


def test_filters_reach_the_scan(refresh_table):
    plan = plan_text(reports.average_duration(refresh_table, date(2024, 1, 30)))
    assert "EqualTo(status,Completed)" in plan and "GreaterThanOrEqual(start_time" in plan
    assert "service_exception_json" not in plan.split("ReadSchema:")[1]


@pytest.mark.parametrize("report", [reports.average_duration, reports.failures])
def test_start_bound_can_prune_ingestion_days(refresh_table, report):
    today = date(2024, 1, 30)
    pruned = report(refresh_table, today, 3, ingested_after_start=True)
    assert "ingestion_date" in scan_part(plan_text(pruned), "PartitionFilters: [")
    assert rows(pruned) == rows(report(refresh_table, today, 3))


def test_overlap_can_prune_ingestion_days(refresh_table):
    today = date(2024, 1, 20)
    pruned = reports.overlapping_refreshes(refresh_table, today, 5, ingested_after_start=True, longest_days=2)
    assert "ingestion_date" in scan_part(plan_text(pruned), "PartitionFilters: [")
    assert rows(pruned) == rows(reports.overlapping_refreshes(refresh_table, today, 5))


def test_merges_leave_the_stored_rows_in_place(spark, refresh_table):
    batch = refresh_table.limit(20).withColumn("status", F.lit("Completed"))
    tree = plan_text(merge.merge_refresh(refresh_table, batch)).split("\n\n", 1)[0]
    assert "FullOuter" not in tree and "Window" not in tree
    assert "BroadcastHashJoin LeftOuter" in tree and "BroadcastHashJoin LeftSemi" in tree


def test_latest_status_neither_sorts_nor_shuffles_whole_rows(refresh_table):
    tree = plan_text(reports.latest_status(refresh_table)).split("\n\n", 1)[0]
    below_output_order = tree.split("Exchange", 1)[1]
    assert "BroadcastHashJoin LeftSemi" in below_output_order
    assert below_output_order.count("Exchange") == 1 and "Sort" not in below_output_order


def test_latest_rows_are_the_same_either_way(spark, monkeypatch):
    data = [("a", 1), ("a", 3), ("a", 3), ("b", 2), (None, 9), ("c", None)]
    frame = spark.createDataFrame([(k, None if t is None else datetime(2024, 5, t)) for k, t in data], "key string, at timestamp")
    joined = rows(ranking.latest_rows(frame, "key", "at"))
    monkeypatch.setattr(ranking, "sized_side", lambda side: sized_side(side, max_rows=0))
    assert joined == rows(ranking.latest_rows(frame, "key", "at"))
    assert [k for k, _ in joined] == ["a", "a", "b"]


def test_ranking_limits_groups_before_the_shuffle(refresh_table):
    plan = plan_text(ranking.latest_with_ties(refresh_table, "dataset_id", "start_time"))
    tree = plan.split("\n\n", 1)[0]
    assert tree.count("WindowGroupLimit") == 2 and tree.count("Scan parquet") == 1


def test_top_k_is_not_a_full_sort(activity_table):
    assert "TakeOrderedAndProject" in plan_text(reports.top_users(activity_table, date(2024, 1, 30)))


def test_merge_finds_stored_ids_without_shuffling_the_table(refresh_table):
    ids = sized_side(refresh_table.select("request_id").limit(20))
    plan = plan_text(merge.known_ids(refresh_table, ids.frame, "request_id", carry=("ingestion_date",)))
    assert "BroadcastHashJoin LeftSemi" in plan and "Exchange hashpartitioning" not in plan
    assert scan_part(plan, "ReadSchema: ").startswith("struct<request_id:string>")


def test_merge_reads_changed_days_only(spark, refresh_table):
    changed = refresh_table.select("ingestion_date").filter("ingestion_date >= '2024-01-29'")
    touched = incremental.only_days(refresh_table, changed, "ingestion_date")
    batch = sized_side(refresh_table.limit(20))
    plan = plan_text(merge.apply_updates(touched, batch.frame))
    assert "ingestion_date" in scan_part(plan, "PartitionFilters: [")
    assert "BroadcastHashJoin LeftOuter" in plan and "Exchange hashpartitioning" not in plan


def test_large_side_is_not_broadcast(spark):
    side = spark.range(50).selectExpr("id AS k", "repeat('x', 100) AS text")
    big = spark.range(1000).withColumnRenamed("id", "k")

    def plan_with(**bounds):
        found = sized_side(side, **bounds)
        assert found.rows == 50
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            return plan_text(big.join(found.frame, "k"))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    assert "BroadcastHashJoin" in plan_with(max_rows=50)
    assert "BroadcastHashJoin" not in plan_with(max_rows=49)
    assert "BroadcastHashJoin" not in plan_with(max_bytes=1000)


def test_split_and_plain_paths_agree_with_forced_shuffles(spark, duck, monkeypatch):
    """Same results when no side is small enough to broadcast."""
    import tidemark.session as session

    def never_small(df, **_):
        return session.materialize(df)

    for module in ("operators.triage", "operators.incremental", "operators.registry", "sources.landing"):
        monkeypatch.setattr(f"tidemark.{module}.small_side", never_small)
    def not_small(kept, **_):
        return session.Side(kept, kept.count(), False)

    monkeypatch.setattr("tidemark.sinks.tables.measured", not_small)
    monkeypatch.setattr("tidemark.session.measured", not_small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("triage_take_while", "agg_midpoint_watermark", "join_registry_resolve", "src_activity_pages", "sink_merge_commit", "rpt_latest_status"):
            assert differences(spark, duck, name, SF) == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(spark.range(1)) == [(0,)]
