"""Watermarks and the newest day without a scan."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_text, rows
from tests.test_id_index import events
from tidemark.checks import adapters
from tidemark.operators import incremental
from tidemark.sinks import marks, tables

SF = "/root/testdata/sf0.001"


def scanned(spark, name):
    return rows(incremental.watermarks(spark.table(name)))


@pytest.fixture
def history(spark, tmp_path, request):
    name = f"marks_{abs(hash(request.node.name)) % 10**8}"
    tables.create_table(spark, name, tables.REFRESH_TABLE, str(tmp_path / "t"))
    tables.create_watermarks(spark, name)
    assert rows(tables.watermarks(spark, name)) == []
    tables.append(spark, name, adapters.refresh_history(spark, SF), tables.REFRESH_TABLE)
    return name


def test_commits_keep_watermarks(spark, history, monkeypatch):
    later = adapters.refresh_source(spark, SF).withColumn("start_time", F.col("start_time") + timedelta(days=1))
    before = scanned(spark, history)
    assert rows(tables.watermarks(spark, history)) == before
    tables.commit_refresh(spark, history, later)
    assert scanned(spark, history) != before
    monkeypatch.setattr(incremental, "watermarks", lambda table: pytest.fail("the table was read"))
    found = tables.watermarks(spark, history)
    monkeypatch.undo()
    assert rows(found) == scanned(spark, history)
    assert "_watermarks/version=" in plan_text(found) and "ingestion_date" not in plan_text(found)


def test_a_commit_that_dies_leaves_them_stale(spark, history, monkeypatch):
    source = adapters.refresh_source(spark, SF)
    with monkeypatch.context() as patch:
        patch.setattr(marks.Watermarks, "end", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            tables.commit_refresh(spark, history, source.withColumn("start_time", F.col("start_time") + timedelta(days=3)))
    assert rows(tables.watermarks(spark, history)) == scanned(spark, history)
    tables.commit_refresh(spark, history, source)
    assert rows(tables.watermarks(spark, history)) == scanned(spark, history)


def test_newest_day_from_the_listing(spark, tmp_path):
    name = "marks_listing"
    tables.create_table(spark, name, tables.ACTIVITY_TABLE, str(tmp_path / "t"))
    assert rows(tables.max_activity_date(spark, name)) == [(None,)]
    tables.append(spark, name, events(spark, "a", "b", "c"), tables.ACTIVITY_TABLE)
    (tmp_path / "t" / "creation_date=2024-09-09").mkdir()  # a folder that lost its files
    (tmp_path / "t" / "creation_date=__HIVE_DEFAULT_PARTITION__").mkdir()
    (tmp_path / "t" / "creation_date=__HIVE_DEFAULT_PARTITION__" / "part.parquet").write_text("")
    found = tables.max_activity_date(spark, name)
    assert rows(found) == [(date(2024, 6, 3),)] and "Parquet" not in plan_text(found)
    assert datetime(2024, 6, 3).date() == found.first()[0]
