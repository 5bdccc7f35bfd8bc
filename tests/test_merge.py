import shutil
import uuid
from datetime import datetime

import pytest

from tests.conftest import rows
from tidemark import schemas
from tidemark.operators import merge
from tidemark.sinks import tables

T0, T1 = datetime(2024, 6, 1), datetime(2024, 6, 2)


def refresh(spark, *entries):
    base = {"dataset_id": "d", "workspace_id": "w", "ingestion_timestamp": T0}
    full = [{**{f: None for f in schemas.REFRESH_HISTORY.fieldNames()}, **base, **e} for e in entries]
    for e in full:
        e["ingestion_date"] = e["ingestion_date"] or e["ingestion_timestamp"].date()
    return spark.createDataFrame(full, schemas.REFRESH_HISTORY)


COLUMNS = ("request_id", "status", "end_time", "dataset_name", "ingestion_timestamp", "ingestion_date")


@pytest.fixture
def stored(spark):
    return refresh(
        spark,
        {"request_id": "run", "status": "Unknown", "dataset_name": "old"},
        {"request_id": "done", "status": "Completed", "end_time": T0, "dataset_name": "old"},
        {"request_id": "keep", "status": "Failed", "dataset_name": "old"},
    )


@pytest.fixture
def batch(spark):
    new = {"ingestion_timestamp": T1, "dataset_name": "new"}
    return refresh(
        spark,
        {"request_id": "run", "status": "Completed", "end_time": T1, **new},
        {"request_id": "run", "status": "Unknown", **new},
        {"request_id": "done", "status": "Failed", "end_time": None, **new},
        {"request_id": "keep", "status": "Unknown", **new},
        {"request_id": "fresh", "status": "Unknown", **new},
    )


EXPECTED = [
    ("done", "Failed", None, "old", T1, T0.date()),
    ("fresh", "Unknown", None, "new", T1, T1.date()),
    ("keep", "Failed", None, "old", T0, T0.date()),
    ("run", "Completed", T1, "old", T1, T0.date()),
]


def test_merge_refresh(stored, batch):
    once = merge.merge_refresh(stored, batch)
    assert rows(once, *COLUMNS) == EXPECTED
    assert rows(merge.merge_refresh(once, batch), *COLUMNS) == EXPECTED


def test_null_status_does_not_update(spark, stored):
    merged = merge.merge_refresh(stored, refresh(spark, {"request_id": "done", "status": None, "ingestion_timestamp": T1}))
    assert ("done", "Completed") in rows(merged, "request_id", "status")


def test_commit_equals_merge(spark, stored, batch, tmp_path):
    tables.create_table(spark, "merge_commit", tables.REFRESH_TABLE, str(tmp_path / "t"))
    tables.append(spark, "merge_commit", stored, tables.REFRESH_TABLE)
    for _ in range(2):
        tables.commit_refresh(spark, "merge_commit", batch)
        assert rows(spark.table("merge_commit"), *COLUMNS) == EXPECTED
    tables.commit_refresh(spark, "merge_commit", batch.limit(0))
    assert rows(spark.table("merge_commit"), *COLUMNS) == EXPECTED


@pytest.fixture
def crashed(spark, stored, batch, tmp_path, monkeypatch):
    """A table and folder whose commit was staged when the driver was lost."""
    place, name = tmp_path / "t", f"merge_{uuid.uuid4().hex}"
    tables.create_table(spark, name, tables.REFRESH_TABLE, str(place))
    tables.append(spark, name, stored, tables.REFRESH_TABLE)

    def die(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(tables, "_apply_stage", die)
    with pytest.raises(RuntimeError):
        tables.commit_refresh(spark, name, batch)
    monkeypatch.undo()
    return name, place


def only_stage(place):
    (stage,) = (place / "_staged_merge").iterdir()
    return stage


def test_commit_survives_a_crash_while_days_are_replaced(spark, batch, crashed, tmp_path):
    name, place = crashed
    # The old files of a day are gone and the new ones are not in place yet.
    shutil.move(place / "ingestion_date=2024-06-01", tmp_path / "gone")
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == 0

    tables.commit_refresh(spark, name, batch.limit(0))
    assert rows(spark.table(name), *COLUMNS) == EXPECTED
    assert not (place / "_staged_merge").exists()
    assert rows(spark.read.parquet(str(place)), *COLUMNS) == EXPECTED


def test_append_finishes_a_staged_commit_first(spark, crashed):
    name, _ = crashed
    later = refresh(spark, {"request_id": "later", "status": "Failed", "dataset_name": "late", "ingestion_timestamp": T1})
    tables.append(spark, name, later, tables.REFRESH_TABLE)
    assert rows(spark.table(name), *COLUMNS) == sorted([*EXPECTED, ("later", "Failed", None, "late", T1, T1.date())])


def test_a_day_that_changed_meanwhile_is_not_replaced(spark, crashed):
    name, place = crashed
    other = refresh(spark, {"request_id": "other"}, {"request_id": "more"}).select(spark.table(name).columns)
    other.write.insertInto(name)
    with pytest.raises(RuntimeError, match="changed after"):
        tables.finish_commit(spark, name)
    assert spark.table(name).count() == 5 and only_stage(place).exists()


def test_a_half_removed_stage_deletes_nothing(spark, crashed):
    name, place = crashed
    stage = only_stage(place)
    for file in list((stage / "rows" / "ingestion_date=2024-06-01").glob("*.parquet"))[:1]:
        file.unlink()
    before = rows(spark.table(name), *COLUMNS)
    with pytest.raises(RuntimeError, match="lacks rows"):
        tables.finish_commit(spark, name)
    assert rows(spark.table(name), *COLUMNS) == before
    (stage / "ready.json").unlink()  # what removal does first
    tables.finish_commit(spark, name)
    assert rows(spark.table(name), *COLUMNS) == before and not stage.exists()


def test_commit_needs_no_success_markers(spark, stored, batch, tmp_path):
    tables.create_table(spark, "merge_unmarked", tables.REFRESH_TABLE, str(tmp_path / "t"))
    tables.append(spark, "merge_unmarked", stored, tables.REFRESH_TABLE)
    hadoop, key = spark.sparkContext._jsc.hadoopConfiguration(), "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    hadoop.set(key, "false")
    try:
        tables.commit_refresh(spark, "merge_unmarked", batch)
    finally:
        hadoop.unset(key)
    assert rows(spark.table("merge_unmarked"), *COLUMNS) == EXPECTED


def test_commit_leaves_other_days_alone(spark, stored, tmp_path):
    place = tmp_path / "t"
    tables.create_table(spark, "merge_days", tables.REFRESH_TABLE, str(place))
    late = refresh(spark, {"request_id": "later", "status": "Unknown", "ingestion_timestamp": T1})
    tables.append(spark, "merge_days", stored.union(late), tables.REFRESH_TABLE)
    before = {f.name for f in (place / "ingestion_date=2024-06-01").iterdir()}
    done = refresh(spark, {"request_id": "later", "status": "Completed", "ingestion_timestamp": datetime(2024, 6, 3)})
    still = refresh(spark, {"request_id": "run", "status": "Unknown", "ingestion_timestamp": datetime(2024, 6, 3)})
    tables.commit_refresh(spark, "merge_days", done.union(still))
    assert {f.name for f in (place / "ingestion_date=2024-06-01").iterdir()} == before
    assert ("later", "Completed") in rows(spark.table("merge_days"), "request_id", "status")
    assert spark.table("merge_days").count() == 4
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def events(spark, *entries):
    full = [{**{f: None for f in schemas.ACTIVITY_EVENTS.fieldNames()}, "ingestion_timestamp": T1, "ingestion_date": T1.date(), **e} for e in entries]
    for e in full:
        e["creation_date"] = e["creation_time"] and e["creation_time"].date()
    return spark.createDataFrame(full, schemas.ACTIVITY_EVENTS)


def test_merge_events_is_order_independent_and_idempotent(spark):
    target = events(spark, {"event_id": "a", "creation_time": T0, "activity": "stored"})
    one = events(spark, {"event_id": "a", "creation_time": T1}, {"event_id": "b", "creation_time": T0, "activity": "first"})
    two = events(spark, {"event_id": "b", "creation_time": T0, "activity": "first"}, {"event_id": "c", "creation_time": None})
    expected = [("a", "stored"), ("b", "first"), ("c", None)]
    for order in ([one, two], [two, one], [one.union(two)], [one, one, two, two]):
        merged = target
        for source in order:
            merged = merge.merge_events(merged, source)
        assert rows(merged, "event_id", "activity") == expected


@pytest.mark.parametrize("immutable_days", [False, True])
def test_commit_events(spark, tmp_path, immutable_days):
    name = f"events_{immutable_days}"
    tables.create_table(spark, name, tables.ACTIVITY_TABLE, str(tmp_path / "t"))
    source = events(spark, {"event_id": "a", "creation_time": T0}, {"event_id": "a", "creation_time": T1}, {"event_id": "n", "creation_time": None})
    for _ in range(2):
        tables.commit_events(spark, name, source, immutable_days)
        assert rows(spark.table(name), "event_id", "creation_time") == [("a", T0), ("n", None)]


def test_required_columns_are_enforced(spark, tmp_path):
    tables.create_table(spark, "required", tables.PROBE_TABLE, str(tmp_path / "t"))
    bad = spark.createDataFrame([{"probe_id": "p", "probe_timestamp": T0, "probe_date": T0.date()}], "probe_id string, workspace_id string, workspace_name string, dataset_id string, dataset_name string, query_label string, status string, duration_ms double, row_count int, error_message string, is_critical boolean, probe_timestamp timestamp, probe_date date")
    with pytest.raises(Exception, match="null in required column"):
        tables.append_probes(spark, "required", bad)
    assert spark.table("required").count() == 0


def test_created_tables_carry_partition_and_comments(spark, tmp_path):
    for number, spec in enumerate([tables.REFRESH_TABLE, tables.PROBE_TABLE, tables.ACTIVITY_TABLE]):
        name = f"created_{number}"
        for _ in range(2):
            tables.create_table(spark, name, spec, str(tmp_path / name))
        columns = {c.name: c for c in spark.catalog.listColumns(name)}
        assert set(columns) == set(spec.schema.fieldNames())
        assert [c.name for c in columns.values() if c.isPartition] == [spec.partition]
        assert all(c.description for c in columns.values())
