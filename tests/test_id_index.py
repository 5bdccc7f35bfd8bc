"""The id index agrees with its store, also after commits that died; bucketed tables merge without moving stored rows."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_text, rows
from tidemark import session
from tidemark.checks import adapters
from tidemark.operators import merge
from tidemark.sinks import files, id_index, tables
from tidemark.sources.tables import csv_history

SF = "/root/testdata/sf0.001"
T0 = datetime(2024, 6, 1, 12)


def events(spark, *ids, shift=0):
    made = [(i, T0 + timedelta(days=(n + shift) % 3)) for n, i in enumerate(ids)]
    frame = spark.createDataFrame([(i, t, t.date(), t, t.date()) for i, t in made], "event_id string, creation_time timestamp, creation_date date, ingestion_timestamp timestamp, ingestion_date date")
    wanted = tables.ACTIVITY_TABLE.schema
    return frame.select(*[F.col(f.name) if f.name in frame.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted.fields])


@pytest.fixture
def store(spark, tmp_path, request):
    name = f"indexed_{abs(hash(request.node.name)) % 10**8}"
    tables.create_table(spark, name, tables.ACTIVITY_TABLE, str(tmp_path / "t"))
    tables.append(spark, name, events(spark, "a", "b", "c"), tables.ACTIVITY_TABLE)
    return name


def agree(spark, name, spec=tables.ACTIVITY_TABLE):
    index = tables.id_index(spark, name)
    found = rows(index.ids().select(spec.key, spec.partition).distinct())
    assert found == rows(spark.table(name), spec.key, spec.partition)
    return [r[0] for r in found]


def test_commits_use_and_keep_the_index(spark, store, monkeypatch):
    tables.create_id_index(spark, store, tables.ACTIVITY_TABLE, buckets=16)
    monkeypatch.setattr(merge, "known_ids", lambda *args, **options: pytest.fail("the table was searched"))
    # The same event under another day is still known; so is one repeated in the batch.
    tables.commit_events(spark, store, events(spark, "d", "a", "e", "d", shift=1))
    assert agree(spark, store) == ["a", "b", "c", "d", "e"]
    tables.commit_events(spark, store, events(spark, "d", "e"))
    tables.commit_events(spark, store, events(spark))
    assert agree(spark, store) == ["a", "b", "c", "d", "e"]


def test_only_the_buckets_of_the_batch_are_read(spark, store):
    many = events(spark, *[f"e{i}" for i in range(300)])
    tables.commit_events(spark, store, many)
    index = tables.create_id_index(spark, store, tables.ACTIVITY_TABLE, buckets=64)
    batch = spark.createDataFrame([("e7",), ("e8",), ("zz",), (None,)], "event_id string")
    found = index.lookup(batch)
    assert [r[0] for r in rows(found)] == ["e7", "e8"]
    touched = {r[0] for r in batch.where("event_id is not null").select(index.bucket(index.state)).collect()}
    listed = plan_text(found).split("PartitionFilters: [")[1].split("\n")[0]
    assert len(touched) == 3 and all(str(b) in listed for b in touched)


@pytest.mark.parametrize("moment", ["announced", "stored", "recorded", "half announced"])
def test_commits_that_die(spark, store, monkeypatch, moment):
    tables.create_id_index(spark, store, tables.ACTIVITY_TABLE, buckets=8)
    with monkeypatch.context() as patch:

        def die(*args, **options):
            raise RuntimeError("killed")

        if moment == "announced":
            patch.setattr(tables, "append", die)
        elif moment == "stored":
            patch.setattr(id_index.IdIndex, "record", die)
        elif moment == "recorded":
            patch.setattr(id_index, "remove_folder", die)
        else:
            announce = id_index.IdIndex.announce

            def half(self, new):
                name = announce(self, new)
                session.remove_folder(spark, f"{self.path}/pending/{name}/_SUCCESS")
                raise RuntimeError("killed")

            patch.setattr(id_index.IdIndex, "announce", half)
        with pytest.raises(RuntimeError, match="killed"):
            tables.commit_events(spark, store, events(spark, "d", "e"))
    stored = moment in ("stored", "recorded")
    assert spark.table(store).count() == (5 if stored else 3)
    tables.commit_events(spark, store, events(spark, "e", "f"))
    assert agree(spark, store) == (["a", "b", "c", "d", "e", "f"] if stored else ["a", "b", "c", "e", "f"])
    assert spark.table(store).count() == (6 if stored else 5)
    assert session.subfolders(spark, f"{tables.id_index(spark, store).path}/pending") == []


def test_compaction_keeps_one_file_a_bucket(spark, store, monkeypatch):
    index = tables.create_id_index(spark, store, tables.ACTIVITY_TABLE, buckets=2)
    monkeypatch.setattr(id_index, "COMPACT_AFTER", 3)
    for i in range(3):
        tables.commit_events(spark, store, events(spark, f"x{i}", f"y{i}"))
    assert agree(spark, store) == sorted(["a", "b", "c", *(f"{c}{i}" for c in "xy" for i in range(3))])
    assert (index.state.generation, index.state.commits) == (1, 0)
    assert len(index.ids().inputFiles()) <= 2
    assert session.subfolders(spark, index.path) == ["generation=1", "pending"]


def test_a_state_file_half_replaced_is_finished(spark, tmp_path):
    path = str(tmp_path / "state.json")
    assert session.read_replaced(spark, path) is None
    session.replace_text(spark, path, "one")
    session.write_text(spark, f"{path}.next", "two")  # died before the old one went
    assert session.read_replaced(spark, path) == "two"
    session.replace_text(spark, path, "three")
    assert session.read_replaced(spark, path) == "three"


def test_monthly_export_with_an_index(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "csv")
    columns = ["event_id", "creation_time", "creation_date", "activity"]
    first, second = (events(spark, *ids).select(columns) for ids in (("a", "b", "c"), ("b", "d", "d")))
    files.append_monthly_csv(first, path)
    index = files.create_csv_index(spark, path, columns)
    record = id_index.IdIndex.record
    with monkeypatch.context() as patch:
        patch.setattr(id_index.IdIndex, "record", lambda *args, **options: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            files.append_monthly_csv(second, path)
    assert record is id_index.IdIndex.record
    files.append_monthly_csv(events(spark, "d", "e").select(columns), path)
    assert [r[0] for r in rows(csv_history(spark, path, columns), "event_id")] == ["a", "b", "c", "d", "e"]
    assert [r[0] for r in rows(index.ids().select("event_id").distinct())] == ["a", "b", "c", "d", "e"]


def test_refresh_commits_with_index_and_buckets_equal_plain_ones(spark, tmp_path, monkeypatch):
    history, source = adapters.refresh_history(spark, SF), adapters.refresh_source(spark, SF)
    expected = rows(merge.merge_refresh(history, source))
    for number, (buckets, indexed, small) in enumerate([(None, True, True), (8, False, False), (8, True, True)]):
        name = f"refresh_layout_{number}"
        tables.create_table(spark, name, tables.REFRESH_TABLE, str(tmp_path / name), buckets=buckets)
        tables.append(spark, name, history, tables.REFRESH_TABLE)
        if indexed:
            tables.create_id_index(spark, name, tables.REFRESH_TABLE, buckets=8)
        with monkeypatch.context() as patch:
            if not small:
                patch.setattr(tables, "measured", lambda kept, **bounds: session.Side(kept, 0, False))
            for _ in range(2):
                tables.commit_refresh(spark, name, source)
        assert rows(spark.table(name).select(history.columns)) == expected
        if indexed:
            agree(spark, name, tables.REFRESH_TABLE)


def test_large_merges_leave_the_rows_of_a_bucketed_table_where_they_are(spark, tmp_path):
    tables.create_table(spark, "refresh_bucketed", tables.REFRESH_TABLE, str(tmp_path / "t"), buckets=8)
    tables.append(spark, "refresh_bucketed", adapters.refresh_history(spark, SF), tables.REFRESH_TABLE)
    target = spark.table("refresh_bucketed")
    batch = session.materialize(merge.one_per_request(adapters.refresh_source(spark, SF)))
    with session.session_conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        for joined in (merge.apply_updates(target, batch), merge.known_ids(target, batch.select("request_id"), "request_id")):
            assert "SelectedBucketsCount: 8 out of 8" in plan_text(joined)
            assert _exchanges(joined) == 1  # that of the batch


def _exchanges(frame):
    """Shuffles of the physical plan."""
    text = frame._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange" in line for line in text.split("\n"))


def test_days_of_a_bucketed_table_have_a_file_a_bucket(spark, tmp_path):
    tables.create_table(spark, "events_bucketed", tables.ACTIVITY_TABLE, str(tmp_path / "t"), buckets=4)
    tables.append(spark, "events_bucketed", events(spark, *[f"e{i}" for i in range(60)]), tables.ACTIVITY_TABLE)
    names = [f for f in spark.table("events_bucketed").filter(F.col("creation_date") == date(2024, 6, 1)).inputFiles()]
    assert len(names) == 4


def test_buckets_follow_the_expected_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_ROWS", 10)
    for number, (rows_expected, wanted) in enumerate([(0, 4), (40, 4), (41, 5), (730, 73)]):
        name = f"events_expected_{number}"
        tables.create_table(spark, name, tables.ACTIVITY_TABLE, str(tmp_path / name), buckets=4, rows=rows_expected)
        assert tables._buckets(spark, name) == wanted
    tables.create_table(spark, "events_unbucketed", tables.ACTIVITY_TABLE, str(tmp_path / "plain"), rows=730)
    assert tables._buckets(spark, "events_unbucketed") is None


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    tables.create_table(spark, "events_split", tables.ACTIVITY_TABLE, str(tmp_path / "t"), buckets=2)
    many = events(spark, *[f"e{i}" for i in range(3000)]).repartition(8)
    with session.session_conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="4kb"):
        tables.append(spark, "events_split", many, tables.ACTIVITY_TABLE)
    stored = spark.table("events_split")
    assert len(stored.filter(F.col("creation_date") == date(2024, 6, 1)).inputFiles()) > 2
    # Each file is named after the bucket of its rows, so joins that read bucket by bucket find every id.
    with session.session_conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        found = merge.known_ids(stored, many.select("event_id"), "event_id")
        assert "SelectedBucketsCount: 2 out of 2" in plan_text(found)
        assert found.count() == 3000


@pytest.mark.parametrize("outgrown", [False, True])
def test_merges_deal_the_rows_of_outgrown_buckets(spark, tmp_path, monkeypatch, outgrown):
    name = f"refresh_outgrown_{outgrown}"
    history, source = adapters.refresh_history(spark, SF), adapters.refresh_source(spark, SF)
    expected = rows(merge.merge_refresh(history, source))
    tables.create_table(spark, name, tables.REFRESH_TABLE, str(tmp_path / "t"), buckets=2)
    tables.append(spark, name, history, tables.REFRESH_TABLE)
    seen, apply_updates = [], merge.apply_updates

    def watched(target, batch):
        joined = apply_updates(target, batch)
        seen.append(_exchanges(joined))
        return joined

    monkeypatch.setattr(merge, "apply_updates", watched)
    monkeypatch.setattr(tables, "measured", lambda kept, **bounds: session.Side(kept, 0, False))
    if outgrown:
        monkeypatch.setattr(tables, "BUCKET_MAX_ROWS", 10)
    with session.session_conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        for _ in range(2):
            tables.commit_refresh(spark, name, source)
    assert seen == ([2, 2] if outgrown else [1, 1])
    assert rows(spark.table(name).select(history.columns)) == expected


def test_outgrown_buckets_of_events(spark, tmp_path, monkeypatch):
    tables.create_table(spark, "events_outgrown", tables.ACTIVITY_TABLE, str(tmp_path / "t"), buckets=2)
    monkeypatch.setattr(tables, "measured", lambda kept, **bounds: session.Side(kept, 0, False))
    monkeypatch.setattr(tables, "BUCKET_MAX_ROWS", 1)
    for ids in (["a", "b", "c", "d"], ["c", "e"], ["e", "a"]):
        tables.commit_events(spark, "events_outgrown", events(spark, *ids))
    assert [r[0] for r in rows(spark.table("events_outgrown"), "event_id")] == ["a", "b", "c", "d", "e"]
