"""Streams lose nothing: any order of arrival, damaged files, failures between writes, late registration."""

import json
import random
import shutil
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_pipelines import datasets, envelope, record, write  # noqa: F401
from tidemark.plans import pipelines
from tidemark.sinks import tables
from tidemark.streaming import events, ingest, pages, state

DAYS = [date(2024, 6, d) for d in (1, 2, 3, 4)]


def page(day, number, last, events):
    more = {} if number == last else {"continuationToken": "t", "continuationUri": "u"}
    made = [{"Id": f"{day}-{e}", "CreationTime": f"{day}T0{number % 10}:00:00Z", "Activity": "ViewReport"} for e in events]
    return {"page_no": number, "activityEventEntities": made, **more}


def page_files():
    """Files of four days: chains of 1 to 5 pages with a repeated event and a repeated page; the last day lacks a page."""
    found = []
    for day, n in zip(DAYS, (1, 3, 5, 4), strict=True):
        for number in range(1, n + 1):
            if (day, number) != (DAYS[3], 2):
                found.append((day, f"p{number}.json", page(day, number, n, [number, number + 1])))
    found.append((DAYS[1], "again.json", page(DAYS[1], 2, 3, [2, 3])))
    found.append((DAYS[2], "behind.json", page(DAYS[2], 7, 7, [70])))
    return found


def land(folder, file):
    day, name, document = file
    place = folder / f"day={day}"
    place.mkdir(parents=True, exist_ok=True)
    (place / name).write_text(document if isinstance(document, str) else json.dumps(document) + "\n")


def fetch_log(spark):
    return spark.createDataFrame([(d, "activity", 200, None) for d in DAYS], "day date, kind string, status int, error string")


COLUMNS = ("event_id", "creation_time", "creation_date", "activity")


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    """What the batch reader makes of all files."""
    place = tmp_path_factory.mktemp("whole")
    for file in page_files():
        land(place / "land", file)
    log = fetch_log(spark)
    pipelines.run_usage(
        spark, str(place / "land"), log, "whole_events", datetime(2024, 6, 6), date(2024, 6, 5), location=str(place / "t"),
        settings=pipelines.UsageSettings(lookback_days=4, first_page=1),
    )
    return rows(spark.table("whole_events"), *COLUMNS)


@pytest.mark.parametrize("seed", [2])
def test_pages_in_any_order_with_a_failure_and_a_damaged_file(spark, tmp_path, monkeypatch, seed, whole):
    source, progress, name = tmp_path / "land", str(tmp_path / "progress"), f"stream_events_{seed}"
    tables.create_table(spark, name, tables.ACTIVITY_TABLE, str(tmp_path / "t"))
    files = [*page_files(), (DAYS[2], "damaged.json", '{"page_no": 1, "activityEventEnt')]
    random.Random(seed).shuffle(files)
    failures = {1: "commit", 2: "state"}
    commit, write_state = tables.commit_events, state.Carried.write

    def run():
        pages.ingest_pages(spark, str(source), name, progress, quarantine=str(tmp_path / "quarantine"))

    for number, start in enumerate(range(0, len(files), 6)):
        for file in files[start : start + 6]:
            land(source, file)
        kind = failures.get(number)
        if kind:
            with monkeypatch.context() as patch:
                if kind == "commit":  # the events are in, the state is not

                    def broken(*args, **options):
                        commit(*args, **options)
                        raise RuntimeError("killed")

                    patch.setattr(tables, "commit_events", broken)
                else:  # the index is half way

                    def half(self, batch_id, frame):
                        if self.path.endswith("_index"):
                            write_state(self, batch_id, frame.limit(1))
                            raise RuntimeError("killed")
                        write_state(self, batch_id, frame)

                    patch.setattr(state.Carried, "write", half)
                try:
                    run()
                except Exception as problem:
                    assert "killed" in str(problem)
        run()
    assert rows(spark.table(name), *COLUMNS) == whole
    assert {r[0] for r in whole} == {f"{d}-{e}" for d, n in zip(DAYS[:3], (1, 3, 5)) for e in range(1, n + 2)}
    found = spark.read.parquet(str(tmp_path / "quarantine")).select("reason", "content").collect()
    assert [(r.reason, r.content) for r in found] == [("malformed document", '{"page_no": 1, "activityEventEnt')]
    # The page that was missing, then nothing new.
    land(source, (DAYS[3], "late.json", page(DAYS[3], 2, 4, [2, 3])))
    run()
    assert spark.table(name).filter(F.col("creation_date") == DAYS[3]).count() == 5
    run()
    # Waiting pages: those behind a chain's end, and what the last batches still hold.
    index = state.Carried(f"{progress}_index", pages.INDEX)
    left = index.before(spark, 10**6).filter("not loaded")
    assert rows(left, "day", "page_no") == [(DAYS[2], 7)]


def test_pages_of_loaded_batches_are_removed(spark, tmp_path):
    source, progress = tmp_path / "land", str(tmp_path / "progress")
    tables.create_table(spark, "stream_removed", tables.ACTIVITY_TABLE, str(tmp_path / "t"))
    for number in (1, 2, 3):
        land(source, (DAYS[0], f"p{number}.json", page(DAYS[0], number, 3, [number])))
        pages.ingest_pages(spark, str(source), "stream_removed", progress)
        assert spark.table("stream_removed").count() == (3 if number == 3 else 0)
    land(source, (DAYS[1], "p1.json", page(DAYS[1], 1, 1, [1])))
    pages.ingest_pages(spark, str(source), "stream_removed", progress)
    assert state.Carried(f"{progress}_pages", pages.HELD).numbers(spark) == [3]


def test_refresh_stream_quarantines_and_waits_for_registration(spark, tmp_path, datasets):  # noqa: F811
    source, progress, kept = tmp_path / "land", str(tmp_path / "progress"), str(tmp_path / "quarantine")
    tables.create_table(spark, "stream_waiting", tables.REFRESH_TABLE, str(tmp_path / "t"))
    registered = ["a"]

    def current(session):
        return datasets.filter(F.col("dataset_id").isin(registered))

    def run():
        ingest.ingest_refresh(spark, str(source), current, "stream_waiting", progress, quarantine=kept)
        return [r[0] for r in rows(spark.table("stream_waiting"), "request_id")]

    write(source, "1.json", envelope("a", record("a1", 1), record("", 2)), envelope("b", record("b1", 1)))
    (source / "2.json").write_text('{"dataset_id": "a", "value": [{"requestId"\n')
    assert run() == ["a1"]
    found = rows(spark.read.parquet(kept), "reason")
    assert found == [("malformed document",), ("missing requestId",)]
    write(source, "3.json", envelope("a", record("a2", 3)), envelope("b", record("b2", 3)))
    assert run() == ["a1", "a2"]
    registered.append("b")
    assert run() == ["a1", "a2", "b1", "b2"]  # no new file
    write(source, "4.json", envelope("b", record("b3", 4)))
    assert run() == ["a1", "a2", "b1", "b2", "b3"]
    shutil.rmtree(source)


def test_late_and_repeated_events_land_once(spark, tmp_path):
    source, progress = tmp_path / "land", str(tmp_path / "progress")
    source.mkdir()
    tables.create_table(spark, "stream_late", tables.ACTIVITY_TABLE, str(tmp_path / "t"))
    tables.create_id_index(spark, "stream_late", tables.ACTIVITY_TABLE, buckets=4)

    def arrive(name, *found):
        lines = [{"Id": i, "CreationTime": f"2024-{day}T01:00:00Z", "Activity": "ViewReport"} for i, day in found]
        (source / name).write_text("".join(json.dumps(e) + "\n" for e in lines))
        events.ingest_events(spark, str(source), "stream_late", progress)
        return rows(spark.table("stream_late"), "event_id", "creation_date")

    first = [("a", date(2024, 6, 9)), ("b", date(2024, 6, 9))]
    assert arrive("1.json", ("a", "06-09"), ("b", "06-09"), ("a", "06-09")) == first
    # A repeat, an event of months before, and a repeat of that.
    assert arrive("2.json", ("b", "06-09"), ("c", "01-02"), ("c", "01-02")) == [*first, ("c", date(2024, 1, 2))]


def test_the_state_of_repeats_is_bounded(spark, tmp_path):
    source = tmp_path / "land"
    source.mkdir()
    minutes = F.to_timestamp(F.get_json_object("raw", "$.At"))
    seen = []
    for hour in range(4):
        lines = [{"Id": f"{hour}-{i}", "At": f"2024-06-09 {hour + 1:02}:00:00"} for i in range(50)] + [{"Id": f"{hour}-1", "At": f"2024-06-09 {hour + 1:02}:01:00"}]
        (source / f"{hour}.json").write_text("".join(json.dumps(e) + "\n" for e in lines))
        stream = events.first_arrivals(events.event_stream(spark, str(source)), "10 minutes", arrived=minutes)
        query = stream.writeStream.foreachBatch(lambda batch, _: seen.append(batch.count())).option("checkpointLocation", str(tmp_path / "p")).trigger(availableNow=True).start()
        query.awaitTermination()
        held = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert sum(seen) == 200 and held <= 100
