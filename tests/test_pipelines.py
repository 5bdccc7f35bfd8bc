import csv
import json
from datetime import date, datetime, timedelta

import pytest

from tests.conftest import rows
from tidemark import schemas
from tidemark.operators import incremental, registry, transform
from tidemark.plans import pipelines, settings
from tidemark.sources import config, landing, tables as stored
from tidemark.sinks import files, tables
from tidemark.streaming.ingest import ingest_refresh

RUN = datetime(2024, 6, 10, 3)


def write(folder, name, *documents):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(d) + "\n" for d in documents))


def record(request_id, hour, status="Completed", **more):
    start = datetime(2024, 6, 9) + timedelta(hours=hour)
    end = None if status == "Unknown" else (start + timedelta(minutes=5)).isoformat() + "Z"
    return {"requestId": request_id, "startTime": start.isoformat() + "Z", "endTime": end, "status": status, **more}


def envelope(dataset, *records):
    return {"workspace_id": "ws", "dataset_id": dataset, "value": list(records)}


@pytest.fixture
def datasets(spark):
    return spark.createDataFrame(
        [("a", "Alpha", "ws", "One", True, True), ("b", "Beta", "ws", "One", False, True)],
        "dataset_id string, dataset_name string, workspace_id string, workspace_name string, is_critical boolean, is_active boolean",
    )


def test_refresh_pipeline(spark, tmp_path, datasets):
    def run(number, **options):
        pipelines.run_refresh(
            spark, str(tmp_path / f"land{number}"), datasets, "pipe_refresh", RUN + timedelta(days=number),
            location=str(tmp_path / "t"), alerts_path=str(tmp_path / "alerts"), **options,
        )
        return rows(spark.table("pipe_refresh"), "request_id", "status", "ingestion_date")

    first = date(2024, 6, 10)
    write(
        tmp_path / "land0",
        "x.json",
        envelope("a", record("a1", 1), record("a2", 2, "Unknown"), record("", 3)),
        envelope("b", record("b1", 1, "Failed", serviceExceptionJson='{"errorCode":"Boom"}', refreshAttempts=[{"attemptId": 1}])),
        envelope("stranger", record("s1", 1)),
        {"workspace_id": "ws", "dataset_id": "a"},
    )
    expected = [("a1", "Completed", first), ("a2", "Unknown", first), ("b1", "Failed", first)]
    assert run(0) == expected
    alert_rows = spark.read.parquet(str(tmp_path / "alerts"))
    assert rows(alert_rows, "alert_type", "message") == [("refresh_failure", "Refresh failed with error: Boom")]
    assert rows(spark.table("pipe_refresh").filter("request_id = 'b1'"), "attempt_count", "error_code") == [(1, "Boom")]

    # a2 is not newer than the mark of its dataset but was still running; a0 is older and new.
    write(tmp_path / "land1", "x.json", envelope("a", record("a2", 2), record("a3", 4), record("a0", 0)))
    expected = [("a1", "Completed", first), ("a2", "Completed", first), ("a3", "Completed", date(2024, 6, 11)), ("b1", "Failed", first)]
    assert run(1) == expected
    assert run(1) == expected
    assert len(run(1, incremental_mode=False)) == 5


def page(number, *ids, more=True):
    tail = {"continuationToken": "t", "continuationUri": "u"} if more else {"continuationToken": None, "continuationUri": None}
    return {"page_no": number, "activityEventEntities": [{"Id": i, "Activity": "ViewReport", "CreationTime": f"2024-06-0{i[1]}T10:00:00Z"} for i in ids], **tail}


def fetch_log(spark, statuses):
    data = [(date(2024, 6, int(d)), "activity", s, None) for d, s in statuses.items()]
    return spark.createDataFrame(data, "day date, kind string, status int, error string")


def test_usage_pipeline(spark, tmp_path):
    land = tmp_path / "pages"
    write(land / "day=2024-06-05", "p.json", page(1, "d5a", "d5b"), page(2, "d5c", more=False), page(3, "d5-stray"))
    write(land / "day=2024-06-06", "p.json", page(1, more=False))
    write(land / "day=2024-06-07", "p.json", page(1, "d7a", more=False))
    write(land / "day=2024-06-08", "p.json", page(1, "d8a"), page(3, "d8c", more=False))
    write(land / "day=2024-06-09", "p.json", page(1, "d9a", more=False))

    def run(statuses, **options):
        pipelines.run_usage(
            spark, str(land), fetch_log(spark, statuses), "pipe_usage", RUN, date(2024, 6, 10),
            pipelines.UsageSettings(lookback_days=5, **options), location=str(tmp_path / "t"),
        )
        return [r[0] for r in rows(spark.table("pipe_usage"), "event_id")]

    assert run({5: 200, 6: 200, 7: 429}) == ["d5a", "d5b", "d5c"]
    everything = dict.fromkeys(range(5, 10), 200)
    # Page 2 of the 8th is missing: that day and the later ones wait.
    assert run(everything) == ["d5a", "d5b", "d5c", "d7a"]
    write(land / "day=2024-06-08", "q.json", page(2, "d8b"))
    write(land / "day=2024-06-07", "late.json", page(0, "d7late"))
    complete = ["d5a", "d5b", "d5c", "d7a", "d7late", "d8a", "d8b", "d8c", "d9a"]
    assert run(everything) == complete
    assert run(everything) == complete


def test_capped_usage_moves_on_with_the_fetch_log(spark, tmp_path):
    land = tmp_path / "pages"
    for day in range(5, 10):
        ids = ["d5a"] if day == 5 else ["d9a"] if day == 9 else []
        write(land / f"day=2024-06-0{day}", "p.json", page(1, *ids, more=False))
    statuses = dict.fromkeys(range(5, 10), 200)
    capped = pipelines.UsageSettings(lookback_days=5, max_days_per_run=2)
    done = None
    for _ in range(4):
        pipelines.run_usage(
            spark, str(land), fetch_log(spark, statuses), "pipe_capped", RUN, date(2024, 6, 10), capped,
            completed=done, location=str(tmp_path / "t"),
        )
        loaded = incremental.max_activity_date(spark.table("pipe_capped")) if done is None else done
        window = incremental.limit_backfill(incremental.dates_to_fetch(loaded, 5, date(2024, 6, 10)), 2)
        last = max(r[0] for r in window.collect())
        done = spark.createDataFrame([(last,)], "max_date date")
    assert [r[0] for r in rows(spark.table("pipe_capped"), "event_id")] == ["d5a", "d9a"]


def test_probe_pipeline(spark, tmp_path):
    (tmp_path / "probes.json").write_text(
        json.dumps(
            {
                "probes": [
                    {"workspace_id": "w", "dataset_id": "d", "query_label": q, "workspace_name": "One", "is_active": active, "dax_query": "x"}
                    for q, active in [("a", None), ("b", False), ("c", True)]
                ]
            },
            indent=2,
        )
    )
    probes = config.probes(spark, str(tmp_path / "probes.json"))
    assert rows(registry.active_only(probes), "query_label", "pos") == [("a", 0), ("c", 2)]
    responses = spark.createDataFrame(
        [("w", "d", q, 200 if q == "a" else 403, None, "{}", RUN, RUN) for q in "abc"],
        "workspace_id string, dataset_id string, query_label string, http_status int, error string, payload string, sent_at timestamp, received_at timestamp",
    )
    pipelines.run_probes(spark, responses, probes, "pipe_probe", str(tmp_path / "t"))
    table = spark.table("pipe_probe")
    assert rows(table, "query_label", "status", "workspace_name") == [("a", "Success", "One"), ("c", "Failed", "One")]
    assert rows(pipelines.probe_summary(table)) == [(1, 1)]


def test_dataset_config_is_read_with_positions(spark, tmp_path):
    entry = {"workspace_id": "w", "workspace_name": "W", "dataset_id": "d", "dataset_name": "D"}
    document = {"_comment": "x", "datasets": [entry, {**entry, "dataset_name": "E", "is_active": False}], "workspaces": [{"workspace_id": "w", "exclude_datasets": ["z"]}]}
    (tmp_path / "c.json").write_text(json.dumps(document, indent=2))
    assert rows(config.explicit_datasets(spark, str(tmp_path / "c.json")), "pos", "dataset_name", "is_active") == [(0, "D", None), (1, "E", False)]
    assert rows(config.workspaces(spark, str(tmp_path / "c.json")), "pos", "exclude_datasets") == [(0, ["z"])]


def test_single_document_envelope_and_corrupt_document(spark, tmp_path):
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "a.json").write_text(json.dumps(envelope("a", record("a1", 1)), indent=2))
    found = landing.refresh_records(spark, str(tmp_path / "one"), multi_line=True)
    assert rows(found, "dataset_id", "requestId") == [("a", "a1")]
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "a.json").write_text("broken{\n" + json.dumps(envelope("a", record("a1", 1))) + "\n")
    assert rows(landing.refresh_records(spark, str(tmp_path / "bad")), "requestId") == [("a1",)]
    lost = landing.malformed_documents(spark, str(tmp_path / "bad"), schemas.REFRESH_ENVELOPE)
    assert rows(lost, "reason", "content") == [("malformed document", "broken{")]


def test_nothing_landed_vanishes(spark, tmp_path, datasets):
    write(tmp_path / "land", "x.json", envelope("a", record("a1", 1), record("", 3), record("a2", 2)), envelope("b", record("b1", 1)))
    with open(tmp_path / "land" / "x.json", "a") as file:
        file.write('{"workspace_id": "ws", "dataset_id": "b", "value": [{"reque\n')
    document = {k: {"table_name": f"pipe_{k}"} for k in ("delta_table", "query_performance_table", "activity_events_table")}
    (tmp_path / "settings.json").write_text(json.dumps({**document, "alerting": {"enabled": True, "teams_webhook_url": "https://x"}}, indent=1))
    chosen = settings.load(spark, str(tmp_path / "settings.json"))
    options = {"location": str(tmp_path / "t"), "quarantine": str(tmp_path / "q")}
    stats = settings.run_refresh(spark, chosen, str(tmp_path / "land"), datasets, RUN + timedelta(days=9), str(tmp_path / "alerts"), **options)
    assert rows(stats, "datasets_processed", "datasets_skipped") == [(2, 0)]
    held = rows(spark.read.parquet(str(tmp_path / "q")), "reason", "content")
    assert [reason for reason, _ in held] == ["malformed document", "missing requestId"] and "reque" in held[0][1]
    alert = spark.read.parquet(str(tmp_path / "alerts")).first()
    assert (alert.log_level, alert.channel) == ("CRITICAL", "log+card") and json.loads(alert.card)["type"] == "message"


def test_a_damaged_first_page_keeps_its_day_open(spark, tmp_path):
    land = tmp_path / "pages"
    write(land / "day=2024-06-08", "p.json", page(1, "d8a", more=False))
    write(land / "day=2024-06-09", "p.json", page(2, "d9b", more=False))
    (land / "day=2024-06-09" / "first.json").write_text('{"page_no": 1, "activityEve\n')

    def run(**options):
        counts = pipelines.run_usage(
            spark, str(land), fetch_log(spark, {8: 200, 9: 200}), "pipe_damaged", RUN, date(2024, 6, 10),
            pipelines.UsageSettings(lookback_days=2, **options), location=str(tmp_path / "t"), quarantine=str(tmp_path / "q"),
        )
        return [r[0] for r in rows(spark.table("pipe_damaged"), "event_id")], rows(counts)

    loaded, counts = run()
    assert loaded == ["d8a"] and counts == [(date(2024, 6, 8), 1, 1, 1)]
    assert spark.read.parquet(str(tmp_path / "q")).first().reason == "malformed document"
    (land / "day=2024-06-09" / "first.json").unlink()  # now the first page is missing altogether
    assert run(first_page=1)[0] == ["d8a"]
    write(land / "day=2024-06-09", "first.json", page(1, "d9a"))
    assert run(first_page=1)[0] == ["d8a", "d9a", "d9b"]


def test_csv_is_standard(spark, tmp_path):
    path = str(tmp_path / "export")
    names = ['say "hi", then', "two\nlines", "plain", 'end"']
    raw = [{"Id": f"e{i}", "CreationTime": "2024-05-01T00:00:00Z" if i else None, "ReportName": n} for i, n in enumerate(names)]
    events = transform.activity_rows(
        spark.createDataFrame([(json.dumps(e), date(2024, 7, 3)) for e in raw], "raw string, fetch_day date"), RUN, keep=("fetch_day",)
    )
    for _ in range(2):
        files.append_monthly_csv(events, path)
    assert rows(stored.csv_history(spark, path), "event_id", "report_name") == [(f"e{i}", n) for i, n in enumerate(names)]
    assert sum(r[1] for r in rows(files.file_summary(spark, path))) == 4
    found = []
    for file in (tmp_path / "export").rglob("*.csv"):
        with file.open(newline="") as text:
            found += [(r["event_id"], r["report_name"], file.parent.name[-7:]) for r in csv.DictReader(text)]
    assert sorted(found) == [(f"e{i}", n, "2024_05" if i else "2024_07") for i, n in enumerate(names)]


def test_settings_are_read_through_spark(spark, tmp_path):
    names = {k: {"table_name": k[0]} for k in ("delta_table", "query_performance_table", "activity_events_table")}
    (tmp_path / "s.json").write_text(json.dumps(names, indent=2))
    assert settings.load(spark, f"file://{tmp_path}/s.json").refresh_table == "d"


def test_monthly_csv(spark, tmp_path):
    path = str(tmp_path / "export")
    raw = [{"Id": f"e{i}", "CreationTime": f"2024-0{m}-01T00:00:00Z", "ReportName": 'a "b", c'} for i, m in enumerate([5, 5, 6, 6])]
    events = transform.activity_rows(spark.createDataFrame([(json.dumps(e),) for e in raw + raw[:1]], "raw string"), RUN)
    files.append_monthly_csv(events.limit(0), path)
    files.append_monthly_csv(events.filter("event_id < 'e2'"), path)
    files.append_monthly_csv(events, path)
    assert [r[0] for r in rows(stored.csv_known_ids(spark, path))] == ["e0", "e1", "e2", "e3"]
    names = {p.name for p in (tmp_path / "export").iterdir() if p.is_dir()}
    assert names == {"file_key=activity_events_2024_05", "file_key=activity_events_2024_06"}
    assert sum(r[1] for r in rows(files.file_summary(spark, path))) == 4
    files.write_refresh_csv(events.limit(2), str(tmp_path / "refresh"))
    files.write_refresh_csv(events.limit(1), str(tmp_path / "refresh"))
    assert spark.read.option("header", True).csv(str(tmp_path / "refresh")).count() == 1


def test_exports(spark, tmp_path):
    write(tmp_path / "land", "x.json", envelope("a", record("a1", 1)), envelope("b", record("b1", 1), record("b2", 2)))
    write(tmp_path / "list", "l.json", {"workspace_id": "ws", "value": [{"id": "a", "name": "Alpha"}, {"id": "b"}]})
    listing = landing.dataset_listing(spark, str(tmp_path / "list"), name_by_id=True)
    pipelines.export_refresh(spark, str(tmp_path / "land"), listing, str(tmp_path / "refresh"), RUN)
    found = spark.read.option("header", True).csv(str(tmp_path / "refresh"))
    assert rows(found, "request_id", "dataset_name") == [("a1", "Alpha"), ("b1", "b"), ("b2", "b")]

    land = tmp_path / "pages"
    write(land / "day=2024-06-05", "p.json", page(1, "d5a", "d5a", more=False))
    write(land / "day=2024-06-06", "p.json", page(1, "d6a", "d5a", more=False))
    for last in (date(2024, 6, 5), date(2024, 6, 6), date(2024, 6, 6)):
        days = incremental.export_range(spark, date(2024, 6, 10), start=date(2024, 6, 5), end=last)
        pipelines.export_activity(spark, str(land), days, str(tmp_path / "csv"), RUN)
    assert [r[0] for r in rows(stored.csv_known_ids(spark, str(tmp_path / "csv")))] == ["d5a", "d6a"]
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2


def test_settings():
    names = {"delta_table": {"catalog": "c", "schema": "s", "table_name": "r"}, "query_performance_table": {"table_name": "p"}, "activity_events_table": {"schema": "s", "table_name": "a"}}
    plain = settings.from_document(names)
    assert (plain.refresh_table, plain.probe_table, plain.activity_table) == ("c.s.r", "p", "s.a")
    assert plain.usage.max_days_per_run is None and not plain.alerts_enabled
    full = settings.from_document(
        {**names, "alerting": {"enabled": True, "teams_webhook_url": "https://x", "check_stale_data": False}, "usage": {"tracked_activities": ["ViewReport"], "max_backfill_days_per_run": 7}}
    )
    assert full.alerts_enabled and full.card_channel and not full.alerts.check_stale_data
    assert full.usage.tracked_activities == ("ViewReport",) and full.usage.max_days_per_run == 7


def test_stream_takes_each_file_once(spark, tmp_path, datasets):
    land, progress = tmp_path / "land", str(tmp_path / "progress")
    tables.create_table(spark, "stream_refresh", tables.REFRESH_TABLE, str(tmp_path / "t"))

    def run():
        ingest_refresh(spark, str(land), datasets, "stream_refresh", progress)
        return rows(spark.table("stream_refresh"), "request_id", "status")

    write(land, "1.json", envelope("a", record("a1", 1, "Unknown")))
    assert run() == [("a1", "Unknown")]
    write(land, "2.json", envelope("a", record("a1", 1), record("a2", 2)), envelope("b", record("b1", 1)))
    expected = [("a1", "Completed"), ("a2", "Completed"), ("b1", "Completed")]
    assert run() == expected
    assert run() == expected
