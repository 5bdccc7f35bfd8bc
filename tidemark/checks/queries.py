"""One registered query per operator; each takes a session and the folder of the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark import schemas
from tidemark.checks import adapters as a
from tidemark.functions import headers, instants, payloads
from tidemark.operators import incremental, merge, overlap, ranking, registry, transform, triage
from tidemark.plans import alerts, pipelines, reports, rollups
from tidemark.session import pin_settings, scratch_path, small_side
from tidemark.sinks import files, tables
from tidemark.sources import config, landing, tables as stored
from tidemark.streaming.pages import ingest_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TREND_DATASET = "dataset 7"
TODAY_AFTER_LOAD = date(2024, 2, 5)
EXPORT_START, EXPORT_END = date(2023, 12, 20), date(2024, 1, 29)


def register(query: Query) -> Query:
    """Enter a query under its function name, with the session settings it relies on."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pin_settings(spark)
        return query(spark, sf_dir)

    QUERIES[query.__name__] = run
    return run


def map_text(entries: Column) -> Column:
    """A map as sorted ``key=value`` text, for comparison with SQL."""
    pairs = F.transform(F.map_entries(entries), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return F.array_join(F.array_sort(pairs), ";")


def quoted_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events whose report names hold quotes, commas and line breaks."""
    name = F.concat(F.lit('a "'), F.col("report_name"), F.lit('",\nb'))
    return a.activity_events(spark, sf).withColumn("report_name", name)


def scratch_table(spark: SparkSession, spec: tables.TableSpec) -> str:
    """A new, empty table under the shared folder."""
    name = f"tidemark_{uuid.uuid4().hex}"
    tables.create_table(spark, name, spec, scratch_path(spark, name))
    return name


def stored_form(events: DataFrame) -> DataFrame:
    """Events with all columns of the stored table."""
    stamps = {"ingestion_timestamp": F.lit(a.RUN_AT), "ingestion_date": F.lit(a.RUN_AT.date())}
    fields = tables.ACTIVITY_TABLE.schema.fields
    return events.select(*[(F.col(f.name) if f.name in events.columns else stamps.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in fields])


# Sources


@register
def src_refresh_envelope(spark, sf):
    return landing.refresh_records(spark, a.land_refresh(spark, sf)).drop("source_file")


@register
def src_top_n_per_dataset(spark, sf):
    records = a.raw_refresh(spark, sf)
    start = instants.parse_instant(F.col("startTime"))
    return landing.newest_per_dataset(records, start, F.col("requestId"), 60).select("dataset_id", "requestId", "startTime")


@register
def src_dataset_listing(spark, sf):
    return landing.dataset_listing(spark, a.land_listing(spark, sf)).drop("item_pos")


@register
def src_workspace_listing(spark, sf):
    return landing.workspace_listing(spark, a.land_workspaces(spark, sf))


@register
def src_activity_pages(spark, sf):
    pages = landing.follow_continuation(landing.activity_pages(spark, a.land_activity(spark, sf)))
    events = landing.page_events(pages)
    return events.select("fetch_day", payloads.event_fields(F.col("raw"))["Id"].alias("event_id"))


@register
def src_activity_pages_streamed(spark, sf):
    name = scratch_table(spark, tables.ACTIVITY_TABLE)
    ingest_pages(spark, a.land_activity(spark, sf), name, scratch_path(spark, "pages-progress"), first_page=None)
    return spark.table(name).select("event_id", "creation_date")


@register
def src_probe_payload_rows(spark, sf):
    return landing.probe_row_counts(a.probe_responses(spark, sf)).select("event_id", "row_count")


@register
def src_config_registry(spark, sf):
    return config.explicit_datasets(spark, a.land_config(spark, sf), multi_line=False).drop("source_file", "pos")


@register
def src_typed_rows(spark, sf):
    rows = a.raw_refresh(spark, sf).select(
        F.col("requestId").alias("request_id"),
        "dataset_id",
        "workspace_id",
        F.col("startTime").alias("start_time"),
        F.col("endTime").alias("end_time"),
        F.expr("CASE WHEN k % 9 = 0 THEN 'many' ELSE cast(k AS string) END").alias("attempt_count"),
        F.expr("CASE WHEN user_id % 3 = 0 THEN 'true' ELSE 'false' END").alias("is_critical"),
    )
    typed = stored.typed_rows(rows, schemas.REFRESH_HISTORY)
    return typed.select(*rows.columns, "duration_seconds")


@register
def src_table_scan(spark, sf):
    name = scratch_table(spark, tables.REFRESH_TABLE)
    tables.append(spark, name, a.refresh_history(spark, sf), tables.REFRESH_TABLE)
    return stored.scan_table(spark, name)


@register
def src_csv_history(spark, sf):
    path = scratch_path(spark, "csv")
    files.append_monthly_csv(quoted_events(spark, sf), path)
    return stored.csv_known_ids(spark, path)


# Fetch-log triage


@register
def triage_fetch_status(spark, sf):
    return triage.with_outcome(a.response_log(spark, sf)).select("seq", "kind", "status", "outcome")


@register
def triage_retryable(spark, sf):
    log = a.response_log(spark, sf)
    return log.select("seq", headers.retryable(F.col("status"), F.col("method")).alias("retryable"))


@register
def triage_rate_headers(spark, sf):
    log = a.response_log(spark, sf)
    return log.select("seq", map_text(headers.quota_headers(F.col("headers"))).alias("quota_headers"))


@register
def triage_retry_after(spark, sf):
    log = a.response_log(spark, sf)
    return log.select("seq", headers.retry_after_seconds(F.col("headers")).alias("retry_after_seconds"))


@register
def triage_throttle_cutoff(spark, sf):
    late = F.col("day") >= F.lit(date(2024, 1, 17))
    log = a.response_log(spark, sf).withColumn("status", F.when(late | (F.col("status") != 429), F.col("status")))
    return triage.before_throttling(log).select("seq", "day")


@register
def triage_take_while(spark, sf):
    return triage.until_first_stop(a.response_log(spark, sf)).select("endpoint", "seq", "status")


@register
def triage_endpoint_stats(spark, sf):
    stats = triage.endpoint_stats(a.response_log(spark, sf))
    return stats.drop("status_counts").withColumn("rate_limit_headers", map_text(F.col("rate_limit_headers")))


@register
def triage_status_counts(spark, sf):
    counts = triage.status_counts(a.response_log(spark, sf))
    return counts.select("endpoint", map_text(F.col("status_counts")).alias("status_counts"))


@register
def triage_run_stats(spark, sf):
    refresh = a.refresh_history(spark, sf)
    new = refresh.filter(F.col("start_time") >= incremental.as_instant(date(2024, 1, 30)))
    failed = triage.with_outcome(a.response_log(spark, sf)).filter(
        (F.col("outcome") == triage.FAILED) & (F.col("day") == F.lit(a.AS_OF))
    )
    return triage.run_stats(a.registry(spark, sf), new, failed)


@register
def triage_day_counts(spark, sf):
    known = a.activity_source(spark, sf)
    return triage.day_counts(a.raw_events(spark, sf), known, ["viewreport", "EditReport"])


# Projections


@register
def tr_duration_seconds(spark, sf):
    raw = a.raw_refresh(spark, sf)
    return raw.select("requestId", instants.duration_seconds(F.col("startTime"), F.col("endTime")).alias("duration_seconds"))


@register
def tr_error_code(spark, sf):
    raw = a.raw_refresh(spark, sf)
    return payloads.with_error_code(raw, "serviceExceptionJson").select("requestId", "error_code")


@register
def tr_refresh_records(spark, sf):
    records = registry.enrich(a.raw_refresh(spark, sf), small_side(a.registry(spark, sf)))
    return transform.refresh_rows(records, a.RUN_AT)


@register
def tr_attempts(spark, sf):
    attempts = F.col("refreshAttempts")
    return a.raw_refresh(spark, sf).select(
        "requestId",
        payloads.attempts_json(attempts).alias("refresh_attempts_json"),
        payloads.attempt_count(attempts).alias("attempt_count"),
    )


@register
def tr_coalesce_casing(spark, sf):
    fields = F.col("fields")
    return transform.parsed_events(a.raw_events(spark, sf)).select(
        fields["Id"].alias("id"),
        payloads.first_of(fields, "WorkspaceId", "WorkSpaceId").alias("workspace_id"),
        payloads.first_of(fields, "WorkspaceName", "WorkSpaceName").alias("workspace_name"),
    )


@register
def tr_activity_date(spark, sf):
    text = F.expr(
        "CASE k % 13 WHEN 0 THEN 'not-a-date' WHEN 1 THEN date_format(ts, \"yyyyMMdd'T'HHmmss'Z'\") "
        "WHEN 2 THEN concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), '+02:00') "
        "ELSE date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\") END"
    )
    return a.events(spark, sf).select("event_id", instants.activity_date(text).alias("creation_date"))


@register
def tr_activity_events(spark, sf):
    return transform.activity_rows(a.raw_events(spark, sf), a.RUN_AT)


@register
def tr_ingestion_stamp(spark, sf):
    return transform.with_ingestion_stamp(a.raw_refresh(spark, sf).select("requestId"), a.RUN_AT)


@register
def tr_probe_record(spark, sf):
    return transform.probe_rows(a.probe_responses(spark, sf))


@register
def tr_probe_duration_ms(spark, sf):
    trip = instants.round_trip_ms(F.col("sent_at"), F.col("received_at"))
    return a.probe_responses(spark, sf).select("event_id", trip.alias("duration_ms"))


@register
def tr_day_bounds(spark, sf):
    return incremental.with_bounds(a.events(spark, sf).select(F.to_date("ts").alias("day")).distinct())


@register
def tr_month_bucket(spark, sf):
    return a.events(spark, sf).select("event_id", instants.month_bucket(F.col("ts")).alias("file_key"))


@register
def tr_alert_card(spark, sf):
    failed = alerts.refresh_failures(a.refresh_history(spark, sf), a.AS_OF, a.AS_OF_TS)
    return alerts.with_cards(failed).select("dataset_name", "message", F.col("details")["start_time"].alias("start_time"), "card")


# Filters


@register
def flt_watermark(spark, sf):
    loaded = a.refresh_history(spark, sf).filter(F.col("start_time") < incremental.as_instant(date(2024, 1, 20)))
    marks = incremental.watermarks(loaded.filter(F.col("is_critical")))
    records = a.raw_refresh(spark, sf).withColumn(
        "startTime", F.expr("CASE k % 17 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'soon' ELSE startTime END")
    )
    start = instants.parse_instant(F.col("startTime"))
    kept = incremental.newer_than_watermark(records, small_side(marks), start)
    return kept.select("dataset_id", "requestId", "startTime")


@register
def flt_require_id(spark, sf):
    records = a.raw_refresh(spark, sf).withColumn(
        "requestId", F.expr("CASE k % 10 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE requestId END")
    )
    return transform.require_id(records, "requestId").select("event_id", "requestId")


@register
def flt_tracked_activities(spark, sf):
    events = a.activity_events(spark, sf).withColumn(
        "activity", F.when(F.substring("event_id", -1, 1) != "0", F.col("activity"))
    )
    return transform.keep_tracked(events, ["viewreport", "EDITREPORT"]).select("event_id", "activity")


@register
def flt_active(spark, sf):
    return registry.active_only(a.explicit_entries(spark, sf)).select("dataset_id", "dataset_name", "is_active")


@register
def flt_exclude_list(spark, sf):
    return registry.discovered_datasets(a.workspace_entries(spark, sf), a.listing(spark, sf)).select(
        "dataset_id", "dataset_name", "workspace_id", "is_critical"
    )


# Joins and merges


@register
def join_registry_resolve(spark, sf):
    return registry.resolve(a.explicit_entries(spark, sf), a.workspace_entries(spark, sf), a.listing(spark, sf))


@register
def join_registry_enrich(spark, sf):
    records = registry.enrich(a.raw_refresh(spark, sf), small_side(a.registry(spark, sf)))
    return records.select("requestId", *registry.REGISTRY_COLUMNS[:5])


@register
def join_watermark_lookup(spark, sf):
    marks = incremental.watermarks(a.refresh_history(spark, sf).filter(F.col("is_critical")))
    return incremental.with_watermark(a.raw_refresh(spark, sf), small_side(marks)).select("requestId", "dataset_id", "watermark")


@register
def join_latest_semi(spark, sf):
    latest = ranking.latest_rows(a.refresh_history(spark, sf), "dataset_id", "start_time")
    return latest.select("dataset_id", "request_id", "start_time", "status")


@register
def join_week_self(spark, sf):
    means = reports.weekly_means(a.refresh_history(spark, sf), a.AS_OF)
    return means.select(
        "dataset_name",
        F.round("last_week_mean", 6).alias("last_week_mean"),
        F.round("this_week_mean", 6).alias("this_week_mean"),
    )


@register
def join_interval_overlap(spark, sf):
    completed = a.refresh_history(spark, sf).filter(F.col("status") == "Completed")
    pairs = overlap.overlapping_pairs(completed, "request_id", "start_time", "end_time", ["dataset_id"])
    return pairs.select(
        F.col("a.id").alias("a_id"),
        F.col("b.id").alias("b_id"),
        F.col("a.dataset_id").alias("a_dataset"),
        F.col("b.dataset_id").alias("b_dataset"),
    )


@register
def join_anti_known_ids(spark, sf):
    known = a.activity_source(spark, sf).select("event_id")
    return files.new_for_export(a.activity_events(spark, sf), known)


@register
def merge_refresh(spark, sf):
    return merge.merge_refresh(a.refresh_history(spark, sf), a.refresh_source(spark, sf))


@register
def merge_events(spark, sf):
    return merge.merge_events(a.activity_events(spark, sf), a.activity_source(spark, sf))


# Aggregations that feed the pipelines


@register
def agg_watermarks(spark, sf):
    return incremental.watermarks(a.refresh_history(spark, sf))


@register
def agg_max_activity_date(spark, sf):
    return incremental.max_activity_date(a.activity_events(spark, sf))


@register
def agg_watermarks_kept(spark, sf):
    name = scratch_table(spark, tables.REFRESH_TABLE)
    tables.create_watermarks(spark, name)
    tables.append(spark, name, a.refresh_history(spark, sf), tables.REFRESH_TABLE)
    tables.commit_refresh(spark, name, a.refresh_source(spark, sf))
    return tables.watermarks(spark, name)


@register
def agg_max_activity_date_listed(spark, sf):
    name = scratch_table(spark, tables.ACTIVITY_TABLE)
    tables.append(spark, name, stored_form(a.activity_events(spark, sf)), tables.ACTIVITY_TABLE)
    return tables.max_activity_date(spark, name)


@register
def agg_dedup_events(spark, sf):
    return merge.one_per_event(a.activity_copies(spark, sf))


@register
def agg_midpoint_watermark(spark, sf):
    return incremental.midpoint_watermarks(a.refresh_history(spark, sf))


@register
def agg_probe_summary(spark, sf):
    return pipelines.probe_summary(a.query_performance(spark, sf))


@register
def agg_file_summary(spark, sf):
    path = scratch_path(spark, "csv")
    files.append_monthly_csv(quoted_events(spark, sf), path)
    key = F.regexp_extract("file_path", "activity_events_[0-9]{4}_[0-9]{2}", 0)
    return files.file_summary(spark, path).groupBy(key.alias("file_key")).agg(
        F.sum("n_rows").alias("n_rows"), (F.min("size_kb") > 0).alias("has_size")
    )


# Reports


@register
def rpt_latest_status(spark, sf):
    return reports.latest_status(a.refresh_history(spark, sf))


@register
def rpt_daily_status_counts(spark, sf):
    return reports.daily_status_counts(a.refresh_history(spark, sf), a.AS_OF)


@register
def rpt_avg_duration(spark, sf):
    return reports.average_duration(a.refresh_history(spark, sf), a.AS_OF)


@register
def rpt_duration_trend(spark, sf):
    return reports.duration_trend(a.refresh_history(spark, sf), TREND_DATASET, a.AS_OF)


@register
def rpt_failures(spark, sf):
    return reports.failures(a.refresh_history(spark, sf), a.AS_OF)


@register
def rpt_freshness(spark, sf):
    return reports.freshness(a.refresh_history(spark, sf), a.AS_OF_TS)


@register
def rpt_week_over_week(spark, sf):
    return reports.week_over_week(a.refresh_history(spark, sf), a.AS_OF)


@register
def rpt_overlap(spark, sf):
    return reports.overlapping_refreshes(a.refresh_history(spark, sf), a.AS_OF)


@register
def rpt_most_viewed(spark, sf):
    return reports.most_viewed(a.activity_events(spark, sf), a.AS_OF)


@register
def rpt_most_viewed_top10(spark, sf):
    return reports.most_viewed(a.activity_events(spark, sf), a.AS_OF, top=10)


@register
def rpt_least_viewed(spark, sf):
    return reports.least_viewed(a.activity_events(spark, sf), a.AS_OF)


@register
def rpt_daily_views(spark, sf):
    return reports.daily_views(a.activity_events(spark, sf))


@register
def rpt_top_users(spark, sf):
    return reports.top_users(a.activity_events(spark, sf), a.AS_OF)


def rolled_up(spark: SparkSession, sf: str) -> rollups.Rollups:
    """Roll-ups of all events, made in two runs of which the second brings late events for days of the first."""
    found = rollups.Rollups(spark, scratch_path(spark, "rollups"))
    events = a.activity_events(spark, sf)
    found.roll_up(events.filter(F.xxhash64("event_id") % 2 == 0))
    found.roll_up(events)
    return found


@register
def rpt_daily_views_rolled(spark, sf):
    return rollups.daily_views(rolled_up(spark, sf))


@register
def rpt_most_viewed_rolled(spark, sf):
    return rollups.most_viewed(rolled_up(spark, sf), a.AS_OF)


@register
def rpt_top_users_rolled(spark, sf):
    return rollups.top_users(rolled_up(spark, sf), a.AS_OF)


# Alerts

ALERT_COLUMNS = ["severity", "alert_type", "dataset_name", "workspace_name", "message", "alert_time"]


def _detail(name: str, kind: str = "string") -> Column:
    value = F.col("details")[name].cast(kind)
    return (F.round(value, 6) if kind == "double" else value).alias(name)


@register
def alert_failures(spark, sf):
    found = alerts.refresh_failures(a.refresh_history(spark, sf), a.AS_OF, a.AS_OF_TS)
    return found.select(*ALERT_COLUMNS, _detail("error_code"), _detail("service_exception"), _detail("start_time"))


@register
def alert_duration_anomaly(spark, sf):
    found = alerts.duration_anomalies(a.refresh_history(spark, sf), a.AS_OF, a.AS_OF_TS)
    return found.select(
        *ALERT_COLUMNS,
        _detail("duration_seconds", "double"),
        _detail("rolling_avg_seconds", "double"),
        _detail("ratio", "double"),
    )


@register
def alert_stale(spark, sf):
    found = alerts.stale_data(a.refresh_history(spark, sf), a.AS_OF_TS)
    return found.select(*ALERT_COLUMNS, _detail("hours_since_refresh"), _detail("last_successful_refresh"))


@register
def alert_union(spark, sf):
    return alerts.all_alerts(a.refresh_history(spark, sf), a.AS_OF, a.AS_OF_TS).drop("details")


@register
def alert_route(spark, sf):
    routed = alerts.routed(alerts.all_alerts(a.refresh_history(spark, sf), a.AS_OF, a.AS_OF_TS), True, critical_only=True)
    return routed.select("log_level", "channel", alerts.log_line(F.col("severity")).alias("line"))


# Incremental windows


@register
def inc_dates_to_fetch(spark, sf):
    loaded = incremental.max_activity_date(a.activity_events(spark, sf))
    return incremental.dates_to_fetch(loaded, 28, TODAY_AFTER_LOAD, retention_days=28)


@register
def inc_limit_backfill(spark, sf):
    days = a.activity_events(spark, sf).select(F.col("creation_date").alias("day")).distinct()
    return incremental.limit_backfill(days, 7)


@register
def inc_late_day_reload(spark, sf):
    arrived = a.activity_events(spark, sf)
    late = (F.col("creation_date") >= F.lit(date(2024, 1, 25))) & F.col("event_id").endswith("7")
    target = arrived.filter(~late)
    days = incremental.dates_to_fetch(incremental.max_activity_date(target), 28, a.AS_OF + timedelta(days=1))
    reload = incremental.only_days(
        arrived, days.select(F.col("day").alias("creation_date")), "creation_date"
    )
    return merge.merge_events(target, reload)


@register
def inc_csv_range(spark, sf):
    days = incremental.export_range(spark, a.AS_OF, start=EXPORT_START, end=EXPORT_END)
    counts = a.activity_events(spark, sf).groupBy(F.col("creation_date").alias("day")).agg(F.count(F.lit(1)).alias("n_events"))
    return days.join(counts, "day", "left").na.fill(0, ["n_events"])


# Sinks


@register
def sink_create_table(spark, sf):
    name = scratch_table(spark, tables.ACTIVITY_TABLE)
    tables.create_table(spark, name, tables.ACTIVITY_TABLE)
    rows = transform.activity_rows(a.raw_events(spark, sf), a.RUN_AT)
    tables.append(spark, name, rows, tables.ACTIVITY_TABLE)
    return spark.table(name)


@register
def sink_append(spark, sf):
    name = scratch_table(spark, tables.PROBE_TABLE)
    rows = a.query_performance(spark, sf)
    tables.append_probes(spark, name, rows)
    tables.append_probes(spark, name, rows.limit(0))
    return spark.table(name)


@register
def sink_merge_commit(spark, sf):
    name = scratch_table(spark, tables.REFRESH_TABLE)
    tables.append(spark, name, a.refresh_history(spark, sf), tables.REFRESH_TABLE)
    for _ in range(2):
        tables.commit_refresh(spark, name, a.refresh_source(spark, sf))
    return spark.table(name)


@register
def sink_merge_indexed(spark, sf):
    name = scratch_table(spark, tables.ACTIVITY_TABLE)
    events = a.activity_events(spark, sf)
    tables.append(spark, name, stored_form(events), tables.ACTIVITY_TABLE)
    tables.create_id_index(spark, name, tables.ACTIVITY_TABLE, buckets=64)
    for _ in range(2):
        tables.commit_events(spark, name, stored_form(a.activity_source(spark, sf)))
    return spark.table(name).select(events.columns)


@register
def sink_merge_bucketed(spark, sf):
    name = f"tidemark_{uuid.uuid4().hex}"
    history = a.refresh_history(spark, sf)
    tables.create_table(spark, name, tables.REFRESH_TABLE, scratch_path(spark, name), buckets=4, rows=history.count())
    tables.append(spark, name, history, tables.REFRESH_TABLE)
    for _ in range(2):
        tables.commit_refresh(spark, name, a.refresh_source(spark, sf))
    return spark.table(name)


@register
def sink_csv_monthly(spark, sf):
    path = scratch_path(spark, "csv")
    for _ in range(2):
        files.append_monthly_csv(quoted_events(spark, sf), path)
    text = spark.read.options(**stored.CSV_READ).csv(path)
    return text.select("event_id", "activity", "user_id", "report_name", "creation_date", files.FILE_KEY)


@register
def sink_json_report(spark, sf):
    path = scratch_path(spark, "report")
    stats = triage.endpoint_stats(a.response_log(spark, sf))
    files.write_json_report(stats, path, a.AS_OF_TS, {"max_requests": "all"})
    report = spark.read.schema(
        "endpoint string, requests_made long, first_429_at_request long, avg_latency_ms double, "
        "status_counts map<string,long>, settings map<string,string>"
    ).json(path)
    return report.select(
        "endpoint",
        "requests_made",
        "first_429_at_request",
        "avg_latency_ms",
        map_text(F.col("status_counts")).alias("status_counts"),
        F.col("settings")["max_requests"].alias("max_requests"),
    )


@register
def sink_alerts(spark, sf):
    path = scratch_path(spark, "alerts")
    tables.append_alerts(alerts.all_alerts(a.refresh_history(spark, sf), a.AS_OF, a.AS_OF_TS), path)
    return spark.read.parquet(path).drop("details")
