"""The ``events`` test table in the shapes the operators take."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.instants import seconds_between
from tidemark.functions.payloads import with_error_code
from tidemark.session import scratch_path

AS_OF = date(2024, 1, 30)
AS_OF_TS = datetime(2024, 1, 31)
RUN_AT = datetime(2024, 1, 31)
PAGE_SIZE = 50
GROUP_SIZE = 50

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ATTEMPTS = (
    "CASE k % 3 WHEN 1 THEN '[{\"attemptId\":1,\"type\":\"Data\"}]' "
    "WHEN 2 THEN '[{\"attemptId\":1,\"type\":\"Data\"},{\"attemptId\":2,\"type\":\"Query\"}]' END"
)
EXCEPTION = (
    "CASE WHEN event_type <> 'error' THEN NULL WHEN k % 10 = 0 THEN 'not-json{' "
    "WHEN k % 10 = 1 THEN '{\"message\":\"x\"}' "
    "ELSE concat('{\"errorCode\":\"E', cast(k % 5 AS string), '\"}') END"
)
ACTIVITY = (
    "CASE event_type WHEN 'view' THEN 'ViewReport' WHEN 'click' THEN 'ViewDashboard' "
    "WHEN 'purchase' THEN 'CreateReport' WHEN 'signup' THEN 'EditReport' ELSE 'DeleteReport' END"
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table with a timestamp instead of a local time, and ``k`` taken out of ``props``."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        "value",
        F.regexp_extract("props", r'"k":\s*(\d+)', 1).cast("int").alias("k"),
    )


def _refresh_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(
        "event_id",
        "user_id",
        "k",
        "concat('r-', lpad(cast(event_id AS string), 9, '0')) AS request_id",
        "concat('ds-', cast(user_id AS string)) AS dataset_id",
        "concat('dataset ', cast(user_id AS string)) AS dataset_name",
        "concat('ws-', cast(user_id % 5 AS string)) AS workspace_id",
        "concat('workspace ', cast(user_id % 5 AS string)) AS workspace_name",
        "CASE WHEN k % 4 = 0 THEN 'ViaApi' WHEN k % 4 = 1 THEN 'OnDemand' ELSE 'Scheduled' END AS refresh_type",
        "CASE event_type WHEN 'error' THEN 'Failed' WHEN 'signup' THEN 'Unknown' ELSE 'Completed' END AS status",
        "ts AS start_time",
        "CASE WHEN event_type <> 'signup' THEN "
        "timestampadd(MICROSECOND, cast(round(value * 1000000) AS bigint), ts) END AS end_time",
        f"{EXCEPTION} AS service_exception_json",
        f"{ATTEMPTS} AS refresh_attempts_json",
        "k % 3 AS attempt_count",
        "user_id % 3 = 0 AS is_critical",
        "cast(ts AS date) AS ingestion_date",
    )


def refresh_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored refresh rows, ingested on the day they started."""
    return with_error_code(_refresh_base(spark, sf_dir), "service_exception_json").select(
        "request_id",
        "dataset_id",
        "dataset_name",
        "workspace_id",
        "workspace_name",
        "refresh_type",
        "status",
        "start_time",
        "end_time",
        seconds_between(F.col("start_time"), F.col("end_time")).alias("duration_seconds"),
        "service_exception_json",
        "error_code",
        "refresh_attempts_json",
        "attempt_count",
        "is_critical",
        F.col("ingestion_date").cast("timestamp").alias("ingestion_timestamp"),
        "ingestion_date",
    )


def refresh_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch to merge: every event once more under twice its id, so about half of the requests
    are stored already, each with an older copy that is still running."""
    base = _refresh_base(spark, sf_dir).withColumn(
        "request_id", F.expr("concat('r-', lpad(cast(event_id * 2 AS string), 9, '0'))")
    )
    latest = base.withColumn("status", F.expr("CASE k % 4 WHEN 0 THEN 'Unknown' WHEN 1 THEN NULL ELSE status END"))
    latest = latest.withColumn("ingestion_timestamp", F.lit(RUN_AT).cast("timestamp"))
    older = base.withColumn("status", F.lit("Unknown")).withColumn("end_time", F.lit(None).cast("timestamp"))
    older = older.withColumn("ingestion_timestamp", F.lit(RUN_AT).cast("timestamp") - F.expr("interval 1 day"))
    both = with_error_code(latest.unionByName(older), "service_exception_json")
    return (
        both.withColumn("ingestion_date", F.lit(RUN_AT.date()))
        .withColumn("duration_seconds", seconds_between(F.col("start_time"), F.col("end_time")))
        .select(refresh_history(spark, sf_dir).columns)
    )


def raw_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed refresh records with their dataset, all fields as text."""
    base = _refresh_base(spark, sf_dir)
    return base.select(
        "event_id",
        "k",
        "user_id",
        "workspace_id",
        "dataset_id",
        F.col("request_id").alias("requestId"),
        F.col("refresh_type").alias("refreshType"),
        F.date_format("start_time", ISO).alias("startTime"),
        F.date_format("end_time", ISO).alias("endTime"),
        "status",
        F.col("service_exception_json").alias("serviceExceptionJson"),
        F.col("refresh_attempts_json").alias("refreshAttempts"),
    )


RAW_FIELDS = ["requestId", "refreshType", "startTime", "endTime", "status", "serviceExceptionJson"]


def land_refresh(spark: SparkSession, sf_dir: str) -> str:
    """Write the records as envelopes of one dataset and at most ``PAGE_SIZE`` records each."""
    attempts = F.from_json("refreshAttempts", "array<struct<attemptId:int,type:string>>").alias("refreshAttempts")
    envelopes = (
        raw_refresh(spark, sf_dir)
        .withColumn("part", F.expr(f"event_id div {PAGE_SIZE}"))
        .groupBy("workspace_id", "dataset_id", "part")
        .agg(F.collect_list(F.struct(*RAW_FIELDS, attempts)).alias("value"))
        .select(F.to_json(F.struct("workspace_id", "dataset_id", "value")).alias("line"))
    )
    path = scratch_path(spark, "refresh-envelopes")
    cut_off = spark.range(1).select(F.lit('{"workspace_id":"ws-0","dataset_id":"ds-0","value":[{"requ').alias("line"))
    envelopes.unionByName(cut_off).write.text(path)
    return path


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed audit events as JSON text; odd ids use the other spelling of the workspace fields."""
    odd = F.expr("event_id % 2 = 1")
    workspace_id = F.expr("concat('ws-', cast(user_id % 5 AS string))")
    workspace_name = F.expr("concat('workspace ', cast(user_id % 5 AS string))")
    text = F.to_json(
        F.struct(
            F.expr("concat('e-', cast(event_id AS string))").alias("Id"),
            F.date_format("ts", ISO).alias("CreationTime"),
            F.expr(ACTIVITY).alias("Activity"),
            F.expr(
                "CASE WHEN user_id % 29 <> 0 THEN concat('user', cast(user_id AS string), '@example.com') END"
            ).alias("UserId"),
            F.when(~odd, workspace_id).alias("WorkspaceId"),
            F.when(odd, workspace_id).alias("WorkSpaceId"),
            F.when(~odd, workspace_name).alias("WorkspaceName"),
            F.when(odd, workspace_name).alias("WorkSpaceName"),
            F.expr("concat('rpt-', cast(k AS string))").alias("ReportId"),
            F.expr("CASE WHEN k % 11 <> 0 THEN concat('report ', cast(k AS string)) END").alias("ReportName"),
            F.expr("CASE WHEN k % 2 = 0 THEN 'Succeeded' ELSE 'Failed' END").alias("ResultStatus"),
        )
    )
    return events(spark, sf_dir).select(
        "event_id", "k", "user_id", F.to_date("ts").alias("fetch_day"), text.alias("raw")
    )


def land_activity(spark: SparkSession, sf_dir: str) -> str:
    """Write the events as pages of one day. A chain ends on the last page of its day, and early
    on every seventh page, whose continuation address is missing."""
    paged = raw_events(spark, sf_dir).withColumn("page_no", F.expr(f"event_id div {PAGE_SIZE}"))
    pages = paged.groupBy("fetch_day", "page_no").agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("raw"), ","), F.lit("]")).alias("entities")
    )
    last = pages.groupBy("fetch_day").agg(F.max("page_no").alias("last_page"))
    line = F.concat(
        F.lit('{"page_no":'),
        F.col("page_no").cast("string"),
        F.lit(',"activityEventEntities":'),
        F.col("entities"),
        F.when(F.col("page_no") == F.col("last_page"), '}')
        .when(F.col("page_no") % 7 == 6, ',"continuationToken":"t","continuationUri":null}')
        .otherwise(',"continuationToken":"t","continuationUri":"u"}'),
    )
    path = scratch_path(spark, "activity-pages")
    landed = pages.join(last, "fetch_day").select(F.col("fetch_day").alias("day"), line.alias("line"))
    cut_off = last.agg(F.min("fetch_day").alias("day")).select("day", F.lit('{"page_no":1,"activ').alias("line"))
    (
        landed.unionByName(cut_off)
        .write.partitionBy("day")
        .text(path)
    )
    return path


def activity_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored audit events; the columns the reports read."""
    return events(spark, sf_dir).selectExpr(
        "concat('e-', cast(event_id AS string)) AS event_id",
        "ts AS creation_time",
        "cast(ts AS date) AS creation_date",
        f"{ACTIVITY} AS activity",
        "CASE WHEN user_id % 29 <> 0 THEN concat('user', cast(user_id AS string), '@example.com') END AS user_id",
        "concat('ws-', cast(user_id % 5 AS string)) AS workspace_id",
        "concat('workspace ', cast(user_id % 5 AS string)) AS workspace_name",
        "concat('rpt-', cast(k AS string)) AS report_id",
        "CASE WHEN k % 11 <> 0 THEN concat('report ', cast(k AS string)) END AS report_name",
    )


def activity_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch to merge: every event under twice its id, and a later copy of it."""
    number = F.substring("event_id", 3, 20).cast("bigint") * 2
    moved = activity_events(spark, sf_dir).withColumn("event_id", F.concat(F.lit("e-"), number.cast("string")))
    later = moved.withColumn("creation_time", F.col("creation_time") + F.expr("interval 1 hour"))
    return moved.unionByName(later)


def activity_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with copies: three neighbours share an id."""
    number = F.floor(F.substring("event_id", 3, 20).cast("bigint") / 3)
    return activity_events(spark, sf_dir).withColumn("event_id", F.concat(F.lit("e-"), number.cast("string")))


def query_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored probe measurements."""
    return events(spark, sf_dir).selectExpr(
        "concat('p-', cast(event_id AS string)) AS probe_id",
        "concat('ws-', cast(user_id % 5 AS string)) AS workspace_id",
        "concat('workspace ', cast(user_id % 5 AS string)) AS workspace_name",
        "concat('ds-', cast(user_id AS string)) AS dataset_id",
        "concat('dataset ', cast(user_id AS string)) AS dataset_name",
        "event_type AS query_label",
        "CASE WHEN k % 10 = 0 THEN 'Failed' ELSE 'Success' END AS status",
        "CASE WHEN k % 10 <> 0 THEN value END AS duration_ms",
        "CASE WHEN k % 10 <> 0 THEN k END AS row_count",
        "CASE WHEN k % 10 = 0 THEN 'HTTP 403' END AS error_message",
        "user_id % 3 = 0 AS is_critical",
        "ts AS probe_timestamp",
        "cast(ts AS date) AS probe_date",
    )


def probe_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logged probe responses: denied, broken off or answered with ``k`` rows or no table at all."""
    payload = (
        "CASE k % 7 WHEN 0 THEN '{}' WHEN 1 THEN '{\"results\":[]}' WHEN 2 THEN '{\"results\":[{}]}' "
        "WHEN 3 THEN 'not-json' ELSE concat('{\"results\":[{\"tables\":[{\"rows\":[', "
        "repeat('{\"x\":1},', k - 1), '{\"x\":1}]}]}]}') END"
    )
    return events(spark, sf_dir).selectExpr(
        "event_id",
        "concat('ws-', cast(user_id % 5 AS string)) AS workspace_id",
        "concat('workspace ', cast(user_id % 5 AS string)) AS workspace_name",
        "concat('ds-', cast(user_id AS string)) AS dataset_id",
        "concat('dataset ', cast(user_id AS string)) AS dataset_name",
        "event_type AS query_label",
        "CASE WHEN k % 10 = 0 THEN 403 WHEN k % 10 = 1 THEN NULL ELSE 200 END AS http_status",
        "CASE WHEN k % 10 = 1 THEN repeat('x', 400 + k * 2) END AS error",
        f"{payload} AS payload",
        "CASE WHEN user_id % 3 = 0 THEN true WHEN user_id % 3 = 1 THEN false END AS is_critical",
        "ts AS sent_at",
        "timestampadd(MICROSECOND, cast(round(value * 1000) AS bigint), ts) AS received_at",
    )


def response_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API responses; one endpoint per event type and user, in order of event id."""
    log = events(spark, sf_dir).selectExpr(
        "concat(event_type, '/', cast(user_id AS string)) AS endpoint",
        "CASE event_type WHEN 'view' THEN 'dataset' WHEN 'click' THEN 'workspace' ELSE 'activity' END AS kind",
        "concat('ds-', cast(user_id AS string)) AS dataset_id",
        "cast(ts AS date) AS day",
        "event_id AS seq",
        "CASE k WHEN 99 THEN 429 WHEN 98 THEN 403 WHEN 97 THEN 500 WHEN 96 THEN NULL "
        "WHEN 95 THEN 404 WHEN 94 THEN 401 ELSE 200 END AS status",
        "value AS latency_ms",
        "concat('body ', cast(k AS string)) AS body",
        "CASE WHEN k = 96 THEN 'timed out' END AS error",
        "CASE WHEN event_id % 3 = 0 THEN 'POST' ELSE 'GET' END AS method",
    )
    wait = F.when(F.expr("seq % 2 = 0"), F.expr("cast(seq % 600 AS string)")).otherwise(
        "Wed, 31 Jan 2024 00:00:00 GMT"
    )
    throttled = F.create_map(
        F.lit("Content-Type"), F.lit("text/plain"),
        F.lit("Retry-After"), wait,
        F.lit("RateLimit-Remaining"), F.lit("0"),
        F.lit("x-ms-throttle-scope"), F.lit("tenant"),
    )
    usual = F.create_map(
        F.lit("Content-Type"), F.lit("application/json"),
        F.lit("X-RateLimit-Limit"), F.lit("200"),
    )
    return log.withColumn("headers", F.when(F.col("status") == 429, throttled).otherwise(usual))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user: the datasets of the registry."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id").distinct()


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolved registry: every user is a dataset."""
    return users(spark, sf_dir).selectExpr(
        "concat('ds-', cast(user_id AS string)) AS dataset_id",
        "concat('dataset ', cast(user_id AS string)) AS dataset_name",
        "concat('ws-', cast(user_id % 5 AS string)) AS workspace_id",
        "concat('workspace ', cast(user_id % 5 AS string)) AS workspace_name",
        "user_id % 3 = 0 AS is_critical",
        "true AS is_active",
    )


def explicit_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two explicit registry entries per user, of which the later counts; a quarter is active."""
    return (
        users(spark, sf_dir)
        .withColumn("version", F.explode(F.array(F.lit(0), F.lit(1))))
        .selectExpr(
            "user_id * 2 + version AS pos",
            "concat('w-', cast(user_id div 50 AS string)) AS workspace_id",
            "concat('workspace ', cast(user_id div 50 AS string)) AS workspace_name",
            "concat('ds-', cast(user_id AS string)) AS dataset_id",
            "concat('explicit ', cast(user_id AS string), ' v', cast(version AS string)) AS dataset_name",
            "CASE WHEN user_id % 3 = 0 THEN true END AS is_critical",
            "CASE WHEN user_id % 4 <> 0 THEN false WHEN user_id % 12 = 0 THEN true END AS is_active",
        )
    )


def workspace_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workspace entries: one per ``GROUP_SIZE`` users, some switched off, with exclude lists."""
    excluded = F.collect_list(F.expr("CASE WHEN user_id % 10 = 3 THEN concat('ds-', cast(user_id AS string)) END"))
    return (
        users(spark, sf_dir)
        .withColumn("pos", F.expr(f"user_id div {GROUP_SIZE}"))
        .groupBy("pos")
        .agg(excluded.alias("exclude_datasets"))
        .selectExpr(
            "pos",
            "concat('w-', cast(pos AS string)) AS workspace_id",
            "concat('workspace ', cast(pos AS string)) AS workspace_name",
            "CASE WHEN pos % 2 = 0 THEN true END AS is_critical_default",
            "CASE WHEN pos % 7 = 6 THEN false END AS is_active",
            "exclude_datasets",
        )
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datasets found per workspace; every fifth one is listed by the next workspace too."""
    return (
        users(spark, sf_dir)
        .withColumn("shift", F.expr("explode(CASE WHEN user_id % 5 = 0 THEN array(0, 1) ELSE array(0) END)"))
        .selectExpr(
            f"concat('w-', cast(user_id div {GROUP_SIZE} + shift AS string)) AS workspace_id",
            "user_id AS item_pos",
            "CASE WHEN user_id % 31 <> 30 THEN concat('ds-', cast(user_id AS string)) END AS id",
            "CASE WHEN user_id % 7 <> 0 THEN concat('found ', cast(user_id AS string)) END AS name",
        )
    )


def _documents(rows: DataFrame, group: str, fields: dict[str, list[str]]) -> DataFrame:
    lists = [F.collect_list(F.struct(*columns)).alias(name) for name, columns in fields.items()]
    return rows.groupBy(group).agg(*lists).select(F.to_json(F.struct(*fields)).alias("line"))


def land_config(spark: SparkSession, sf_dir: str) -> str:
    """Write the explicit entries as configuration documents of at most ``2 * GROUP_SIZE`` entries."""
    columns = ["workspace_id", "workspace_name", "dataset_id", "dataset_name", "is_critical", "is_active"]
    entries = explicit_entries(spark, sf_dir).withColumn("part", F.expr(f"pos div {2 * GROUP_SIZE}"))
    path = scratch_path(spark, "config")
    _documents(entries, "part", {"datasets": columns}).write.text(path)
    return path


def land_listing(spark: SparkSession, sf_dir: str) -> str:
    """Write the dataset listings, one document per workspace."""
    path = scratch_path(spark, "listing")
    items = F.collect_list(F.struct("id", "name", F.lit(True).alias("isRefreshable")))
    (
        listing(spark, sf_dir)
        .groupBy("workspace_id")
        .agg(items.alias("value"))
        .select(F.to_json(F.struct("workspace_id", "value")).alias("line"))
        .write.text(path)
    )
    return path


def land_workspaces(spark: SparkSession, sf_dir: str) -> str:
    """Write workspace listings: a workspace per user, ``GROUP_SIZE`` in a document."""
    rows = users(spark, sf_dir).selectExpr(
        f"user_id div {GROUP_SIZE} AS part",
        "concat('g-', cast(user_id AS string)) AS id",
        "concat('group ', cast(user_id AS string)) AS name",
    )
    path = scratch_path(spark, "workspaces")
    _documents(rows, "part", {"value": ["id", "name"]}).write.text(path)
    return path
