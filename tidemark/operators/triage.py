"""Statistics and decisions over a log of API responses.

Log columns: endpoint, seq (increasing per endpoint), status, headers map, latency_ms, body, error
(text of a transport error, else null); fetch logs add kind, day and dataset_id.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.headers import quota_headers, retry_after_text
from tidemark.functions.payloads import event_fields
from tidemark.operators.ranking import first_per_key
from tidemark.operators.transform import tracked_activity
from tidemark.session import materialize, small_side

OK, SKIP_EMPTY, DENIED_EMPTY, THROTTLED, FAILED = "ok", "skip_empty", "denied_empty", "throttled", "failed"
NO_DAY = date.max


def fetch_outcome(kind: Column, status: Column, error: Column) -> Column:
    """What a response means for the fetch of its kind (dataset, workspace or activity)."""
    listing = kind.isin("dataset", "workspace")
    activity = kind == "activity"
    return (
        F.when(error.isNotNull() | status.isNull(), FAILED)
        .when(status < 400, OK)
        .when(listing & status.isin(403, 404), SKIP_EMPTY)
        .when(activity & status.isin(401, 403), DENIED_EMPTY)
        .when(activity & (status == 429), THROTTLED)
        .otherwise(FAILED)
    )


def with_outcome(log: DataFrame) -> DataFrame:
    """Attach the outcome of each response."""
    return log.withColumn("outcome", fetch_outcome(F.col("kind"), F.col("status"), F.col("error")))


def before_throttling(log: DataFrame, stop_on_denied: bool = False) -> DataFrame:
    """Responses of the days before the first throttled one (optionally: or denied one)."""
    stops = F.col("status") == 429
    if stop_on_denied:
        stops = stops | F.col("status").isin(401, 403)
    cutoff = log.filter(stops).agg(F.min("day")).scalar()
    return log.filter(F.col("day") < F.coalesce(cutoff, F.lit(NO_DAY)))


def loadable_days(
    days: DataFrame,
    log: DataFrame,
    cut_off: DataFrame,
    stop_on_denied: bool = False,
    landed: DataFrame | None = None,
) -> DataFrame:
    """The leading days that were fetched in full; the first other day ends the list.

    A day is open if it is missing from the log, was throttled or failed, is in ``cut_off``, or has
    fewer pages in ``landed`` (a row a page, with ``day``) than responses with content in the log.
    Loading past an open day would move the high-water mark over a gap.
    """
    stops = [THROTTLED, FAILED, DENIED_EMPTY] if stop_on_denied else [THROTTLED, FAILED]
    fetched = with_outcome(log).groupBy("day").agg(
        F.max(F.col("outcome").isin(stops)).alias("stopped"), F.count_if(F.col("outcome") == OK).alias("n_ok")
    )
    if landed is not None:
        pages = landed.groupBy("day").agg(F.count(F.lit(1)).alias("n_pages"))
        lost = F.col("n_ok") > F.coalesce("n_pages", F.lit(0))
        fetched = fetched.join(pages, "day", "left").withColumn("stopped", F.col("stopped") | lost).drop("n_pages")
    state = days.join(fetched, "day", "left").join(
        cut_off.select("day").distinct().withColumn("cut_off", F.lit(True)), "day", "left"
    )
    is_open = F.coalesce("stopped", F.lit(True)) | F.coalesce("cut_off", F.lit(False))
    first_open = state.filter(is_open).agg(F.min("day")).scalar()
    return days.filter(F.col("day") < F.coalesce(first_open, F.lit(NO_DAY)))


def until_first_stop(log: DataFrame, max_requests: int | None = None) -> DataFrame:
    """Responses of each endpoint up to and including the first 429, other 4xx/5xx or transport
    error. The stop positions are a per-endpoint minimum, so endpoints are never sorted whole.

    ``max_requests`` is the size of the burst: the first so many responses of an endpoint.
    """
    if max_requests is not None:
        log = materialize(first_per_key(log, ["endpoint"], [F.col("seq").asc()], max_requests))
    stops = (F.col("status") >= 400) | F.col("error").isNotNull()
    ends = log.filter(stops).groupBy("endpoint").agg(F.min("seq").alias("stop_seq"))
    return (
        log.join(small_side(ends), "endpoint", "left")
        .filter(F.col("stop_seq").isNull() | (F.col("seq") <= F.col("stop_seq")))
        .drop("stop_seq")
    )


def status_counts(log: DataFrame) -> DataFrame:
    """Responses per status as a map, one row per endpoint."""
    counted = log.filter(F.col("status").isNotNull()).groupBy("endpoint", "status").agg(
        F.count(F.lit(1)).alias("n")
    )
    entry = F.struct(F.col("status").cast("string").alias("key"), F.col("n").alias("value"))
    return counted.groupBy("endpoint").agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("status_counts")
    )


def _stop_error(body_chars: int | None) -> Column:
    """Text for the response that ended the burst; a 429 is not an error."""
    status = F.concat(F.lit("HTTP "), F.col("last.status").cast("string"))
    body = F.coalesce("last.body", F.lit(""))
    body = body if body_chars is None else F.substring(body, 1, body_chars)
    # Texts of the report.
    denied = F.lit(
        " - authenticated but not authorized for this endpoint (check tenant setting / workspace access)."
    )
    return (
        F.when(
            F.col("last.error").isNotNull(),
            F.concat(
                F.lit("request #"),
                (F.col("requests_made") + 1).cast("string"),
                F.lit(" raised: "),
                F.col("last.error"),
            ),
        )
        .when(F.col("last.status").isin(401, 403), F.concat(status, denied))
        .when(
            (F.col("last.status") >= 400) & ~F.col("throttled"),
            F.concat(status, F.lit(": "), body),
        )
    )


def endpoint_stats(log: DataFrame, max_requests: int | None = None, body_chars: int | None = None) -> DataFrame:
    """Per endpoint: how many requests ran before it throttled or failed, and how fast they were.

    Latencies are rounded to one digit before and after averaging; a transport error counts
    neither as a request nor as a latency. The quota headers are those of the 429, else of the
    first response, and an empty map if there are none; so are the counts of an endpoint without a
    status. ``max_requests`` reads the first so many responses of an endpoint only; ``body_chars``
    cuts the body in an error text.
    """
    burst = until_first_stop(log, max_requests)
    answered = F.col("error").isNull()
    # Whole tenths add up exactly, so the mean does not depend on the order of the rows.
    tenths = F.when(answered, F.bround(F.bround("latency_ms", 1) * 10, 0).cast("bigint"))
    quota = quota_headers(F.col("headers"))
    stats = burst.groupBy("endpoint").agg(
        F.count_if(answered).alias("requests_made"),
        F.min_by(quota, F.when(answered, F.col("seq"))).alias("first_quota"),
        F.max_by(F.struct("status", "error", "body", "headers"), F.col("seq")).alias("last"),
        (F.min(tenths) / 10).alias("min_latency_ms"),
        (F.max(tenths) / 10).alias("max_latency_ms"),
        (F.bround(F.try_divide(F.sum(tenths), F.count(tenths)), 0) / 10).alias("avg_latency_ms"),
    )
    stats = stats.withColumn("throttled", F.coalesce(F.col("last.status") == 429, F.lit(False)))
    throttled = F.col("throttled")
    no_headers = F.create_map().cast("map<string,string>")
    return stats.join(status_counts(burst.filter(answered)), "endpoint", "left").select(
        "endpoint",
        "requests_made",
        "throttled",
        F.when(throttled, F.col("requests_made")).alias("first_429_at_request"),
        F.when(throttled, retry_after_text(F.col("last.headers"))).alias("retry_after_seconds"),
        F.when(throttled, quota_headers(F.col("last.headers")))
        .otherwise(F.coalesce("first_quota", no_headers))
        .alias("rate_limit_headers"),
        "min_latency_ms",
        "max_latency_ms",
        "avg_latency_ms",
        F.coalesce("status_counts", F.create_map().cast("map<string,bigint>")).alias("status_counts"),
        _stop_error(body_chars).alias("error"),
    )


def run_stats(registry: DataFrame, new_rows: DataFrame, failed: DataFrame) -> DataFrame:
    """One row: datasets with new rows, without, and failed.

    ``new_rows`` and ``failed`` hold a ``dataset_id`` per row and are counted before the join.
    """
    loaded = new_rows.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n_new"))
    broken = failed.select("dataset_id").distinct().withColumn("failed", F.lit(True))
    state = registry.join(loaded, "dataset_id", "left").join(broken, "dataset_id", "left")
    is_failed = F.coalesce("failed", F.lit(False))
    has_new = F.coalesce("n_new", F.lit(0)) > 0
    return state.agg(
        F.count_if(~is_failed & has_new).alias("datasets_processed"),
        F.count_if(~is_failed & ~has_new).alias("datasets_skipped"),
        F.count_if(is_failed).alias("datasets_failed"),
    )


def day_counts(raw_events: DataFrame, known_ids: DataFrame, tracked: list[str] | None = None) -> DataFrame:
    """Per fetch day: raw events, rows kept, and rows new after removing copies and known ids.

    An id that appears on several days counts for the first of them.
    """
    events = raw_events.withColumn("fields", event_fields(F.col("raw"))).select(
        "fetch_day", F.col("fields")["Id"].alias("event_id"), F.col("fields")["Activity"].alias("activity")
    )
    has_id = F.coalesce("event_id", F.lit("")) != ""
    kept = has_id & tracked_activity(F.col("activity"), tracked)
    # One scan: copies collapse to a row per id and day before anything is compared.
    per_id = events.groupBy("event_id", "fetch_day").agg(
        F.count(F.lit(1)).alias("n_raw"), F.count_if(kept).alias("n_kept")
    )
    known = known_ids.select("event_id").distinct().withColumn("known", F.lit(True))
    earlier = Window.partitionBy("event_id").orderBy("fetch_day").rowsBetween(Window.unboundedPreceding, -1)
    kept_before = F.coalesce(F.sum("n_kept").over(earlier), F.lit(0)) > 0
    is_new = (F.col("n_kept") > 0) & ~kept_before & F.col("known").isNull()
    return (
        per_id.join(known, "event_id", "left")
        .withColumn("is_new", is_new)
        .groupBy("fetch_day")
        .agg(
            F.sum("n_raw").alias("n_raw"),
            F.sum("n_kept").alias("n_kept"),
            F.count_if("is_new").alias("n_new"),
        )
    )
