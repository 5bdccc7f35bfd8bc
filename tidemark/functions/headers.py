"""Expressions over response header maps and status codes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Statuses worth retrying, and the headers that carry quota information.
RETRYABLE_STATUSES = [429, 500, 502, 503, 504]
RETRY_AFTER = "retry-after"
QUOTA_PREFIXES = ["ratelimit-", "x-ratelimit-", "x-ms-"]


def retryable(status: Column, method: Column) -> Column:
    """Only reads are retried, and only on throttling and server-side failures."""
    return F.coalesce(status.isin(RETRYABLE_STATUSES) & (F.upper(method) == "GET"), F.lit(False))


def quota_headers(headers: Column) -> Column:
    """The quota-related part of a header map, whatever the case of its keys."""

    def wanted(name: Column, _value: Column) -> Column:
        key = F.lower(name)
        keep = key == RETRY_AFTER
        for prefix in QUOTA_PREFIXES:
            keep = keep | key.startswith(prefix)
        return keep

    return F.map_filter(headers, wanted)


def retry_after_text(headers: Column) -> Column:
    """The ``Retry-After`` value as sent."""
    return F.get(F.map_values(F.map_filter(headers, lambda k, _: F.lower(k) == RETRY_AFTER)), 0)


def retry_after_seconds(headers: Column) -> Column:
    """``Retry-After`` in whole seconds; null if absent or a date."""
    text = F.trim(retry_after_text(headers))
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("int"))
