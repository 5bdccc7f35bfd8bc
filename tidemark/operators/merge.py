"""Keyed merges as DataFrame operators: target and source in, merged rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.ranking import first_per_key, remaining_order
from tidemark.session import sized_side

RUNNING = "Unknown"

# Columns an update copies from the source.
REFRESH_UPDATES = [
    "status",
    "end_time",
    "duration_seconds",
    "service_exception_json",
    "error_code",
    "refresh_attempts_json",
    "attempt_count",
    "ingestion_timestamp",
]


def one_per_request(source: DataFrame) -> DataFrame:
    """One row per request: a finished one before a running one, then the one ingested last."""
    running = F.coalesce(F.col("status") == RUNNING, F.lit(True))
    order = [running.asc(), F.col("ingestion_timestamp").desc()]
    rest = remaining_order(source, ["request_id", "ingestion_timestamp"])
    return first_per_key(source, ["request_id"], order + rest)


def one_per_event(source: DataFrame) -> DataFrame:
    """One row per event id, the earliest created."""
    order = [F.col("creation_time").asc_nulls_last()]
    return first_per_key(source, ["event_id"], order + remaining_order(source, ["event_id", "creation_time"]))


def finished(status: Column) -> Column:
    """Whether a source row may update a stored one; a null status may not."""
    return F.coalesce(status != RUNNING, F.lit(False))


def _merged(columns: list[str]) -> list[Column]:
    """Columns of a joined ``old`` and ``new`` row: the stored values, updates, or a new row."""
    stored = F.col("old.request_id").isNotNull()
    updated = stored & F.col("new.request_id").isNotNull() & finished(F.col("new.status"))

    def merged(name: str) -> Column:
        kept = F.when(stored, F.col(f"old.{name}")).otherwise(F.col(f"new.{name}"))
        if name in REFRESH_UPDATES:
            kept = F.when(updated, F.col(f"new.{name}")).otherwise(kept)
        return kept.alias(name)

    return [merged(name) for name in columns]


def _same_request() -> Column:
    return F.col("old.request_id") == F.col("new.request_id")


def merge_refresh(target: DataFrame, source: DataFrame) -> DataFrame:
    """Update stored requests that have finished since, insert unseen ones.

    Matched rows take the update columns as they are, nulls included, and keep everything else. A
    batch proven small is broadcast, so the stored rows are not moved; a large one is joined outright.
    """
    batch = sized_side(one_per_request(source))
    if batch.small:
        inserted = unseen(target, batch.frame, "request_id").select(target.columns)
        return apply_updates(target, batch.frame).unionByName(inserted)
    joined = target.alias("old").join(batch.frame.alias("new"), _same_request(), "full_outer")
    return joined.select(_merged(target.columns))


def apply_updates(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The update half of ``merge_refresh`` for a batch of one row per request.

    The target is the outer side, so a batch marked for broadcast leaves it unshuffled.
    """
    joined = target.alias("old").join(batch.alias("new"), _same_request(), "left")
    return joined.select(_merged(target.columns))


def known_ids(target: DataFrame, source: DataFrame, key: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Keys of the source that are stored already, with columns of the stored row.

    The scan reads the key (and carried) columns only; the result is no larger than the source.
    """
    return target.select(key, *carry).join(source, key, "left_semi")


def unseen(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Source rows whose key is not stored; the target is only ever streamed past the source."""
    return source.join(known_ids(target, source.select(key), key), key, "left_anti")


def new_events(target: DataFrame, source: DataFrame) -> DataFrame:
    """Events to insert: one per id, stored ids left out. The source is reduced once."""
    return unseen(target, sized_side(one_per_event(source)).frame, "event_id").select(target.columns)


def merge_events(target: DataFrame, source: DataFrame) -> DataFrame:
    """Stored events, untouched, and the new ones."""
    return target.unionByName(new_events(target, source))
