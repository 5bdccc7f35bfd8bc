"""Dataset registry: explicit entries, discovery and enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.ranking import first_per_key
from tidemark.session import small_side

REGISTRY_COLUMNS = ["dataset_id", "dataset_name", "workspace_id", "workspace_name", "is_critical", "is_active"]


def active_only(entries: DataFrame) -> DataFrame:
    """Entries not switched off; an absent flag means active."""
    return entries.filter(F.coalesce("is_active", F.lit(True)))


def drop_excluded(found: DataFrame, workspaces: DataFrame) -> DataFrame:
    """Discovered datasets without an id or on the exclude list of their workspace entry."""
    excluded = workspaces.select(
        F.col("pos").alias("workspace_pos"), F.explode("exclude_datasets").alias("dataset_id")
    ).distinct()
    named = found.filter(F.coalesce("dataset_id", F.lit("")) != "")
    return named.join(excluded, ["workspace_pos", "dataset_id"], "left_anti")


def discovered_datasets(workspaces: DataFrame, listing: DataFrame) -> DataFrame:
    """Datasets found in the active workspaces, with the positions that decide precedence."""
    active = active_only(workspaces)
    holders = active.select(
        "workspace_id",
        "workspace_name",
        F.col("pos").alias("workspace_pos"),
        F.coalesce("is_critical_default", F.lit(False)).alias("is_critical"),
    )
    found = listing.select(
        "workspace_id",
        "item_pos",
        F.col("id").alias("dataset_id"),
        F.coalesce("name", F.lit("Unknown")).alias("dataset_name"),
    ).join(small_side(holders), "workspace_id")
    return drop_excluded(found, active)


def resolve(explicit: DataFrame, workspaces: DataFrame, listing: DataFrame) -> DataFrame:
    """One entry per dataset: explicit before discovered, the last explicit entry, the first
    workspace that lists it."""
    stated = active_only(explicit).select(
        *REGISTRY_COLUMNS[:4],
        F.coalesce("is_critical", F.lit(False)).alias("is_critical"),
        F.lit(0).alias("source"),
        (-F.col("pos").cast("long")).alias("first"),
        F.lit(0).cast("long").alias("second"),
    )
    found = discovered_datasets(workspaces, listing).select(
        *REGISTRY_COLUMNS[:4],
        "is_critical",
        F.lit(1).alias("source"),
        F.col("workspace_pos").cast("long").alias("first"),
        F.col("item_pos").cast("long").alias("second"),
    )
    order = [F.col("source"), F.col("first"), F.col("second")]
    return (
        first_per_key(stated.unionByName(found), ["dataset_id"], order)
        .withColumn("is_active", F.lit(True))
        .select(REGISTRY_COLUMNS)
    )


def enrich(records: DataFrame, registry: DataFrame) -> DataFrame:
    """Attach names and the critical flag; records of unknown datasets are dropped.

    Pass the registry through ``session.small_side`` to broadcast it where its size allows.
    """
    attributes = registry.select(*REGISTRY_COLUMNS[:5])
    bare = records.drop(*[c for c in REGISTRY_COLUMNS[1:5] if c in records.columns])
    return bare.join(attributes, "dataset_id")
