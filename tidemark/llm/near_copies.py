"""One row of each group of near copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.jaccard_join import Join, jaccard_components
from tidemark.llm.tables import stored
from tidemark.session import small_side


def first_of_near_copies(docs: DataFrame, join: Join, columns: tuple[str, ...], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each group of linked rows the one with the smallest id, with ``columns``. Rows without an id stay.

    Rows are told apart by a 64-bit hash of id and text, so rows that share an id but are not linked all stay.
    Of rows with the same id and text the least one stays.
    """
    keyed = docs.select(*columns, F.xxhash64(doc_id, F.col(text).isNull(), text).alias("_key"))
    named = keyed.where(F.col(doc_id).isNotNull())
    found = stored(jaccard_components(named, join, doc_id="_key", text=text), "near-groups")
    others = found.where("doc_id <> component_id").select("component_id", F.col("doc_id").alias("_key")).distinct()
    linked = small_side(others.unionByName(others.select("component_id", F.col("component_id").alias("_key")).distinct()))
    owned = stored(named.select("_key", F.col(doc_id).alias("_id")).join(linked, "_key").distinct(), "near-owned")
    first = small_side(owned.groupBy("component_id").agg(F.min(F.struct("_id", "_key")).alias("first")))
    dropped = small_side(owned.join(first, "component_id").where("_key <> first._key").select("_key"))
    repeated = small_side(found.groupBy(F.col("doc_id").alias("_key")).count().where("count > 1").select("_key"))
    left = keyed.join(dropped, "_key", "left_anti")
    once = left.where(F.col(doc_id).isNotNull()).join(repeated, "_key", "left_semi").groupBy("_key").agg(F.min(F.struct(*columns)).alias("row")).select("row.*")
    unnamed = left.where(F.col(doc_id).isNull()).select(*columns)
    return left.where(F.col(doc_id).isNotNull()).join(repeated, "_key", "left_anti").select(*columns).unionByName(once).unionByName(unnamed)
