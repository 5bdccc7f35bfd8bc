"""Numbering rows inside groups of any size, and trees cut into blocks of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.tables import stored
from tidemark.session import small_side


HOT_KEYS = 4096


def placed(df: DataFrame, *order: str) -> DataFrame:
    """The rows written in one order, with ``_at``: ascending along it, and consecutive inside each of its parts.

    Rows are dealt by range of ``order`` and, for equal ones, of their place in the input, so neither a large
    group nor many equal rows are one task. ``_at`` holds the part in its upper 31 bits.
    """
    salted = df.withColumn("_salt", F.monotonically_increasing_id())
    ranged = salted.repartitionByRange(*order, "_salt").sortWithinPartitions(*order, "_salt").drop("_salt")
    return stored(ranged.withColumn("_at", F.monotonically_increasing_id()), "placed")


def numbered(df: DataFrame, group: str, *order: str) -> DataFrame:
    """The rows with ``index`` (from 0, by ``order`` inside the group) and ``n`` (rows of the group).

    ``group`` holds no null. Offsets come from the counts of each part, one row a group and part.
    """
    rows = placed(df, group, *order).withColumn("_part", F.shiftright("_at", 33))
    spans = rows.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(group)
    spans = spans.select(group, "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"), F.sum("_rows").over(whole).alias("n"))
    joined = rows.join(small_side(spans), [group, "_part"])
    return joined.withColumn("index", F.col("_at") - F.col("_first") + F.col("_offset")).drop("_at", "_part", "_first", "_offset")


def join_hot(rows: DataFrame, side: DataFrame, key: str, n: str) -> DataFrame:
    """Left join of rows with a stored side that has one row a key and, in ``n``, how many rows have it.

    A key with a 4096th of all rows or more is hot; there are at most 4096 of them, so they are broadcast. The
    others are joined by a shuffle in which no key is large.
    """
    total = side.agg(F.sum(n)).first()[0] or 0
    hot = F.broadcast(side.where(F.col(n) * HOT_KEYS >= total))
    others = side.where(F.col(n) * HOT_KEYS < total)
    cold = rows.join(hot.select(key), key, "left_anti").join(others, key, "left")
    return rows.join(hot, key).unionByName(cold)
