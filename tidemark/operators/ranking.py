"""Top rows per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import sized_side

_RANK = "__rank"


def first_per_key(rows: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows per key. Spark limits each map task's groups before the shuffle, so a key
    holding a large share of the rows (or a group of copies) ships ``n`` rows per task at most."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) <= n).drop(_RANK)


def latest_with_ties(rows: DataFrame, key: str, instant: str) -> DataFrame:
    """Rows at the newest instant of their key, ties kept, in one scan."""
    window = Window.partitionBy(key).orderBy(F.col(instant).desc())
    return (
        rows.filter(F.col(instant).isNotNull())
        .withColumn(_RANK, F.rank().over(window))
        .filter(F.col(_RANK) == 1)
        .drop(_RANK)
    )


def latest_rows(rows: DataFrame, key: str, instant: str) -> DataFrame:
    """Rows at the newest instant of their key, ties kept, by the cheaper way; rows without a key are left out.

    The newest instants come from a scan of two columns. If they are few enough to broadcast, a
    second scan keeps the rows that match, without a sort or shuffle of whole rows. Otherwise rows
    are ranked.
    """
    filled = rows.filter(F.col(key).isNotNull() & F.col(instant).isNotNull())
    newest = sized_side(filled.groupBy(key).agg(F.max(instant).alias(instant)))
    if newest.small:
        return filled.join(newest.frame, [key, instant], "left_semi")
    return latest_with_ties(filled, key, instant)


def remaining_order(rows: DataFrame, used: list[str]) -> list[Column]:
    """Columns not used so far, as a tie-break that makes a choice repeatable."""
    sortable = [name for name, kind in rows.dtypes if not kind.startswith("map<")]
    return [F.col(name).asc() for name in sortable if name not in used]
