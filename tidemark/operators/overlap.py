"""Pairs of overlapping intervals without a theta join.

Of two overlapping intervals the later start lies inside the earlier interval. Intervals are
therefore spread over time bins once, starts are looked up in their bin, and every pair is found
exactly once. The bin width grows with the interval: each interval covers three bins at most.
Intervals too long for the coarsest width share one bin that all later starts are looked up in. Hot bins are split by adaptive skew-join handling, as both sides are shuffled
on an equality. Intervals that end before they start can only be the later one, which the lookup
covers, so the result equals the theta join for any input.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

# Bin widths from 1/64 of a second to 48 days. Only widths that some interval needs are looked up,
# and fine ones keep a burst of short intervals from meeting in one bin.
FINEST_SECONDS = 1 / 64
GROWTH = 16
LEVELS = 8


def _widths(finest_seconds: float) -> list[int]:
    return [int(finest_seconds * 1_000_000) * GROWTH**level for level in range(LEVELS)]


def _level(length: Column, widths: list[int]) -> Column:
    level = F.lit(len(widths))
    for number in range(len(widths) - 1, -1, -1):
        level = F.when(length <= 2 * widths[number], F.lit(number)).otherwise(level)
    return level


def _bin(micros: Column, level: Column, widths: list[int]) -> Column:
    """Bin of an instant; the level past the last width has a single bin."""
    width = F.element_at(F.array(*[F.lit(width) for width in widths]), F.least(level, F.lit(len(widths) - 1)) + 1)
    return F.when(level < len(widths), F.floor(micros / width)).otherwise(F.lit(0))


def overlapping_pairs(
    intervals: DataFrame,
    id_column: str,
    start: str,
    end: str,
    carry: list[str],
    first_since: datetime | None = None,
    finest_seconds: float = FINEST_SECONDS,
) -> DataFrame:
    """Pairs ``a``, ``b`` (structs of id, start, end and carried columns) with
    ``a.id < b.id``, ``a.start < b.end`` and ``b.start < a.end``.

    ``first_since`` bounds the start of ``a`` only. The later start is then never before it and the
    earlier interval never ends before it, which prunes both sides at the scan.
    """
    widths = _widths(finest_seconds)
    side = intervals.select(
        F.struct(
            F.col(id_column).alias("id"), F.col(start).alias("start"), F.col(end).alias("end"), *carry
        ).alias("row"),
        F.unix_micros(start).alias("starts"),
        F.unix_micros(end).alias("ends"),
    ).filter(F.col("starts").isNotNull() & F.col("ends").isNotNull())

    earlier, later = side.filter(F.col("ends") > F.col("starts")), side
    if first_since is not None:
        since = F.lit(first_since).cast("timestamp")
        earlier = earlier.filter(F.col("row.end") > since)
        later = later.filter(F.col("row.start") >= since)

    levelled = earlier.withColumn("level", _level(F.col("ends") - F.col("starts"), widths))
    level = F.col("level")
    covers = levelled.select(
        F.col("row").alias("e"),
        F.col("starts").alias("e_starts"),
        F.col("ends").alias("e_ends"),
        "level",
        F.explode(F.sequence(_bin(F.col("starts"), level, widths), _bin(F.col("ends") - 1, level, widths))).alias("bin"),
    )
    levels_in_use = levelled.agg(F.collect_set("level")).scalar()
    points = later.select(
        F.col("row").alias("l"),
        F.col("starts").alias("l_starts"),
        F.col("ends").alias("l_ends"),
        F.explode(levels_in_use).alias("level"),
    ).withColumn("bin", _bin(F.col("l_starts"), level, widths))

    starts_first = (F.col("e_starts") < F.col("l_starts")) | (
        (F.col("e_starts") == F.col("l_starts")) & (F.col("e.id") < F.col("l.id"))
    )
    meets = (F.col("l_starts") < F.col("e_ends")) & (F.col("e_starts") < F.col("l_ends"))
    e_is_a = F.col("e.id") < F.col("l.id")
    pairs = covers.join(points, ["level", "bin"]).filter(starts_first & meets).select(
        F.when(e_is_a, F.col("e")).otherwise(F.col("l")).alias("a"),
        F.when(e_is_a, F.col("l")).otherwise(F.col("e")).alias("b"),
    )
    return pairs if first_since is None else pairs.filter(F.col("a.start") >= since)
