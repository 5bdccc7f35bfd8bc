"""Mean over the previous rows of a key, with large keys split into blocks of time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import sized_side, small_side

MAX_ROWS_PER_TASK = 1_000_000
CHUNK_SECONDS = 60


def _blocks(rows: DataFrame, key: str, preceding: int, max_rows: int) -> DataFrame:
    """Map (key, chunk) to the blocks that need it.

    Chunks are packed into blocks of about ``max_rows``. The first chunk of a block also pulls in
    the earlier chunks that hold its ``preceding`` rows, marked as not its own.
    """
    counts = rows.groupBy(key, "chunk").agg(F.count(F.lit(1)).alias("n"))
    in_time = Window.partitionBy(key).orderBy("chunk")
    before = F.coalesce(F.sum("n").over(in_time.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    in_count = Window.partitionBy(key).orderBy("before")
    packed = (
        counts.withColumn("before", before)
        .withColumn("block", F.floor(F.col("before") / F.lit(max_rows)))
        .withColumn("previous_chunk", F.lag("chunk").over(in_time))
        .withColumn("previous_block", F.lag("block").over(in_time))
        .withColumn("halo", F.collect_list("previous_chunk").over(in_count.rangeBetween(-(preceding - 1), 0)))
    )
    own = packed.select(key, "chunk", "block", F.lit(True).alias("own"))
    halo = packed.filter(F.col("block") != F.col("previous_block")).select(
        key, F.explode("halo").alias("chunk"), "block", F.lit(False).alias("own")
    )
    return own.unionByName(halo)


def mean_of_previous(
    rows: DataFrame,
    key: str,
    instant: str,
    tie: str,
    value: str,
    preceding: int,
    out: str,
    max_rows_per_task: int = MAX_ROWS_PER_TASK,
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Attach the mean of ``value`` over the ``preceding`` rows before each row of its key.

    Keys within ``max_rows_per_task`` use a plain window. A larger key is cut into blocks, each
    with the rows before it that its first rows need, so the result does not depend on the cut.
    """
    plain = Window.partitionBy(key).orderBy(instant, tie).rowsBetween(-preceding, -1)
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    large = sized_side(sizes.filter(F.col("n") > max_rows_per_task).select(key))
    if large.rows == 0:
        return rows.withColumn(out, F.avg(value).over(plain))

    chunk: Column = F.floor(F.unix_micros(instant) / F.lit(chunk_seconds * 1_000_000))
    chunked = rows.withColumn("chunk", chunk)
    blocks = small_side(
        _blocks(chunked.join(large.frame, key, "left_semi"), key, preceding, max_rows_per_task)
    )
    in_block = Window.partitionBy(key, "block").orderBy(instant, tie).rowsBetween(-preceding, -1)
    return (
        chunked.join(blocks, [key, "chunk"], "left")
        .withColumn("block", F.coalesce("block", F.lit(0)))
        .withColumn(out, F.avg(value).over(in_block))
        .filter(F.coalesce("own", F.lit(True)))
        .select(*rows.columns, out)
    )
