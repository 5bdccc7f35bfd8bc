"""Reading the tables of a folder, and scratch tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_path


# Texts that are handed to a Python worker at once.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches in bytes, so that long texts don't make a worker's batches large."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a test folder."""
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write a frame to the shared folder and read it back: the plan is cut and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def by_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch], rows: int = 512) -> Callable[[Iterator], Iterator]:
    """A ``mapInArrow`` function that hands ``fn`` at most ``rows`` rows at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                yield fn(batch.slice(start, rows))

    return run
