"""Frames that a stream carries from one micro-batch to the next."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import remove_folder, subfolders

_PREFIX = "batch="


@dataclass(frozen=True)
class Carried:
    """A frame with one folder for each batch that wrote it.

    A batch reads what the batch before it left and overwrites its own folder, so a batch that is repeated after
    a failure starts from the same rows. Older folders go when a batch begins: the one before it is done then.
    """

    path: str
    schema: str

    def numbers(self, spark: SparkSession) -> list[int]:
        """Batches whose rows are there."""
        return sorted(int(name.removeprefix(_PREFIX)) for name in subfolders(spark, self.path) if name.startswith(_PREFIX))

    def folder(self, batch_id: int) -> str:
        return f"{self.path}/{_PREFIX}{batch_id}"

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What the batch before this one left; nothing at the start."""
        earlier = [n for n in self.numbers(spark) if n < batch_id]
        if not earlier:
            return spark.createDataFrame([], self.schema)
        for number in earlier[:-1]:
            remove_folder(spark, self.folder(number))
        return spark.read.schema(self.schema).parquet(self.folder(earlier[-1]))

    def write(self, batch_id: int, rows: DataFrame) -> None:
        """Leave rows for the next batch."""
        rows.write.mode("overwrite").parquet(self.folder(batch_id))
