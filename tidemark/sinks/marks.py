"""Answers about a stored table that its commits keep, so that nobody scans the table for them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import incremental
from tidemark.session import folder_files, materialize, path_exists, remove_folder, subfolders, write_text

FOLDER, STALE = "_watermarks", "stale"
SCHEMA = "dataset_id string, watermark timestamp"


def newest_day(spark: SparkSession, location: str, partition: str) -> DataFrame:
    """One row: the newest day of a table, from the names of its partition folders; null for an empty table.

    Only the listing is read, no row group. A folder without files counts as absent.
    """
    prefix, newest = f"{partition}=", None
    for name in reversed(subfolders(spark, location)):
        value = name.removeprefix(prefix)
        if name.startswith(prefix) and not value.startswith("__") and folder_files(spark, f"{location}/{name}"):
            newest = date.fromisoformat(value)
            break
    return spark.createDataFrame([(newest,)], "max_date date")


class Watermarks:
    """Newest start of every dataset, beside a table of refreshes.

    A commit first marks them stale and makes them current when its rows are in. If it dies in between they stay
    stale, and the next reader builds them anew from the table.
    """

    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.path = spark, f"{location}/{FOLDER}"

    def exists(self) -> bool:
        return bool(subfolders(self.spark, self.path))

    def build(self, table: DataFrame) -> None:
        """From a scan of the two columns of the table."""
        self._write(incremental.watermarks(table))

    def _write(self, marks: DataFrame) -> None:
        kept = materialize(marks, "watermarks")
        older = subfolders(self.spark, self.path)
        number = 1 + max((int(name.split("=")[1]) for name in older), default=0)
        kept.coalesce(1).write.parquet(f"{self.path}/version={number}")
        for name in older:
            remove_folder(self.spark, f"{self.path}/{name}")
        if path_exists(self.spark, f"{self.path}/{STALE}"):
            remove_folder(self.spark, f"{self.path}/{STALE}")

    def begin(self) -> None:
        """Before rows are stored."""
        if self.exists() and not self._is_stale():
            write_text(self.spark, f"{self.path}/{STALE}", "")

    def _is_stale(self) -> bool:
        whole = [name for name in subfolders(self.spark, self.path) if path_exists(self.spark, f"{self.path}/{name}/_SUCCESS")]
        return path_exists(self.spark, f"{self.path}/{STALE}") or not whole

    def _newest(self) -> DataFrame:
        number = max(int(name.split("=")[1]) for name in subfolders(self.spark, self.path))
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/version={number}")

    def end(self, stored: DataFrame) -> None:
        """After ``stored`` rows came in: only they are read. Starts never change and rows never go."""
        if self.exists():
            new = incremental.watermarks(stored)
            both = self._newest().unionByName(new)
            self._write(both.groupBy("dataset_id").agg(F.max("watermark").alias("watermark")))

    def read(self, table: DataFrame) -> DataFrame:
        """The watermarks; built from ``table`` first if a commit died."""
        if self._is_stale():
            self.build(table)
        return self._newest()
