"""Readers of the dataset, workspace and probe registries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import schemas


def _entries(spark: SparkSession, path: str, schema: str, field: str, multi_line: bool) -> DataFrame:
    documents = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return documents.select(
        F.col("_metadata.file_path").alias("source_file"), F.posexplode(field).alias("pos", "entry")
    ).select("source_file", "pos", "entry.*")


def explicit_datasets(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Explicit dataset entries with their position."""
    return _entries(spark, path, schemas.DATASET_CONFIG, "datasets", multi_line)


def workspaces(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Workspace entries with their position."""
    return _entries(spark, path, schemas.DATASET_CONFIG, "workspaces", multi_line)


def probes(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Probe entries with their position."""
    return _entries(spark, path, schemas.PROBE_CONFIG, "probes", multi_line)
