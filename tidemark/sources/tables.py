"""Stored tables, typed rows and CSV history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampType

from tidemark.functions.instants import parse_instant


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """Read a stored table by its full name."""
    return spark.table(name)


def scan_if_present(spark: SparkSession, name: str, schema: StructType) -> DataFrame:
    """The stored table, or an empty one if it does not exist. Other errors surface."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def typed_rows(rows: DataFrame, schema: StructType) -> DataFrame:
    """Bring rows to a declared schema; text that does not convert becomes null."""
    have = dict(rows.dtypes)

    def typed(field):
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        source = F.col(field.name)
        if have[field.name] == field.dataType.simpleString():
            return source
        if have[field.name] == "string" and isinstance(field.dataType, (TimestampType, DateType)):
            return parse_instant(source).cast(field.dataType).alias(field.name)
        return source.try_cast(field.dataType).alias(field.name)

    return rows.select(*[typed(field) for field in schema.fields])


def split_on_required(rows: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Rows with every required column set, and the rest (for a quarantine table)."""
    required = F.lit(True)
    for field in schema.fields:
        if not field.nullable:
            required = required & F.col(field.name).isNotNull()
    return rows.filter(required), rows.filter(~required)


# One dialect for writing and reading: quotes are doubled, and values may hold line breaks.
CSV_WRITE = {"header": "true", "quote": '"', "escape": '"'}
CSV_READ = {**CSV_WRITE, "multiLine": "true"}


def csv_history(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """All rows of an earlier export as text; a file with other columns is an error.

    With ``columns`` given the header of a file need not be looked up first, and an export without
    rows reads as empty.
    """
    reader = spark.read.options(**CSV_READ).option("enforceSchema", False)
    if columns is not None:
        reader = reader.schema(StructType([StructField(name, StringType()) for name in columns]))
    return reader.csv(path)


def csv_known_ids(spark: SparkSession, path: str, id_column: str = "event_id") -> DataFrame:
    """Distinct ids over all CSV files of an earlier export."""
    return csv_history(spark, path).select(id_column).distinct()
