"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from tidemark.checks.oracles import ORACLES
from tidemark.checks.queries import QUERIES


def _plain(value):
    if isinstance(value, (float, Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else round(number, 9)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _kind(value) -> str:
    return {float: "number", Decimal: "number", int: "int"}.get(type(value), type(value).__name__)


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """A connection of this process with one view per table."""
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def differences(spark: SparkSession, connection, name: str, sf_dir: str, shown: int = 3) -> list[str]:
    """What differs between a query and its SQL; empty if nothing does."""
    frame = QUERIES[name](spark, sf_dir)
    ours, our_columns = frame.collect(), frame.columns
    result = connection.execute(ORACLES[name])
    their_columns = [column[0] for column in result.description]
    theirs = result.fetchall()
    if sorted(our_columns) != sorted(their_columns):
        return [f"columns {sorted(our_columns)} != {sorted(their_columns)}"]
    left, right = _rows(our_columns, ours), _rows(their_columns, theirs)
    found = [f"rows {len(left)} != {len(right)}"] if len(left) != len(right) else []
    found += [f"{a} != {b}" for a, b in zip(left, right) if a != b][:shown]
    names = sorted(our_columns)
    for i, column in enumerate(names):
        kinds = [{_kind(row[i]) for row in side if row[i] is not None} for side in (left, right)]
        if kinds[0] != kinds[1]:
            found.append(f"type of {column}: {kinds}")
    if not left:
        found.append("no rows")
    return found
