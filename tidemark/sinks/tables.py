"""Stored tables: creation, appends and merge commits on partitioned Parquet."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark import schemas
from tidemark.operators import incremental, merge
from tidemark.operators.incremental import listed_days, on_days, only_days
from tidemark.sinks.id_index import BUCKETS, IdIndex
from tidemark.sinks.marks import Watermarks, newest_day
from tidemark.session import (
    materialize,
    measured,
    path_exists,
    read_text,
    remove_folder,
    session_conf,
    small_side,
    subfolders,
    write_text,
)

# Inside the folder of a staged commit.
STAGED_ROWS, READY = "rows", "ready.json"

# Rows of a bucket: those a new table plans for, and the most that a merge sorts where they lie.
BUCKET_ROWS, BUCKET_MAX_ROWS = 500_000, 2_000_000


@dataclass(frozen=True)
class TableSpec:
    """Schema, partition column, description and id column of a stored table."""

    schema: StructType
    partition: str
    comment: str
    key: str


REFRESH_TABLE = TableSpec(schemas.REFRESH_HISTORY, "ingestion_date", "Refresh attempts of the registered datasets.", "request_id")
PROBE_TABLE = TableSpec(schemas.QUERY_PERFORMANCE, "probe_date", "Response times of the probe queries.", "probe_id")
ACTIVITY_TABLE = TableSpec(schemas.ACTIVITY_EVENTS, "creation_date", "Audit events, inserted once per event id.", "event_id")


def create_table_sql(name: str, spec: TableSpec, location: str | None = None, buckets: int | None = None) -> str:
    """The statement that creates a table if it is absent; ``buckets`` deals each day's rows to files by hash of the id."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "\\'") + "'"

    columns = ", ".join(
        f"{field.name} {field.dataType.simpleString()}"
        + ("" if field.nullable else " NOT NULL")
        + f" COMMENT {quoted(field.metadata['comment'])}"
        for field in spec.schema.fields
    )
    place = f" LOCATION {quoted(location)}" if location else ""
    clustered = f"CLUSTERED BY ({spec.key}) INTO {buckets} BUCKETS " if buckets else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({spec.partition}) {clustered}COMMENT {quoted(spec.comment)}{place}"
    )


def create_table(
    spark: SparkSession, name: str, spec: TableSpec, location: str | None = None, buckets: int | None = None, rows: int = 0
) -> None:
    """Create a table if it is absent.

    A table in ``buckets`` merges batches too large to broadcast without a shuffle of stored rows: only the batch
    is dealt to the buckets. It has that many files a day at least, so a day should be large. ``rows`` expected in
    the table raise the number of buckets to one for each ``BUCKET_ROWS``, as one task sorts a bucket in a merge.
    """
    if buckets:
        buckets = max(buckets, -(-rows // BUCKET_ROWS))
    spark.sql(create_table_sql(name, spec, location, buckets))


def _buckets(spark: SparkSession, name: str) -> int | None:
    """Number of buckets of a table; None if it has none."""
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Num Buckets'").first()
    return int(found.data_type) if found else None


def _checked(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Fail the write on a null in a required column, which Parquet tables do not enforce."""

    def column(field):
        value = F.col(field.name)
        if field.nullable:
            return value
        problem = F.raise_error(F.lit(f"null in required column {field.name}")).cast(field.dataType)
        return F.coalesce(value, problem).alias(field.name)

    return rows.select(*[column(field) for field in spec.schema.fields])


def _spread(rows: DataFrame, partition: str) -> DataFrame:
    """Group rows by partition value into files of the advisory size; large days are split."""
    return rows.hint("rebalance", F.col(partition))


def _in_buckets(rows: DataFrame, spec: TableSpec, buckets: int) -> DataFrame:
    """Group rows by partition value and bucket into tasks of the advisory size; a large bucket gets several."""
    dealt = rows.withColumn("__bucket", F.pmod(F.hash(spec.key), F.lit(buckets)))
    return dealt.hint("rebalance", F.col(spec.partition), F.col("__bucket")).drop("__bucket")


def _dealt(spark: SparkSession, name: str, rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows as a table's files want them: by day and bucket, or spread by day."""
    buckets = _buckets(spark, name)
    return _in_buckets(rows, spec, buckets) if buckets else _spread(rows, spec.partition)


def _outgrown(spark: SparkSession, name: str) -> bool:
    """Whether the buckets of a table hold more rows than one task should sort; the count reads no column."""
    buckets = _buckets(spark, name)
    return bool(buckets) and spark.table(name).count() > buckets * BUCKET_MAX_ROWS


def append(spark: SparkSession, name: str, rows: DataFrame, spec: TableSpec) -> None:
    """Append rows; nothing happens for none. A merge that a lost driver left staged is finished first."""
    finish_commit(spark, name)
    marks = Watermarks(spark, _location(spark, name)) if spec is REFRESH_TABLE else None
    if marks and marks.exists():
        rows = materialize(rows)
        marks.begin()
    spread = _dealt(spark, name, _checked(rows, spec), spec)
    spread.select(spark.table(name).columns).write.insertInto(name)
    if marks:
        marks.end(rows)


def append_probes(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Append probe measurements; each run is a new measurement."""
    append(spark, name, rows, PROBE_TABLE)


def _location(spark: SparkSession, name: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first().data_type


def id_index(spark: SparkSession, name: str) -> IdIndex:
    """The id index of a table, whether it exists or not."""
    return IdIndex(spark, _location(spark, name))


def create_id_index(spark: SparkSession, name: str, spec: TableSpec, buckets: int = BUCKETS) -> IdIndex:
    """Index the ids of a table; from then on its commits look ids up there instead of scanning the table, and keep it."""
    finish_commit(spark, name)
    index = id_index(spark, name)
    index.create(spark.table(name).select(spec.key, spec.partition), spec.key, spec.partition, buckets)
    return index


def create_watermarks(spark: SparkSession, name: str) -> None:
    """Keep the watermarks of a table of refreshes beside it; from then on its commits keep them current."""
    finish_commit(spark, name)
    Watermarks(spark, _location(spark, name)).build(spark.table(name))


def watermarks(spark: SparkSession, name: str) -> DataFrame:
    """Newest start of each dataset: those kept beside the table, or from a scan where none are kept."""
    finish_commit(spark, name)
    kept = Watermarks(spark, _location(spark, name))
    return kept.read(spark.table(name)) if kept.exists() else incremental.watermarks(spark.table(name))


def max_activity_date(spark: SparkSession, name: str) -> DataFrame:
    """One row: the newest day of the table of events, from its partitions alone."""
    return newest_day(spark, _location(spark, name), ACTIVITY_TABLE.partition)


def _settle(spark: SparkSession, name: str, spec: TableSpec, index: IdIndex) -> None:
    """Finish what died before: a staged merge, and announced ids."""
    finish_commit(spark, name)
    spark.catalog.refreshTable(name)

    def stored(pending: DataFrame) -> DataFrame:
        kept = materialize(pending, "pending")
        return merge.known_ids(only_days(spark.table(name), kept, spec.partition), kept.select(spec.key), spec.key)

    index.settle(stored)


def commit_events(spark: SparkSession, name: str, source: DataFrame, immutable_days: bool = False) -> None:
    """Insert unseen events; a repeated run inserts none.

    With an id index the ids of the batch are looked up there. Without one, ``immutable_days`` states that an
    event keeps its creation day, so only the days of the batch are searched for known ids; otherwise the id
    column of the whole table is.
    """
    batch = materialize(merge.one_per_event(source))
    index = id_index(spark, name)
    if index.exists():
        _settle(spark, name, ACTIVITY_TABLE, index)
        new = materialize(batch.join(small_side(index.lookup(batch)), "event_id", "left_anti").select(batch.columns), "new-events")
        announced = index.announce(new)
        append(spark, name, new, ACTIVITY_TABLE)
        index.record(announced)
        return
    target = spark.table(name)
    if immutable_days:
        target = only_days(target, batch, ACTIVITY_TABLE.partition)
    side = measured(batch)
    if not side.small and _outgrown(spark, name):
        target = target.repartition("event_id")
    stored = merge.known_ids(target, side.frame.select("event_id"), "event_id")
    append(spark, name, batch.join(stored, "event_id", "left_anti"), ACTIVITY_TABLE)


def _staging(spark: SparkSession, name: str) -> str:
    # Readers skip folders that start with an underscore.
    return f"{_location(spark, name)}/_staged_merge"


def _counts_by_day(rows: DataFrame) -> dict[str, int]:
    """Rows of each day; a table's changed days are few enough for the driver."""
    day = F.coalesce(F.col(REFRESH_TABLE.partition).cast("string"), F.lit(""))
    return {row.day: row.n for row in rows.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n")).collect()}


def _touched(target: DataFrame, days: list[str]) -> DataFrame:
    listed = [date.fromisoformat(day) if day else None for day in days]
    return target.filter(on_days(REFRESH_TABLE.partition, listed))


def finish_commit(spark: SparkSession, name: str) -> None:
    """Put staged days into place, if a complete stage is there; drop an incomplete one.

    A stage is complete once it has its marker, which lists the rows of each day before and after.
    Replacing partitions deletes the old files before it moves the new ones in, so a run that died
    in between is completed by the next one. One writer at a time is allowed for each table.
    """
    staging = _staging(spark, name)
    for stage in subfolders(spark, staging):
        if path_exists(spark, f"{staging}/{stage}/{READY}"):
            _apply_stage(spark, name, f"{staging}/{stage}")
        else:
            remove_folder(spark, f"{staging}/{stage}")


def _apply_stage(spark: SparkSession, name: str, stage: str) -> None:
    """Replace the staged days; raises, and leaves everything as it is, if stage or table are not as the marker says."""
    days = json.loads(read_text(spark, f"{stage}/{READY}"))
    staged = spark.read.schema(REFRESH_TABLE.schema).parquet(f"{stage}/{STAGED_ROWS}")
    if _counts_by_day(staged) != {day: after for day, (_, after) in days.items()}:
        raise RuntimeError(f"{stage} lacks rows of its commit")
    spark.catalog.refreshTable(name)
    found = _counts_by_day(_touched(spark.table(name), list(days)))
    for day, (before, after) in days.items():
        if found.get(day, 0) not in (before, after, 0):
            raise RuntimeError(f"{day} of {name} changed after {stage} was made")
    with session_conf(spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
        dealt = _in_buckets(staged, REFRESH_TABLE, buckets) if (buckets := _buckets(spark, name)) else staged
        dealt.select(spark.table(name).columns).write.insertInto(name, overwrite=True)
    remove_folder(spark, f"{stage}/{READY}")  # first, so that a half removed stage is never applied
    remove_folder(spark, stage)
    if not subfolders(spark, _staging(spark, name)):
        remove_folder(spark, _staging(spark, name))
    spark.catalog.refreshTable(name)


def commit_refresh(spark: SparkSession, name: str, source: DataFrame) -> DataFrame:
    """Merge refresh rows into the table, rewriting only the days that change; returns the rows that were inserted.

    Stored requests of the batch are found in the table's id index, if it has one, and otherwise through a scan of
    two columns, past a broadcast of the batch's ids where they are few. The changed days, with updates and inserts applied, are staged
    in a folder of this commit and then replace their partitions; a repeated run gives the same table. Stored rows
    stay in their buckets for a large batch too, unless these have outgrown a task; then they are dealt by id.
    """
    finish_commit(spark, name)
    day, index = REFRESH_TABLE.partition, id_index(spark, name)
    batch = materialize(merge.one_per_request(source))
    side = measured(batch)
    marked = side.frame
    indexed = index.exists()
    if indexed:
        _settle(spark, name, REFRESH_TABLE, index)
    target = spark.table(name)
    outgrown = not side.small and _outgrown(spark, name)

    def joinable(stored: DataFrame) -> DataFrame:
        return stored.repartition("request_id") if outgrown else stored

    found = index.lookup(batch) if indexed else merge.known_ids(joinable(target), marked.select("request_id"), "request_id", carry=(day,))
    stored = materialize(found)

    finished = batch.filter(merge.finished(F.col("status"))).select("request_id")
    updated_days = stored.join(finished, "request_id", "left_semi").select(day)
    # Batch and stored ids are materialized, so this reads no table, now or later.
    inserted = batch.join(stored, "request_id", "left_anti").select(target.columns)
    changed = updated_days.union(inserted.select(day)).distinct()
    listed = listed_days(changed, day)
    if listed == []:
        return inserted
    touched = target.filter(on_days(day, listed)) if listed else only_days(target, changed, day)
    rows = merge.apply_updates(joinable(touched), marked).unionByName(inserted)
    stage = f"{_staging(spark, name)}/{uuid.uuid4().hex}"
    _spread(_checked(rows, REFRESH_TABLE), day).write.partitionBy(day).parquet(f"{stage}/{STAGED_ROWS}")
    before = _counts_by_day(touched)
    after = _counts_by_day(spark.read.schema(REFRESH_TABLE.schema).parquet(f"{stage}/{STAGED_ROWS}"))
    announced = index.announce(inserted) if indexed else None
    write_text(spark, f"{stage}/{READY}", json.dumps({one: (before.get(one, 0), n) for one, n in after.items()}))
    marks = Watermarks(spark, _location(spark, name))
    marks.begin()
    _apply_stage(spark, name, stage)
    marks.end(inserted)
    if announced:
        index.record(announced)
    return inserted


def append_alerts(alerts: DataFrame, path: str) -> None:
    """Append alerts to a Parquet folder by day."""
    dated = alerts.withColumn("alert_date", F.to_date("alert_time"))
    _spread(dated, "alert_date").write.mode("append").partitionBy("alert_date").parquet(path)
