"""Daily roll-ups of audit events that merge exactly over any window of days.

Three Parquet folders: ``users`` gives every user a dense number, for good; ``views`` has the views of each day by
report with the users as bitmaps over these numbers (32,768 to a bitmap); ``touched`` counts what each user did
with each report on a day. Bitmaps are merged by OR, so distinct users of a window are exact. A day is rolled up
again as a whole when events of it arrive late; only its events are read.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.incremental import on_days
from tidemark.plans.reports import VIEW_ACTIVITY
from tidemark.session import materialize, path_exists, session_conf, small_side

DAY = "creation_date"
USERS = "user_id string, number long"
VIEWS = f"report_name string, workspace_name string, bucket long, views long, users binary, {DAY} date"
TOUCHED = f"user_id string, report_id string, activities long, {DAY} date"


def dense_numbers(values: DataFrame, column: str, first: int = 0) -> DataFrame:
    """Distinct values with ``number`` from ``first`` on, without gaps. No value is gathered in one task."""
    placed = values.select(column).distinct().repartitionByRange(column).withColumn("at", F.monotonically_increasing_id())
    placed = materialize(placed.withColumn("part", F.shiftright("at", 33)), "numbers")
    parts = placed.groupBy("part").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("n")).orderBy("part").collect()  # a row a part
    offsets, total = [], first
    for part in parts:
        offsets.append((part["part"], total - part["low"]))
        total += part["n"]
    shifts = F.broadcast(values.sparkSession.createDataFrame(offsets, "part long, shift long"))
    return placed.join(shifts, "part").select(column, (F.col("at") + F.col("shift")).alias("number"))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


class Rollups:
    """The roll-ups in a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def users(self) -> DataFrame:
        return _read(self.spark, f"{self.path}/users", USERS)

    def views(self) -> DataFrame:
        return _read(self.spark, f"{self.path}/views", VIEWS)

    def touched(self) -> DataFrame:
        return _read(self.spark, f"{self.path}/touched", TOUCHED)

    def roll_up(self, events: DataFrame, days: list[date] | None = None) -> None:
        """Replace the roll-ups of the given days (all days of ``events`` if None) by what ``events`` holds for them.

        A day without a date is not rolled up. A repeated or broken run leaves the same roll-ups: numbers are given
        out before they are used, and days are replaced as a whole.
        """
        dated = events.filter(F.col(DAY).isNotNull() if days is None else on_days(DAY, list(days)))
        named = materialize(dated.filter(F.col("user_id").isNotNull()).select("user_id").distinct(), "roll-users")
        new = named.join(self.users(), "user_id", "left_anti")
        highest = self.users().agg(F.max("number")).first()[0]
        dense_numbers(new, "user_id", 0 if highest is None else highest + 1).write.mode("append").parquet(f"{self.path}/users")
        # A user numbered twice by a run that died in between keeps the lower number.
        numbers = self.users().join(named, "user_id", "left_semi").groupBy("user_id").agg(F.min("number").alias("number"))
        viewed = dated.filter(F.col("activity") == VIEW_ACTIVITY).select("user_id", "report_name", "workspace_name", DAY)
        numbered = viewed.join(small_side(numbers), "user_id", "left").withColumn("bucket", F.bitmap_bucket_number("number"))
        views = numbered.groupBy("report_name", "workspace_name", "bucket", DAY).agg(
            F.count(F.lit(1)).alias("views"), F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users")
        )
        touched = dated.filter(F.col("user_id").isNotNull()).groupBy("user_id", "report_id", DAY).agg(F.count(F.lit(1)).alias("activities"))
        for name, frame, schema in (("views", views, VIEWS), ("touched", touched, TOUCHED)):
            columns = [field.split()[0] for field in schema.split(", ")]
            with session_conf(self.spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
                frame.select(columns).hint("rebalance", F.col(DAY)).write.mode("overwrite").partitionBy(DAY).parquet(f"{self.path}/{name}")


def _merged(views: DataFrame, *keys: str) -> DataFrame:
    """Views and distinct users by keys: bitmaps are joined by bucket, then counted."""
    buckets = views.groupBy(*keys, "bucket").agg(F.sum("views").alias("views"), F.bitmap_or_agg("users").alias("users"))
    return buckets.groupBy(*keys).agg(F.sum("views").alias("views"), F.sum(F.bitmap_count("users")).alias("distinct_users"))


def daily_views(rollups: Rollups) -> DataFrame:
    """``reports.daily_views`` from the roll-ups."""
    return _merged(rollups.views(), DAY).orderBy(DAY)


def most_viewed(rollups: Rollups, as_of: date, days: int = 30, top: int | None = None) -> DataFrame:
    """``reports.most_viewed`` from the roll-ups; only the days of the window are read."""
    recent = rollups.views().filter((F.col(DAY) >= F.date_sub(F.lit(as_of), days)) & F.col("report_name").isNotNull())
    ranked = _merged(recent, "report_name", "workspace_name").orderBy(F.desc("views"), "report_name", "workspace_name")
    return ranked if top is None else ranked.limit(top)


def top_users(rollups: Rollups, as_of: date, days: int = 30, top: int = 25) -> DataFrame:
    """``reports.top_users`` from the roll-ups; only the days of the window are read."""
    recent = rollups.touched().filter(F.col(DAY) >= F.date_sub(F.lit(as_of), days))
    by_user = recent.groupBy("user_id").agg(F.sum("activities").alias("total_activities"), F.count_distinct("report_id").alias("distinct_reports"))
    return by_user.orderBy(F.desc("total_activities"), "user_id").limit(top)
