"""The ids of a store in a side table of hash buckets, so that a lookup reads only the buckets of its batch.

Commits keep the index: they announce the ids they are about to store, store the rows, and record the ids. A
commit that dies leaves its announcement; the next one asks the store which of those ids it holds (in the places,
days or months, of the announcement only) and records these. So index and store agree at the start of every
commit. One writer at a time, as for the stores themselves.

Layout of the folder, which readers of the store skip: ``state.json`` (key, place, buckets, generation, commits),
``generation=N/bucket=B`` (id and place) and ``pending/COMMIT``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import materialize, path_exists, read_replaced, remove_folder, replace_text, small_side, subfolders

FOLDER = "_id_index"
BUCKET = "bucket"
BUCKETS = 1024
COMPACT_AFTER = 64


@dataclass(frozen=True)
class State:
    """What ``state.json`` says: columns, number of buckets, the generation in use and the commits since it was made."""

    key: str
    place: str
    place_type: str
    buckets: int = BUCKETS
    generation: int = 0
    commits: int = 0


class IdIndex:
    """The index in the folder of a store."""

    def __init__(self, spark: SparkSession, store: str):
        self.spark, self.path = spark, f"{store}/{FOLDER}"

    def exists(self) -> bool:
        return read_replaced(self.spark, f"{self.path}/state.json") is not None

    @property
    def state(self) -> State:
        return State(**json.loads(read_replaced(self.spark, f"{self.path}/state.json")))

    def _set(self, state: State) -> None:
        replace_text(self.spark, f"{self.path}/state.json", json.dumps(asdict(state)))

    def _generation(self, number: int) -> str:
        return f"{self.path}/generation={number}"

    def _schema(self, state: State) -> str:
        return f"`{state.key}` string, `{state.place}` {state.place_type}, {BUCKET} int"

    def bucket(self, state: State) -> Column:
        """The bucket of an id."""
        return F.pmod(F.xxhash64(state.key), F.lit(state.buckets)).cast("int")

    def create(self, rows: DataFrame, key: str, place: str, buckets: int = BUCKETS) -> None:
        """Index the rows of a store; ``key`` is text."""
        state = State(key, place, dict(rows.dtypes)[place], buckets)
        self._write(rows.select(key, place), state)
        self._set(state)

    def _write(self, ids: DataFrame, state: State) -> None:
        """Ids that are not null, once each, sorted inside one file a bucket."""
        named = ids.filter(F.col(state.key).isNotNull()).distinct().withColumn(BUCKET, self.bucket(state))
        spread = named.repartition(BUCKET).sortWithinPartitions(BUCKET, state.key)
        spread.write.mode("overwrite").partitionBy(BUCKET).parquet(self._generation(state.generation))

    def ids(self) -> DataFrame:
        """All ids with their places (an id once for every commit that recorded it)."""
        state = self.state
        return self.spark.read.schema(self._schema(state)).parquet(self._generation(state.generation)) if self._filled(state) else self.spark.createDataFrame([], self._schema(state))

    def _filled(self, state: State) -> bool:
        return path_exists(self.spark, self._generation(state.generation))

    def lookup(self, ids: DataFrame) -> DataFrame:
        """Key and place of those of the stored batch ``ids`` that the store holds.

        The buckets of the batch are listed as literals, so the plan reads their folders only.
        """
        state = self.state
        wanted = ids.select(state.key).filter(F.col(state.key).isNotNull()).distinct()
        touched = sorted(row[0] for row in wanted.select(self.bucket(state).alias(BUCKET)).distinct().collect())  # at most ``buckets``
        near = self.ids().filter(F.col(BUCKET).isin(touched)).select(state.key, state.place)
        return near.join(small_side(wanted), state.key, "left_semi").distinct()

    def announce(self, rows: DataFrame) -> str:
        """State the ids that are about to be stored; returns the name of the announcement."""
        state, name = self.state, uuid.uuid4().hex
        rows.select(state.key, state.place).write.parquet(f"{self.path}/pending/{name}")
        return name

    def record(self, name: str, only: DataFrame | None = None) -> None:
        """Move announced ids into the index: all, or those in ``only``."""
        state = self.state
        folder = f"{self.path}/pending/{name}"
        ids = self.spark.read.schema(self._schema(state).rsplit(",", 1)[0]).parquet(folder)
        if only is not None:
            ids = ids.join(only.select(state.key).distinct(), state.key, "left_semi")
        named = ids.filter(F.col(state.key).isNotNull()).withColumn(BUCKET, self.bucket(state)).repartition(BUCKET).sortWithinPartitions(BUCKET, state.key)
        named.write.mode("append").partitionBy(BUCKET).parquet(self._generation(state.generation))
        remove_folder(self.spark, folder)
        state = replace(state, commits=state.commits + 1)
        self._set(state)
        if state.commits >= COMPACT_AFTER:
            self.compact()

    def settle(self, stored: Callable[[DataFrame], DataFrame]) -> None:
        """Record what commits that died have stored. ``stored`` finds, of announced rows (key, place), those the store holds."""
        for name in subfolders(self.spark, f"{self.path}/pending"):
            folder = f"{self.path}/pending/{name}"
            if path_exists(self.spark, f"{folder}/_SUCCESS"):
                pending = self.spark.read.schema(self._schema(self.state).rsplit(",", 1)[0]).parquet(folder)
                self.record(name, materialize(stored(pending), "settled"))
            else:
                remove_folder(self.spark, folder)  # nothing is stored before its announcement is whole

    def compact(self) -> None:
        """Write one file a bucket again, as the next generation."""
        state = self.state
        after = replace(state, generation=state.generation + 1, commits=0)
        self._write(self.ids().select(state.key, state.place), after)
        self._set(after)
        remove_folder(self.spark, self._generation(state.generation))
