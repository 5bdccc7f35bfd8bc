"""Exact top-k search by inner product over a vector-approximation file.

Building stores, for each vector, one byte a coordinate: the number of the slice of that coordinate's
range it falls in. A query is answered in two scans. The first reads the bytes only: slice edges bound
every score from below and above, and the k-th largest lower bound of each query is a floor its results
can't fall under. The second visits the vectors whose upper bound reaches the floor, best bound first,
and computes exact scores until no bound left reaches the k-th score. Queries run in blocks of bounded
size; neither the vectors nor pairs of vectors are ever shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.tables import stored

SLICES = 256
QUERY_BYTES = 8_000_000
CHUNK = 2048
HELD = 100_000
ROUND = 32
EXACT_IN_DOUBLE = 2.0**53

Edges = dict[int, tuple[np.ndarray, np.ndarray, int]]


def quantized(vectors: DataFrame, scale: int = 1024, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Rows ``vec_id``, ``dim`` and ``exact`` (floor of ``scale`` times each component, as an array of long).

    Vectors that are null, empty or hold null or non-finite components take no part. Repeated rows stay.
    """
    parts = F.col(embedding).cast("array<double>")
    usable = F.coalesce(F.size(parts) > 0, F.lit(False)) & F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    chosen = vectors.where(usable).select(F.col(vec_id).cast("long").alias("vec_id"), parts.alias("parts"))
    return chosen.select("vec_id", F.size("parts").alias("dim"), F.transform("parts", lambda x: F.floor(x * scale)).alias("exact"))


def _edges(vectors: DataFrame) -> Edges:
    """Smallest value, width of a slice and largest magnitude for each dimension: one row a coordinate."""
    rows = vectors.select("dim", F.posexplode("exact").alias("at", "x")).groupBy("dim", "at").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    rows = rows.orderBy("dim", "at").collect()
    out: Edges = {}
    for dim in sorted({r["dim"] for r in rows}):
        low, high = (np.array([r[c] for r in rows if r["dim"] == dim], np.int64) for c in ("low", "high"))
        out[dim] = low, np.maximum(1, -(-(high - low + 1) // SLICES)), int(max(np.abs(low).max(), np.abs(high).max()))
    return out


def _matrix(column: pa.Array, rows: np.ndarray, dim: int, kind: str) -> np.ndarray:
    values = column.take(pa.array(rows))
    return np.frombuffer(b"".join(values.to_pylist()), kind).reshape(len(rows), dim)


class VAFile:
    """A built file: ``frame`` has ``vec_id``, ``dim``, ``cells`` and ``exact`` (both binary)."""

    def __init__(self, vectors: DataFrame):
        self.edges = edges = _edges(vectors)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cells, exact = [], []
                for dim, values in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                    low, width, _ = edges[dim]
                    x = values.values.to_numpy(zero_copy_only=False)
                    cells.append(((x - low) // width).astype(np.uint8).tobytes())
                    exact.append(x.astype("<i8").tobytes())
                yield pa.record_batch(
                    [batch.column(0), batch.column(1), pa.array(cells, pa.binary()), pa.array(exact, pa.binary())], names=["vec_id", "dim", "cells", "exact"]
                )

        self.frame = stored(vectors.mapInArrow(run, "vec_id long, dim int, cells binary, exact binary"), "va-file")


def _bounds(cells: np.ndarray, edges: tuple[np.ndarray, np.ndarray, int]) -> tuple[np.ndarray, np.ndarray]:
    low, width, _ = edges
    floor = low + cells.astype(np.int64) * width
    return floor.astype(float), (floor + width - 1).astype(float)


def _upper(floor: np.ndarray, ceiling: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Largest possible score of every query (row) and vector (column)."""
    return np.maximum(queries, 0) @ ceiling.T + np.minimum(queries, 0) @ floor.T


def _exact(queries: np.ndarray, vectors: np.ndarray, magnitude: int) -> np.ndarray:
    """Scores of paired rows; sums that doubles can't hold exactly are taken over Python integers."""
    if magnitude * magnitude * queries.shape[1] < EXACT_IN_DOUBLE:
        return np.einsum("ij,ij->i", queries.astype(float), vectors.astype(float)).astype(np.int64)
    return np.array([sum(int(a) * int(b) for a, b in zip(q, v, strict=True)) for q, v in zip(queries, vectors, strict=True)], object)


def _best(query: np.ndarray, vec_id: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best entries of every query: high scores, then small ids."""
    order = np.lexsort((vec_id, -score, query))
    place = np.arange(len(order)) - np.searchsorted(query[order], query[order])
    return order[place < k]


class _Visitor:
    """Candidates of one task, visited in order of their bounds."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, magnitude: int, k: int):
        self.ids, self.queries, self.magnitude, self.k = ids, queries, magnitude, k
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0
        self.found = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, object))

    def add(self, query: np.ndarray, vec_id: np.ndarray, bound: np.ndarray, exact: np.ndarray) -> None:
        self.held.append((query, vec_id, bound, exact))
        self.size += len(query)
        if self.size >= HELD:
            self.visit()

    def visit(self) -> None:
        if not self.held:
            return
        query, vec_id, bound, exact = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.held, self.size = [], 0
        order = np.lexsort((-bound, query))
        place = np.arange(len(order)) - np.searchsorted(query[order], query[order])
        for start in range(0, int(place.max()) + 1, ROUND):
            at = order[(place >= start) & (place < start + ROUND)]
            kth = np.full(len(self.ids), -np.inf)
            q, _, s = self.found
            counts = np.bincount(q, minlength=len(self.ids))
            ends = np.cumsum(counts) - 1
            full = counts >= self.k
            kth[full] = s[ends[full]].astype(float)  # found is in order: the last of a query is its k-th
            at = at[bound[at] >= kth[query[at]] * (1 - 1e-12 * np.sign(kth[query[at]]))]
            if not len(at):
                if (counts[np.unique(query)] >= self.k).all():
                    break
                continue
            scores = _exact(self.queries[query[at]], exact[at], self.magnitude).astype(object)
            merged = tuple(np.concatenate(x) for x in zip(self.found, (query[at], vec_id[at], scores), strict=True))
            best = _best(*merged, self.k)
            self.found = tuple(x[best] for x in merged)


def search(file: VAFile, queries: DataFrame, k: int = 10) -> DataFrame:
    """Rows ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` best vectors but the query's own id.

    ``queries`` has the columns of ``quantized``. Only vectors of the query's dimension are candidates;
    a query with fewer than ``k`` of them gets all. Ties go to the smaller id. A query id that repeats is
    searched once, by its smallest vector; repeated candidates are results of their own. Without queries the
    result is empty.
    """
    spark = file.frame.sparkSession
    queries = queries.groupBy("vec_id").agg(F.min(F.struct("dim", "exact")).alias("v")).select("vec_id", "v.dim", "v.exact")
    parts = []
    for dim in file.edges:
        size, held = max(1, QUERY_BYTES // (8 * dim)), []
        for row in queries.where(F.col("dim") == dim).select("vec_id", "exact").toLocalIterator():
            held.append(row)
            if len(held) == size:
                parts.append(_search_block(file, dim, held, k))
                held = []
        if held:
            parts.append(_search_block(file, dim, held, k))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _search_block(file: VAFile, dim: int, rows: list, k: int) -> DataFrame:
    spark, edges = file.frame.sparkSession, file.edges[dim]
    shared = spark.sparkContext.broadcast((np.array([r["vec_id"] for r in rows], np.int64), np.array([r["exact"] for r in rows], np.int64)))
    own = file.frame.where(F.col("dim") == dim)

    def lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = shared.value
        best = np.full((len(ids), k), -np.inf)
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                floor, ceiling = _bounds(_matrix(batch.column(1), np.arange(batch.num_rows), dim, "u1"), edges)
                lower = -_upper(floor, ceiling, -q.astype(float))
                lower[batch.column(0).to_numpy()[None, :] == ids[:, None]] = -np.inf
                best = -np.partition(-np.concatenate([best, lower], axis=1), k - 1, axis=1)[:, :k]
        yield pa.record_batch([pa.array(np.arange(len(ids))), pa.array(list(best), pa.list_(pa.float64()))], names=["query", "best"])

    found = own.select("vec_id", "cells").mapInArrow(lowest, "query long, best array<double>")
    top = found.select("query", F.explode("best").alias("bound")).groupBy("query", "bound").agg(F.count(F.lit(1)).alias("n"))
    running = F.sum("n").over(Window.partitionBy("query").orderBy(F.col("bound").desc()))
    kth = top.withColumn("before", running - F.col("n")).where(F.col("before") < k).groupBy("query").agg(F.min("bound").alias("bound"))
    floors = np.full(len(rows), -np.inf)
    for r in kth.collect():  # a row a query of the block
        floors[r["query"]] = r["bound"]
    least = spark.sparkContext.broadcast(floors)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = shared.value
        visitor = _Visitor(ids, q, edges[2], k)
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                floor, ceiling = _bounds(_matrix(batch.column(1), np.arange(batch.num_rows), dim, "u1"), edges)
                vec_ids = batch.column(0).to_numpy()
                upper = _upper(floor, ceiling, q.astype(float))
                reach = upper >= least.value[:, None] * (1 - 1e-12 * np.sign(least.value))[:, None]
                reach &= vec_ids[None, :] != ids[:, None]
                query, vector = np.nonzero(reach)
                if len(query):
                    some, where = np.unique(vector, return_inverse=True)
                    exact = _matrix(batch.column(2), some, dim, "<i8")
                    for start in range(0, len(query), HELD):
                        part = slice(start, start + HELD)
                        visitor.add(query[part], vec_ids[vector[part]], upper[query[part], vector[part]], exact[where[part]])
        visitor.visit()
        query, vec_id, score = visitor.found
        yield pa.record_batch(
            [pa.array(ids[query]), pa.array(vec_id), pa.array([int(s) for s in score], pa.int64())], names=["query_id", "vec_id", "score"]
        )

    results = own.select("vec_id", "cells", "exact").mapInArrow(visit, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return results.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
