"""Merkle manifest of a table by time-forward processing.

Every record is a leaf. The leaves of a tree, in their order, are hashed in runs of ``FAN`` nodes, level by
level, until one node remains; the roots of all trees are the leaves of one tree above them.

A node's label is (last leaf below it, height), so a sweep over the leaves meets children before parents.
The upward sweep sends each digest to its parent's label through a priority queue; when the least label in
the queue lies behind the sweep, that node has all its messages. The downward sweep goes through the labels
in reverse and sends each node what its proof needs from there on up; a leaf's message is the rest of its
proof. The queue is external: a task sweeps blocks of ``FAN ** HEIGHTS`` consecutive nodes, with open runs
only in its own queue, and messages that leave a block are a written table, dealt by label to the next
sweep. Each sweep climbs ``HEIGHTS`` levels, so ten billion leaves take three.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.ordering import numbered
from tidemark.llm.tables import stored

FAN = 16
HEIGHTS = 3
BLOCK = FAN**HEIGHTS
ROWS = 512
NODES = "tree string, index long, n long, digest string"
SWEPT = "tree string, index long, n long, height int, last long, digests array<string>, digest string"
MESSAGES = "left array<string>, right array<string>, tree_root string"


def record_text(columns: list[Column]) -> Column:
    """One text for a record: each value as its UTF-8 byte count, a colon and the value; ``-`` for null."""
    values = [c.cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values])


def record_digest(columns: list[Column]) -> Column:
    """Lowercase hex SHA-256 of a record."""
    return F.sha2(record_text(columns), 256)


def hashed(digests: list[str]) -> str:
    """Digest of a run of nodes."""
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def height_of(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def last_leaf(index: int, height: int, n: int) -> int:
    """The last of ``n`` leaves below a node."""
    return min((index + 1) * FAN**height, n) - 1


def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Upward sweep over nodes sorted by tree and index: runs with their children's digests, and the block's top with its digest."""
    queue: list[tuple[int, int, int, int, str]] = []  # last, height, index of the receiver, slot, digest
    schema = pa.schema([("tree", pa.string()), ("index", pa.int64()), ("n", pa.int64()), ("height", pa.int32()), ("last", pa.int64()), ("digests", pa.list_(pa.string())), ("digest", pa.string())])
    for batch in batches:
        rows = []
        for tree, index, n, digest in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            top = min(HEIGHTS, height_of(n))
            if not top:
                rows.append((tree, index, n, 0, index, None, digest))
                continue
            heapq.heappush(queue, (last_leaf(index // FAN, 1, n), 1, index // FAN, index % FAN, digest))
            while queue and queue[0][0] <= index:
                last, height, place = queue[0][:3]
                digests = []
                while queue and queue[0][:3] == (last, height, place):
                    digests.append(heapq.heappop(queue)[4])
                own = hashed(digests)
                rows.append((tree, place, n, height, last, digests, own if height == top else None))
                if height < top:
                    heapq.heappush(queue, (last_leaf(place // FAN, height + 1, n), height + 1, place // FAN, place % FAN, own))
        for start in range(0, len(rows), ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[start : start + ROWS], strict=True), schema, strict=True)], schema=schema)


def descend(names: list[str]):
    """Downward sweep over nodes sorted by tree and falling label: gives each leaf of the block its message.

    The columns are tree, last, height, index, digests, left, right, tree_root and then ``names``, which leaves
    keep. A row without digests and of height above ``HEIGHTS`` is a message to the top of its block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue: list[tuple[int, int, int, list[str], list[str], str]] = []
        arriving: tuple[list[str], list[str], str] | None = None
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                leaves, messages = [], []
                last, height, index, digests, left, right, root = (batch.column(i).to_pylist() for i in range(1, 8))
                for i in range(batch.num_rows):
                    if height[i] > HEIGHTS:
                        arriving = (left[i], right[i], root[i])
                        continue
                    if arriving is not None:  # the top of the block
                        message, arriving = arriving, None
                    else:
                        message = heapq.heappop(queue)[3:]
                    if height[i]:
                        for slot in range(len(digests[i])):
                            child = index[i] * FAN + slot
                            end = last[i] if slot == len(digests[i]) - 1 else (child + 1) * FAN ** (height[i] - 1) - 1
                            lefts = ["".join(digests[i][:slot]), *message[0]]
                            rights = ["".join(digests[i][slot + 1 :]), *message[1]]
                            heapq.heappush(queue, (-end, -(height[i] - 1), child, lefts, rights, message[2]))
                    else:
                        leaves.append(i)
                        messages.append(message)
                if leaves:
                    kept = batch.select(["tree", "index", *names]).take(pa.array(leaves))
                    sides = [pa.array([m[k] for m in messages], pa.list_(pa.string())) for k in (0, 1)]
                    yield pa.RecordBatch.from_arrays([*kept.columns, *sides, pa.array([m[2] for m in messages], pa.string())], names=[*kept.schema.names, "left", "right", "tree_root"])

    return run


@dataclass(frozen=True)
class Forest:
    """Trees of one sweep after another: the nodes each began with, the runs it made, and the roots (``tree``, ``digest``)."""

    nodes: list[DataFrame]
    swept: list[DataFrame]
    roots: DataFrame


def grow(leaves: DataFrame) -> Forest:
    """Upward sweeps over numbered leaves (``tree``, ``index``, ``n``, ``digest`` and any others)."""
    largest = leaves.agg(F.max("n")).first()[0] or 0
    nodes, swept = [leaves], []
    for _ in range(max(1, -(-height_of(largest) // HEIGHTS))):
        block = F.floor(F.col("index") / BLOCK)
        dealt = nodes[-1].select("tree", "index", "n", "digest").withColumn("block", block).repartition("tree", "block").sortWithinPartitions("tree", "block", "index")
        swept.append(stored(dealt.select("tree", "index", "n", "digest").mapInArrow(climb, SWEPT), "merkle-runs"))
        tops = swept[-1].where("digest is not null")
        nodes.append(tops.select("tree", F.floor(F.col("last") / BLOCK).alias("index"), F.ceil(F.col("n") / BLOCK).alias("n"), "digest"))
    return Forest(nodes, swept, nodes[-1].select("tree", "digest"))


def deliver(forest: Forest, messages: DataFrame, names: list[str]) -> DataFrame:
    """Downward sweeps: the leaves with ``names`` and the messages that reach them.

    ``messages`` has a row for each tree: ``tree``, ``left``, ``right`` (siblings above its root) and ``tree_root``.
    """
    messages = messages.withColumn("index", F.lit(0).cast("long"))
    for step in reversed(range(len(forest.swept))):
        kept = names if step == 0 else []
        none = [F.lit(None).cast("array<string>").alias(c) for c in ("digests", "left", "right")]
        no_root, no_names = F.lit(None).cast("string").alias("tree_root"), [F.lit(None).alias(c) for c in kept]
        base = [F.col(c) for c in ("tree", "index")]
        leaves = forest.nodes[step].select(*base, F.col("index").alias("last"), F.lit(0).alias("height"), *none, no_root, *kept)
        runs = forest.swept[step].where("height > 0").select(*base, "last", "height", "digests", *none[1:], no_root, *no_names)
        # A message comes first in its block.
        to_top = messages.select(
            "tree", "index", ((F.col("index") + 1) * BLOCK - 1).alias("last"), F.lit(HEIGHTS + 1).alias("height"), none[0], "left", "right", "tree_root", *no_names
        )
        rows = leaves.unionByName(runs).unionByName(to_top).withColumn("block", F.floor(F.col("last") / BLOCK))
        order = [F.col("tree"), F.col("block"), F.col("last").desc(), F.col("height").desc()]
        dealt = rows.repartition("tree", "block").sortWithinPartitions(*order).select("tree", "last", "height", "index", "digests", "left", "right", "tree_root", *kept)
        types = dict(forest.nodes[step].dtypes)
        schema = ", ".join(["tree string, index long", *(f"`{c}` {types[c]}" for c in kept), MESSAGES])
        messages = dealt.mapInArrow(descend(kept), schema)
        if step:
            messages = stored(messages, "merkle-messages")
    return messages


def tree_name(column: str) -> Column:
    """A tree's key from a nullable column: null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("+"), F.col(column).cast("string")), F.lit(""))


def merkle_proofs(records: DataFrame, tree: str, order: str, digest: str = "leaf") -> DataFrame:
    """The records with their proofs: ``left`` and ``right`` (hex texts of the siblings on either side, level by level from the leaf's run to the root), ``subroot`` and ``root``.

    ``records`` has one row a leaf with its ``digest``, its ``tree`` (null is a tree of its own, the first one) and
    its ``order`` in the tree, nulls first; rows of equal order go by digest, equal rows are leaves of their own.
    All columns of ``records`` stay, but names of columns above and ``tree``, ``index`` and ``n`` belong to the
    result. A level where a node has no siblings counts with empty texts. No records give no rows.
    """
    names = [f"_{i}" for i in range(len(records.columns))]
    renamed = stored(records.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(records.columns, names, strict=True)], tree_name(tree).alias("tree"), F.col(digest).alias("digest")), "merkle-leaves")
    forest = grow(numbered(renamed, "tree", names[records.columns.index(order)], "digest"))
    upper = grow(numbered(forest.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), "tree", "name"))
    root = upper.roots.first()
    whole = upper.roots.select("tree", F.array().cast("array<string>").alias("left"), F.array().cast("array<string>").alias("right"), F.col("digest").alias("tree_root"))
    above = deliver(upper, whole, ["name", "digest"])
    messages = stored(above.select(F.col("name").alias("tree"), "left", "right", F.col("digest").alias("tree_root")), "merkle-messages")
    leaves = deliver(forest, messages, names)
    given = [F.col(n).alias(c) for c, n in zip(records.columns, names, strict=True) if c not in ("left", "right", "subroot", "root")]
    return leaves.select(*given, "left", "right", F.col("tree_root").alias("subroot"), F.lit(root.digest if root else None).cast("string").alias("root"))


def proof_text(left: str = "left", right: str = "right") -> Column:
    """All siblings of a proof, level by level, left to right."""
    return F.array_join(F.zip_with(left, right, lambda a, b: F.concat(a, b)), "")


def folded(leaf: Column, left: str = "left", right: str = "right") -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(F.arrays_zip(left, right), leaf, lambda found, level: F.sha2(F.concat(level[left], found, level[right]), 256))
