"""Exact Jaccard self-join of documents' word n-gram sets over count vectors.

Shingles are hashed into groups. Two sets that are similar enough differ in at most ``d`` shingles, where
``d`` follows from the threshold and the larger allowed size; with more than ``d`` groups, some group
holds the same shingles in both. So documents meet by the contents of a group, a lossless distribution of
the join: sizes are cut into classes a threshold apart, a document deals its groups once with the number
of groups of its own class and once with that of the class below. Documents with so many empty groups
that the argument could fail deal again under another hash, and at last shingle by shingle.

Documents that meet are linked in two rounds. First each with the smallest document it met. Then, where a
meeting still spans several components, its members' count vectors (shingles in each of ``AXES`` coarser
groups) are points of R-trees, whose nodes are joined while the sum of coordinate minima of their upper
corners can reach the overlap a link needs. Whatever survives this bound is verified on the exact sets.

Equal sets are one node. Nodes are named by a 64-bit hash of their set, shingles by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.arrays import BASE, mixed, slices, utf8, windows, words_of
from tidemark.llm.components import components
from tidemark.llm.tables import stored
from tidemark.llm.workers import claim
from tidemark.session import small_side

AXES = 256
FULL = 255  # stands for this count or more
LEAF, FANOUT = 16, 8
BLOCK = 1024
MINIMA = 4096  # pairs whose coordinate minima are held at once
MOST_MARKS = 50_000_000  # of members and keys of one block
SEEN = 200_000
SEEDS = 4
ROWS = 512


@dataclass(frozen=True)
class Join:
    """Shingle width in words, and the least Jaccard similarity of a link in percent."""

    width: int = 4
    percent: int = 85

    def reaches(self, overlap, size_a, size_b):
        """Whether an overlap of two sets (or a bound of it) makes a link."""
        return (100 + self.percent) * overlap >= self.percent * (size_a + size_b)

    def most(self, size: int) -> int:
        """Largest size of a set that may link with a smaller one of ``size``."""
        return 100 * size // self.percent

    def differences(self, size: int) -> int:
        """Most shingles in just one of two linked sets, the smaller of which has at most ``size``."""
        return (100 - self.percent) * size // self.percent

    def classes(self, largest: int) -> np.ndarray:
        """Largest size of each class, up to the one that holds ``largest``."""
        tops, low = [], 1
        while not tops or tops[-1] < largest:
            tops.append(max(low, self.most(low)))
            low = tops[-1] + 1
        return np.array(tops, np.int64)

    def groups(self, top: int) -> int:
        """Groups for the class up to ``top``: more than the differences, with some to spare for empty ones."""
        d = self.differences(top)
        return d + 2 + math.ceil(0.1 * d)


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text, A-Z lower-cased; a text of fewer words has its whole row of words."""
    out: list[np.ndarray] = []
    for _, part in slices(texts):
        words = words_of(part, lower=True)
        hashes = words.hashes()
        keys, at = windows(hashes, words.text, width)
        cut = np.searchsorted(words.text[at], np.arange(len(part) + 1))
        counts = np.diff(words.first)
        for i in range(len(part)):
            if counts[i] >= width:
                out.append(np.unique(keys[cut[i] : cut[i + 1]]))
            elif counts[i]:
                value = np.zeros(1, np.uint64)
                for h in hashes[words.first[i] : words.first[i + 1]]:
                    value = value * BASE + h
                out.append(mixed(value + np.uint64(counts[i])))
            else:
                out.append(np.empty(0, np.uint64))
    return out


def _node(shingles: np.ndarray) -> int:
    return int(mixed(np.array([shingles.sum(dtype=np.uint64) + np.uint64(len(shingles))])).view(np.int64)[0])


def _part(shingles: np.ndarray, parts: int) -> np.ndarray:
    return ((shingles >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _vector(shingles: np.ndarray) -> np.ndarray:
    return np.bincount((shingles & np.uint64(AXES - 1)).astype(np.int64), minlength=AXES)


def _shown(vector: np.ndarray) -> bytes:
    """A count vector in bytes."""
    return np.minimum(vector, FULL).astype(np.uint8).tobytes()


def _read(vectors: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Count vectors; a count too large for a byte is read as the size of its set, which bounds it."""
    counts = np.frombuffer(b"".join(vectors), np.uint8).reshape(-1, AXES).astype(np.int32)
    return np.where(counts == FULL, sizes[:, None].astype(np.int32), counts)


def meeting_keys(shingles: np.ndarray, join: Join, tops: np.ndarray) -> np.ndarray:
    """Keys by which a set meets every set it may link with."""
    own = int(np.searchsorted(tops, len(shingles)))
    out = []
    for level in (own, own - 1):
        if level < 0 or not join.differences(int(tops[level])):
            continue  # sets of this class link with equal sets only
        allowed, parts = join.differences(int(tops[level])), join.groups(int(tops[level]))
        for seed in range(SEEDS):
            spread = mixed(shingles + np.uint64(seed + 1))
            part = _part(spread, parts)
            low = np.bincount(part, (spread & np.uint64(0xFFFFFFFF)).astype(float), parts).astype(np.uint64)
            high = np.bincount(part, (spread >> np.uint64(32)).astype(float), parts).astype(np.uint64)
            filled = np.flatnonzero(np.bincount(part, minlength=parts))
            place = mixed(((np.uint64(level) << np.uint64(3)) + np.uint64(seed) << np.uint64(40)) + filled.astype(np.uint64))
            out.append(mixed(low[filled] + (high[filled] << np.uint64(32)) + place))
            if len(filled) > allowed:
                break
        else:
            out.append(mixed(shingles ^ np.uint64(level)))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _sets(docs: DataFrame, join: Join, doc_id: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                sets = shingle_sets(utf8(batch.column(1)), join.width)
                out = [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([_node(s) for s in sets], pa.int64())]
                yield pa.record_batch(out, names=["doc_id", "n_shingles", "node"])

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, "doc_id long, n_shingles long, node long")


def _meetings(docs: DataFrame, join: Join, text: str, largest: int) -> DataFrame:
    """Rows ``key``, ``node``, ``pivot``: the members of every meeting of two or more nodes, and its smallest.

    Each task deals equal sets once. Meetings are found in a sorted pass, so that a meeting of any size is
    never held.
    """
    tops = join.classes(max(1, largest))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        seen: set[int] = set()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                keys, nodes = [], []
                for shingles in shingle_sets(utf8(whole.column(0).slice(at, ROWS)), join.width):
                    node = _node(shingles)
                    if not len(shingles) or node in seen:
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(node)
                    keys.append(meeting_keys(shingles, join, tops))
                    nodes.append(np.full(len(keys[-1]), node, np.int64))
                if keys:
                    yield pa.record_batch([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(nodes))], names=["key", "node"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last row waits for the next batch, which may go on with its key.
        last_key = last_node = pivot = None
        open_group = False
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, nodes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if last_key is not None:
                keys, nodes = np.concatenate([[last_key], keys]), np.concatenate([[last_node], nodes])
            fresh = np.ones(len(keys), bool)
            fresh[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
            keys, nodes = keys[fresh], nodes[fresh]
            begins = np.ones(len(keys), bool)
            begins[1:] = keys[1:] != keys[:-1]
            first = np.flatnonzero(begins)
            group = np.cumsum(begins) - 1
            pivots = nodes[first][group]
            members = np.diff(np.append(first, len(keys)))[group]
            if open_group:  # its smallest member left with an earlier batch
                pivots[group == 0] = pivot
                members[group == 0] += 1
            shown = members > 1
            last_key, last_node, pivot = keys[-1], nodes[-1], pivots[-1]
            open_group = bool(shown[-1])
            given = shown.copy()
            given[-1] = False
            yield pa.record_batch([pa.array(keys[given]), pa.array(nodes[given]), pa.array(pivots[given])], names=["key", "node", "pivot"])
        if last_key is not None and open_group:
            yield pa.record_batch([pa.array([last_key]), pa.array([last_node]), pa.array([pivot])], names=["key", "node", "pivot"])

    dealt = docs.select(F.col(text)).mapInArrow(deal, "key long, node long")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = dealt.repartition(parts, "key").sortWithinPartitions("key", "node")
    return sorted_rows.mapInArrow(meet, "key long, node long, pivot long")


def _points(docs: DataFrame, sets: DataFrame, nodes: DataFrame, join: Join, doc_id: str, text: str) -> DataFrame:
    """Rows ``node``, ``size``, ``counts`` (count vector) and ``shingles`` of the given nodes, from one document each."""
    chosen = small_side(sets.where("n_shingles > 0").join(small_side(nodes), "node").groupBy("node").agg(F.min("doc_id").alias("_id"), F.first("n_shingles").alias("_n")))
    texts = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text")).join(chosen, "_id").select("_text", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                wanted = batch.column(1).to_pylist()
                found = [(n, s) for n, s in zip(wanted, shingle_sets(utf8(batch.column(0)), join.width), strict=True) if _node(s) == n]
                columns = [
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([len(s) for _, s in found], pa.int64()),
                    pa.array([_shown(_vector(s)) for _, s in found], pa.binary()),
                    pa.array([s.astype("<u8").tobytes() for _, s in found], pa.binary()),
                ]
                yield pa.record_batch(columns, names=["node", "size", "counts", "shingles"])

    return texts.mapInArrow(run, "node long, size long, counts binary, shingles binary").dropDuplicates(["node"])


def _overlaps(pairs: DataFrame, points: DataFrame, column: str, join: Join) -> DataFrame:
    """The pairs (``a``, ``b``) whose overlap in ``column`` reaches a link: a bound for ``counts``, exact for ``shingles``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes_a, sizes_b = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            if column == "counts":
                a, b = (_read(batch.column(i).to_pylist(), n) for i, n in ((4, sizes_a), (5, sizes_b)))
                overlap = np.minimum(a, b).sum(axis=1)
            else:
                sides = zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)
                overlap = np.array([len(np.intersect1d(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), True)) for x, y in sides], np.int64)
            at = np.flatnonzero(join.reaches(overlap, sizes_a, sizes_b))
            yield pa.record_batch([batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at))], names=["a", "b"])

    side = points.select("node", "size", column)
    a = side.select(F.col("node").alias("a"), F.col("size").alias("size_a"), F.col(column).alias("left"))
    b = side.select(F.col("node").alias("b"), F.col("size").alias("size_b"), F.col(column).alias("right"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "size_a", "size_b", "left", "right")
    return both.mapInArrow(run, "a long, b long")


def _links(pairs: DataFrame, points: DataFrame, join: Join) -> DataFrame:
    near = stored(_overlaps(pairs, points, "counts", join), "jaccard-near")
    return stored(_overlaps(near, points, "shingles", join), "jaccard-links")


class CountTree:
    """A packed R-tree of count vectors: nodes keep the upper corner, and the sizes, of what they hold."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        spread = np.argsort(-points.var(axis=0), kind="stable")[:3] if len(points) else np.arange(3)
        self.order = np.lexsort((*points[:, spread].T[::-1], sizes))
        tops, lows, highs = points[self.order], sizes[self.order], sizes[self.order]
        self.levels = [(tops, lows, highs)]
        width = LEAF
        while len(tops) > 1:
            starts = np.arange(0, len(tops), width)
            tops, lows, highs = np.maximum.reduceat(tops, starts), np.minimum.reduceat(lows, starts), np.maximum.reduceat(highs, starts)
            self.levels.append((tops, lows, highs))
            width = FANOUT

    def join(self, other: CountTree, join: Join) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the points of both trees whose bound reaches a link; the shallower tree waits for the deeper."""
        a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)
        if not len(self.order) or not len(other.order):
            return a[:0], b[:0]
        i, j = len(self.levels) - 1, len(other.levels) - 1
        while True:
            (tops_a, lows_a, highs_a), (tops_b, lows_b, highs_b) = self.levels[i], other.levels[j]
            keep = (100 * highs_a[a] >= join.percent * lows_b[b]) & (100 * highs_b[b] >= join.percent * lows_a[a])
            a, b = a[keep], b[keep]
            keep = np.zeros(len(a), bool)
            for at in range(0, len(a), MINIMA):
                part = slice(at, at + MINIMA)
                bound = np.minimum(tops_a[a[part]], tops_b[b[part]]).sum(axis=1)
                keep[part] = join.reaches(bound, lows_a[a[part]], lows_b[b[part]])
            a, b = a[keep], b[keep]
            if i == 0 and j == 0:
                return self.order[a], other.order[b]
            if i >= j:
                a, b, i = *self._down(a, b, i), i - 1
            else:
                b, a, j = *other._down(b, a, j), j - 1

    def _down(self, node: np.ndarray, partner: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        width = LEAF if level == 1 else FANOUT
        child = node[:, None] * width + np.arange(width)
        partner = np.broadcast_to(partner[:, None], child.shape)
        real = child < len(self.levels[level - 1][0])
        return child[real], partner[real]


def _met_before(key: int, keys: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether two members of the meeting ``key`` also meet under a smaller key (``keys`` has the smaller ones of each member)."""
    lower = [k[k < key] for k in keys]
    columns, at = np.unique(np.concatenate(lower), return_inverse=True)
    if not len(columns) or len(columns) * len(keys) > MOST_MARKS:
        return np.zeros(len(a), bool)  # a pair may then come out more than once
    marks = np.zeros((len(keys), len(columns)), bool)
    marks[np.repeat(np.arange(len(keys)), [len(k) for k in lower]), at] = True
    packed = np.packbits(marks, axis=1)
    out = np.zeros(len(a), bool)
    for start in range(0, len(a), MINIMA):
        part = slice(start, start + MINIMA)
        out[part] = (packed[a[part]] & packed[b[part]]).any(axis=1)
    return out


def _meeting_pairs(key: int, nodes: np.ndarray, parts: np.ndarray, sizes: np.ndarray, points: np.ndarray, side: np.ndarray, keys: np.ndarray, join: Join) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a block whose bound reaches a link, whose components differ and that meet here first.

    Side 0 meets side 1, or itself where there is no side 1.
    """
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    itself = not len(right)
    first = CountTree(points[left], sizes[left])
    a, b = first.join(first if itself else CountTree(points[right], sizes[right]), join)
    a, b = left[a], (left if itself else right)[b]
    keep = parts[a] != parts[b]
    if itself:
        keep &= nodes[a] < nodes[b]
    a, b = a[keep], b[keep]
    keep = ~_met_before(key, keys, a, b)
    return nodes[a[keep]], nodes[b[keep]]


def _block_pairs(join: Join):
    """A ``mapInArrow`` function over rows sorted by block; a block goes on in the next batch until another one begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] | None = None

        def pairs(columns: list[np.ndarray]) -> pa.RecordBatch:
            block = columns[0]
            cuts = [0, *(np.flatnonzero((block[1:] != block[:-1]).any(axis=1)) + 1), len(block)]
            found = [_meeting_pairs(block[i, 0], *(c[i:j] for c in columns[1:]), join) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
            return pa.record_batch([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], names=["a", "b"])

        for whole in batches:
            for at in range(0, whole.num_rows, 4 * BLOCK):
                batch = whole.slice(at, 4 * BLOCK)
                block = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
                points = _read(batch.column(7).to_pylist(), batch.column(6).to_numpy())
                keys = np.empty(batch.num_rows, object)
                keys[:] = [np.asarray(k, np.int64) for k in batch.column(8).to_pylist()]
                columns = [block, *(batch.column(i).to_numpy() for i in (4, 5, 6)), points, batch.column(3).to_numpy(), keys]
                if waiting is not None:
                    columns = [np.concatenate(x) for x in zip(waiting, columns, strict=True)]
                last = columns[0][-1]
                open_from = int(np.flatnonzero((columns[0] != last).any(axis=1))[-1]) + 1 if (columns[0] != last).any() else 0
                if open_from:
                    yield pairs([c[:open_from] for c in columns])
                waiting = [c[open_from:] for c in columns]
        if waiting is not None:
            yield pairs(waiting)

    return run


def _open_pairs(meetings: DataFrame, found: DataFrame, points: DataFrame, join: Join, block: int) -> DataFrame:
    """Pairs to verify in meetings that still span several components, by R-trees over blocks of their members."""
    named = meetings.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    spans = named.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("who")
    )
    # Many keys hold the same members; one of them is enough.
    open_keys = spans.where("low <> high and n > 2").groupBy("n", "who").agg(F.min("key").alias("key"))
    members = stored(named.join(open_keys.select("key", "n"), "key"), "jaccard-open")
    keys = members.groupBy("node").agg(F.sort_array(F.collect_list("key")).alias("keys"))  # as many as a set has groups
    members = members.join(points.select("node", "size", "counts").join(keys, "node"), "node")
    blocks = F.ceil(F.col("n") / block).cast("long")
    own = F.pmod(F.xxhash64("node"), blocks)
    # A member goes to the meeting of its block with itself and with every other block of a large meeting.
    others = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda x: F.struct(F.least(x, own).alias("i"), F.greatest(x, own).alias("j"), (x < own).cast("int").alias("side")))
    # Only smaller keys tell whether two members met before.
    members = members.withColumn("keys", F.filter("keys", lambda x: x < F.col("key")))
    dealt = members.withColumn("blocks", F.explode(others)).select("key", "blocks.i", "blocks.j", "blocks.side", "node", "component", "size", "counts", "keys")
    parts = int(meetings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_blocks = dealt.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    pairs = sorted_blocks.mapInArrow(_block_pairs(join), "a long, b long")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def jaccard_components(docs: DataFrame, join: Join | None = None, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row a document: ``doc_id``, ``n_shingles`` (of its set) and ``component_id`` (smallest id reachable by links).

    Documents with equal sets are linked. A document without words (or a null text) has an empty set and
    is linked with nothing; a null id is linked with nothing and stays null. Rows that share an id each get
    their component. Links inside a component that is already complete are not listed.
    """
    join = join or Join()
    sets = stored(_sets(docs, join, doc_id, text), "jaccard-sets")
    largest = sets.agg(F.max("n_shingles")).first()[0] or 0
    meetings = stored(_meetings(docs, join, text, largest), "jaccard-meetings")
    star = stored(meetings.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct(), "jaccard-star")
    nodes = stored(star.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "jaccard-nodes")
    points = stored(_points(docs, sets, nodes, join, doc_id, text), "jaccard-points")
    links = _links(star, points, join)
    found = components(links)
    links = links.unionByName(_links(stored(_open_pairs(meetings, found, points, join, block), "jaccard-pairs"), points, join))
    found = components(links)
    named = sets.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = stored(named.select("doc_id", "n_shingles", "component"), "jaccard-named")
    linked = named.where("n_shingles > 0 and doc_id is not null")
    least = linked.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    joined = linked.join(least, "component", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    alone = named.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return joined.unionByName(alone)
