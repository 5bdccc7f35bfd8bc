"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

All distinct fingerprints are the leaves of one binary trie over their 64 bits, the most evenly split bits
first. Pairs of nodes of equal depth are walked together from (root, root): the bits in which the two paths
differ are counted, and a pair is dropped once they exceed the budget. The upper trie is a table. Its first
``FIRST`` levels are taken at once, which spreads the work at any size; then each round takes the pairs whose
nodes hold more than ``LEAVES`` fingerprints ``STEP`` levels down. Both are equality joins on paths with up to
the budget of their bits flipped. Smaller pairs are walked to the end inside a task, over sorted arrays: a task
holds the fingerprints below one node, and those below each of its partners pass by. Every pair gives a
spanning forest of its links, so that a dense group costs no more rows than it has members in a pair.
Distinct fingerprints have at most 2,080 neighbours within two bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.arrays import slices, utf8
from tidemark.llm.components import components
from tidemark.llm.ordering import join_hot
from tidemark.llm.tables import stored
from tidemark.session import small_side

BITS = 64
WIDTH = 3
BUDGET = 2
SEED = 42
LEAVES = 32_768
FIRST = 8
STEP = 4
TINY = 64  # products of node sizes up to this are compared at once
PAIRS = 1 << 15  # node pairs walked at once
PRODUCTS = 1 << 18  # leaf pairs compared at once
PART_BYTES = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0D]")
BITS_OF_BYTE = (np.arange(256)[:, None] >> np.arange(8)) & 1


def word_parts(text: bytes, most: int = PART_BYTES) -> Iterator[list[bytes]]:
    """Words of a text with A-Z lower-cased, in parts of about ``most`` bytes that end between words."""
    at = 0
    while at < len(text):
        end = at + most
        if end < len(text):
            gap = SPACE.search(text, end)
            end = gap.start() if gap else len(text)
        yield text[at:end].lower().split()
        at = end


def shingle_hashes(text: bytes, width: int) -> Iterator[np.ndarray]:
    """XXH64 of all ``width``-word shingles of a text, part by part; all words if there are fewer, nothing if none."""
    digest, words, whole = xxhash.xxh64_intdigest, [], False
    for part in word_parts(text):
        words += part
        if len(words) < width:
            continue
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        first, last = [0, *(ends[: len(words) - width] + 1).tolist()], ends[width - 1 :].tolist()
        yield np.array([digest(joined[s:e], SEED) for s, e in zip(first, last, strict=True)], "<u8")
        words, whole = words[len(words) - width + 1 :], True
    if words and not whole:
        yield np.array([digest(b" ".join(words), SEED)], "<u8")


def bit_counts(values: np.ndarray) -> np.ndarray:
    """How many of the values have each bit set."""
    split = values.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
    return np.concatenate([np.bincount(split[:, k], minlength=256) @ BITS_OF_BYTE for k in range(8)])


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """Bits set in over half of a text's shingle hashes; 0 for a text without words."""
    counts, total = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text, width):
        counts += bit_counts(hashes)
        total += len(hashes)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``doc_id`` and ``print`` (the fingerprint as a signed long) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                prints = np.array([fingerprint(t, width) for _, part in slices(utf8(batch.column(1))) for t in part], np.uint64)
                yield pa.record_batch([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "print"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, print long")


def even_bits(prints: DataFrame) -> list[int]:
    """The bits of ``print``, those set nearest to half of all rows first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = np.zeros(BITS, np.int64), 0
        for batch in batches:
            counts += bit_counts(batch.column(0).to_numpy().view(np.uint64))
            total += batch.num_rows
        yield pa.record_batch([pa.array(np.arange(BITS)), pa.array(counts), pa.array(np.full(BITS, total))], names=["bit", "n", "total"])

    rows = prints.select("print").mapInArrow(run, "bit long, n long, total long").groupBy("bit").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    return [r.bit for r in sorted(rows.collect(), key=lambda r: (abs(2 * r.n - r.total), r.bit))] or list(range(BITS))


def _permuted(values: np.ndarray, order: list[int]) -> np.ndarray:
    """Bits of values in another order, ``order[0]`` as the highest."""
    out = np.zeros(len(values), np.uint64)
    for place, bit in enumerate(order):
        out |= ((values >> np.uint64(bit)) & np.uint64(1)) << np.uint64(BITS - 1 - place)
    return out


def with_paths(prints: DataFrame, order: list[int]) -> DataFrame:
    """``path`` (the trie's order of bits, signed long) of every ``print``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            yield pa.record_batch([batch.column(0), pa.array(_permuted(values, order).view(np.int64))], names=["print", "path"])

    return prints.select("print").mapInArrow(run, "print long, path long")


def _prefix(depth: int):
    """The first ``depth`` bits of ``path`` as a number."""
    return F.shiftrightunsigned("path", BITS - depth) if depth else F.lit(0).cast("long")


def _masks(bits: int, budget: int) -> list[tuple[int, int]]:
    """Numbers of ``bits`` bits with at most ``budget`` ones, and how many they have."""
    return [(m, m.bit_count()) for m in range(1 << bits) if m.bit_count() <= budget]


def _flips(bits: int, budget: int):
    """An array of masks of at most ``budget`` of ``bits`` bits, with their number of ones."""
    return F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(n).alias("ones")) for m, n in _masks(bits, budget)])


def node_pairs(paths: DataFrame, budget: int = BUDGET, leaves: int = LEAVES) -> DataFrame:
    """Pairs of trie nodes left to walk inside a task: ``depth``, ``a``, ``b`` (paths so far).

    Every two fingerprints within the budget lie below exactly one pair. The rounds end at depth 64, where a
    node holds one fingerprint.
    """
    nodes = stored(paths.groupBy(_prefix(FIRST).alias("x")).agg(F.count(F.lit(1)).alias("n_x")), "trie-nodes")
    right = nodes.select(F.col("x").alias("y"), F.col("n_x").alias("n_y"))
    met = nodes.withColumn("flip", F.explode(_flips(FIRST, budget))).withColumn("y", F.col("x").bitwiseXOR(F.col("flip.mask"))).where("x <= y").join(right, "y")
    pairs = met.select(F.col("x").alias("a"), F.col("y").alias("b"), F.col("flip.ones").alias("apart"), F.col("n_x").alias("n_a"), F.col("n_y").alias("n_b"))
    done, depth, pairs = None, FIRST, stored(pairs, "trie-pairs")
    while True:
        large = (F.col("n_a") + F.when(F.col("a") == F.col("b"), F.lit(0)).otherwise(F.col("n_b")) > leaves) if depth < BITS else F.lit(False)
        small = pairs.where(~large).select(F.lit(depth).alias("depth"), "a", "b")
        done = small if done is None else done.unionByName(small)
        pairs = pairs.where(large)
        if pairs.isEmpty():
            return done
        parents = small_side(pairs.select(F.explode(F.array("a", "b")).alias("parent")).distinct())
        below = paths.withColumn("parent", _prefix(depth)).join(parents, "parent")
        depth += STEP
        children = stored(below.groupBy("parent", _prefix(depth).alias("child")).agg(F.count(F.lit(1)).alias("n")), "trie-nodes")
        left = children.select(F.col("parent").alias("a"), F.col("child").alias("x"), F.col("n").alias("n_x"))
        right = children.select(F.col("child").alias("y"), F.col("n").alias("n_y"))
        reached = pairs.join(left, "a").withColumn("flip", F.explode(_flips(STEP, budget))).where(F.col("apart") + F.col("flip.ones") <= budget)
        # The partner's path: the other node's, then the bits of this child with some flipped.
        low = F.col("x").bitwiseAND((1 << STEP) - 1).bitwiseXOR(F.col("flip.mask"))
        reached = reached.withColumn("y", F.shiftleft("b", STEP).bitwiseOR(low)).where("a <> b or x <= y")
        joined = reached.join(right, "y")
        pairs = stored(joined.select(F.col("x").alias("a"), F.col("y").alias("b"), (F.col("apart") + F.col("flip.ones")).alias("apart"), F.col("n_x").alias("n_a"), F.col("n_y").alias("n_b")), "trie-pairs")


class Forest:
    """Union of points by links, kept as a spanning forest."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def roots(self) -> np.ndarray:
        """The root of every point; paths are cut to one step."""
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return up
            self.parent = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Add links between points; those inside a tree change nothing."""
        roots = self.roots()
        fresh = roots[a] != roots[b]
        parent = self.parent
        for x, y in zip(a[fresh].tolist(), b[fresh].tolist(), strict=True):
            i, j = x, y
            while parent[i] != i:
                i = parent[i]
            while parent[j] != j:
                j = parent[j]
            if i != j:
                parent[max(i, j)] = min(i, j)
                self.links.append((x, y))


def walk(a: np.ndarray, b: np.ndarray | None, depth: int, budget: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two sorted arrays of paths, or inside one: positions in ``a`` then ``b``.

    Each of them lies below one node of ``depth``. Node pairs are ranges of the arrays; deeper pairs are taken
    first and in bounded numbers, so the walk holds no more than a few such chunks a level.
    """
    other = a if b is None else b
    shift = 0 if b is None else len(a)
    forest = Forest(len(a) + (0 if b is None else len(b)))
    apart = 0 if b is None or not depth else int((int(a[0]) ^ int(b[0])) >> (BITS - depth)).bit_count()
    waiting = [(depth, np.array([[0, len(a), 0, len(other), apart]], np.int64))]
    while waiting:
        depth, pairs = waiting.pop()
        if len(pairs) > PAIRS:
            waiting.append((depth, pairs[PAIRS:]))
            pairs = pairs[:PAIRS]
        pairs = pairs[~_joined(pairs, shift, forest)]
        tiny = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2]) <= TINY
        if depth == BITS:
            tiny[:] = True
        _compare(a, other, pairs[tiny], budget, b is None, shift, forest)
        pairs = pairs[~tiny]
        if not len(pairs):
            continue
        # Split both ranges at the next bit, and pair the halves.
        bit = np.uint64(1 << (BITS - 1 - depth))
        above = ~np.uint64((1 << (BITS - depth)) - 1) if depth else np.uint64(0)
        mid_a = np.clip(np.searchsorted(a, (a[pairs[:, 0]] & above) | bit), pairs[:, 0], pairs[:, 1])
        mid_b = np.clip(np.searchsorted(other, (other[pairs[:, 2]] & above) | bit), pairs[:, 2], pairs[:, 3])
        lo_a, hi_a, lo_b, hi_b, apart = pairs.T
        same = (lo_a == lo_b) & (b is None)
        quarters = [
            (lo_a, mid_a, lo_b, mid_b, apart),
            (mid_a, hi_a, mid_b, hi_b, apart),
            (lo_a, mid_a, mid_b, hi_b, apart + 1),
            (mid_a, hi_a, lo_b, mid_b, np.where(same, budget + 1, apart + 1)),  # inside one node that is the pair before, turned round
        ]
        split = np.concatenate([np.stack(q, axis=1) for q in quarters])
        alive = (split[:, 4] <= budget) & (split[:, 0] < split[:, 1]) & (split[:, 2] < split[:, 3])
        if alive.any():
            waiting.append((depth + 1, split[alive]))
    return forest.links


def _joined(pairs: np.ndarray, shift: int, forest: Forest) -> np.ndarray:
    """Whether all that lies below both nodes of a pair is one tree of the forest already."""
    roots = forest.roots()
    changes = np.concatenate([[0], np.cumsum(roots[1:] != roots[:-1])])
    lo_a, hi_a, lo_b, hi_b = pairs[:, 0], pairs[:, 1] - 1, pairs[:, 2] + shift, pairs[:, 3] - 1 + shift
    return (changes[lo_a] == changes[hi_a]) & (changes[lo_b] == changes[hi_b]) & (roots[lo_a] == roots[lo_b]) & (lo_a != hi_b)


def _compare(a: np.ndarray, b: np.ndarray, pairs: np.ndarray, budget: int, inside: bool, shift: int, forest: Forest) -> None:
    """Compare all that lies below small node pairs."""
    wide, sizes = pairs[:, 3] - pairs[:, 2], (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2])
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(PRODUCTS, sizes.sum() + PRODUCTS, PRODUCTS))
    for part in np.split(np.arange(len(pairs)), np.unique(cuts)):
        if not len(part):
            continue
        place = np.repeat(part, sizes[part])
        nth = np.arange(len(place)) - np.repeat(np.cumsum(sizes[part]) - sizes[part], sizes[part])
        i, j = pairs[place, 0] + nth // wide[place], pairs[place, 2] + nth % wide[place]
        if inside:
            i, j = i[i < j], j[i < j]
        near = np.bitwise_count(a[i] ^ b[j]) <= budget
        if near.any():
            forest.link(i[near], j[near] + shift)


OWN_WALKED, OWN, OTHER = range(3)


def _walked(budget: int):
    """A ``mapInArrow`` function over rows (depth, home, turn, other, path) sorted by all but the path.

    A home node's own fingerprints come first and are held; each of its partners' follow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        home = np.empty(0, np.uint64)

        def given() -> pa.RecordBatch:
            nonlocal home
            rows = np.concatenate(held)
            depth, turn = int(rows[0, 0]), int(rows[0, 2])
            paths = np.sort(np.ascontiguousarray(rows[:, 4]).view(np.uint64))
            found: list[tuple[int, int]] = []
            if turn == OTHER:
                found, both = walk(home, paths, depth, budget), np.concatenate([home, paths])
            else:
                home = both = paths
                if turn == OWN_WALKED:
                    found = walk(home, None, depth, budget)
            links = both[np.array(found, np.int64).reshape(-1, 2)].view(np.int64)
            return pa.record_batch([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(i).to_numpy() for i in range(5)], axis=1)
            for part in np.split(rows, np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1):
                if held and (held[-1][0, :4] != part[0, :4]).any():
                    yield given()
                    held = []
                held.append(part)
        if held:
            yield given()

    return run


def trie_links(paths: DataFrame, budget: int = BUDGET, leaves: int = LEAVES) -> DataFrame:
    """``a``, ``b``: links of distinct paths that span the same components as all pairs within the budget."""
    pairs = stored(node_pairs(paths, budget, leaves), "trie-leaves")
    own = pairs.groupBy("depth", "a").agg(F.min(F.when(F.col("a") == F.col("b"), OWN_WALKED).otherwise(OWN)).alias("turn"))
    own = own.select("depth", F.col("a").alias("node"), F.col("a").alias("home"), "turn", F.col("a").alias("other"))
    partners = pairs.where("a <> b").select("depth", F.col("b").alias("node"), F.col("a").alias("home"), F.lit(OTHER).alias("turn"), F.col("b").alias("other"))
    depths = sorted(r.depth for r in pairs.select("depth").distinct().collect())  # one each STEP levels at most
    nodes = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), _prefix(d).alias("node")) for d in depths or [FIRST]]))
    dealt = paths.select("path", nodes.alias("at")).select("path", "at.*").join(small_side(own.unionByName(partners)), ["depth", "node"])
    keys = [F.col("depth").cast("long").alias("depth"), "home", F.col("turn").cast("long").alias("turn"), "other", "path"]
    sorted_homes = dealt.select(*keys).repartition("depth", "home").sortWithinPartitions("depth", "home", "turn", "other")
    return sorted_homes.mapInArrow(_walked(budget), "a long, b long")


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, budget: int = BUDGET, leaves: int = LEAVES) -> DataFrame:
    """One row a document: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` (smallest id reachable by links).

    A null text, or one without words, has fingerprint 0 and is linked like any other. A null id is linked with
    nothing and stays null. Rows that share an id each get the component of their own fingerprint.
    """
    prints = stored(fingerprints(docs, doc_id, text, width), "simhash-prints")
    named = prints.where("doc_id is not null")
    nodes = stored(named.groupBy("print").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "simhash-nodes")
    paths = stored(with_paths(nodes, even_bits(nodes)), "simhash-paths")
    found = components(stored(trie_links(paths.select("path"), budget, leaves), "simhash-links"))
    # Fingerprints that are linked or held by several documents; all others are their own components.
    moved = found.withColumnRenamed("node", "path").select("path", "component")
    whole = moved.unionByName(moved.select(F.col("component").alias("path"), "component").distinct())
    members = nodes.join(paths.join(small_side(whole), "path", "left").select("print", F.coalesce("component", "path").alias("component"), F.col("component").isNotNull().alias("linked")), "print")
    members = stored(members.where("linked or n > 1"), "simhash-members")
    smallest = stored(members.groupBy("component").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("members")), "simhash-smallest")
    owned = join_hot(members.select("component", "print", "n"), smallest, "component", "members").select("print", "component_id", "n")
    joined = join_hot(prints, stored(owned, "simhash-owned"), "print", "n")
    linked = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), linked.alias("component_id"))
