"""Context keys and words that a broadcast table leaves out, looked up by blocks of texts.

A task collects the keys it misses. A block of them is its distinct keys, dealt to bins and compressed, and for each
text the places of its keys among them; the texts themselves stay where they are. A bin meets the costs of its keys
and hands them back in the order of the block's keys, so a key moves once a block, whatever number of texts holds
it, and only its cost comes back. Words go the same way, and their counts come back.
"""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.arrays import mixed

BLOCK_KEYS = 1 << 21
BIN_KEYS = 50_000
BIN_WORDS = 200_000
COLUMNS = {"kind": pa.string(), "block": pa.int64(), "bin": pa.int64(), "packed": pa.list_(pa.binary())}
DDL = "kind string, block long, bin long, packed array<binary>"
Rows = list[tuple[str, int, int | None, list[bytes]]]


def packed(values: np.ndarray) -> bytes:
    """Numbers as planes of their bytes, compressed, after their number."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return len(values).to_bytes(8, "little") + pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.Codec("zstd").decompress(data[8:], n * width), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(kind).reshape(n)


def steps(values: np.ndarray) -> bytes:
    """Ascending numbers by their differences."""
    return packed(np.diff(values, prepend=values.dtype.type(0)))


def bins_of(keys: np.ndarray, bins: int) -> np.ndarray:
    """Keys with the same three nearest bytes share a bin, so that neighbours are written as small differences."""
    return (mixed(keys >> np.uint64(24)) % np.uint64(bins)).astype(np.int64)


def _dealt(bins: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """The order by bins, the place of each key in it, and the bins there with their bounds."""
    order = np.argsort(bins, kind="stable")
    place = np.empty(len(bins), np.int32)
    place[order] = np.arange(len(bins), dtype=np.int32)
    first = np.flatnonzero(np.diff(bins[order], prepend=-1))
    return order, place, list(zip(bins[order][first].tolist(), first.tolist(), [*first[1:].tolist(), len(bins)], strict=True))


class Blocks:
    """Missed keys of the texts of a task, handed out as rows of ``COLUMNS``.

    A row with a ``bin`` holds the block's keys in that bin; one without holds row numbers of texts, how many keys
    each has, and the keys' places in the order of bin and key.
    """

    def __init__(self, bins: int, most: int = BLOCK_KEYS):
        self.bins, self.most, self.rows, self.keys, self.held = bins, most, [], [], 0

    def add(self, rows: np.ndarray, keys: np.ndarray) -> None:
        """Keys and the numbers of their texts, which ascend and are not those of earlier keys."""
        self.rows.append(rows)
        self.keys.append(keys)
        self.held += len(keys)

    def full(self) -> bool:
        return self.held >= self.most

    def take(self) -> Rows:
        if not self.held:
            return []
        keys, where = np.unique(np.concatenate(self.keys), return_inverse=True)
        texts, sizes = np.unique(np.concatenate(self.rows), return_counts=True)
        self.rows, self.keys, self.held = [], [], 0
        order, place, bins = _dealt(bins_of(keys, self.bins))
        keys, block = keys[order], int(texts[0])
        out = [("key", block, k, [steps(keys[a:b])]) for k, a, b in bins]
        return [*out, ("key", block, None, [steps(texts), packed(sizes), packed(place[where])])]


class WordBlocks:
    """Missed words likewise; no word holds a space."""

    def __init__(self, bins: int, most: int = BLOCK_KEYS):
        self.bins, self.most, self.rows, self.sizes, self.at, self.ids = bins, most, [], [], [], {}

    def add(self, row: int, words: list[bytes]) -> None:
        self.rows.append(row)
        self.sizes.append(len(words))
        self.at.extend([self.ids.setdefault(w, len(self.ids)) for w in words])

    def full(self) -> bool:
        return len(self.at) + 3 * len(self.ids) >= self.most  # a word takes more memory than its place

    def take(self) -> Rows:
        if not self.rows:
            return []
        words = sorted(self.ids)
        order, place, bins = _dealt(np.fromiter((crc32(w) % self.bins for w in words), np.int64, len(words)))
        of_id = np.empty(len(words), np.int32)
        of_id[[self.ids[w] for w in words]] = place
        words, block = [words[i] for i in order.tolist()], self.rows[0]
        out = [("word", block, k, [_joined(words[a:b])]) for k, a, b in bins]
        out.append(("word", block, None, [steps(np.array(self.rows)), packed(np.array(self.sizes)), packed(of_id[self.at])]))
        self.rows, self.sizes, self.at, self.ids = [], [], [], {}
        return out


def _joined(words: list[bytes]) -> bytes:
    return packed(np.frombuffer(b" ".join(words), np.uint8))


def _looked_up(blocks: DataFrame, kind: str, known: DataFrame, price: Callable, add: Callable, columns: str) -> DataFrame:
    """What ``add`` makes of a block's texts and of what ``price`` found for its bins in ``known``."""
    asked = blocks.where((F.col("kind") == kind) & F.col("bin").isNotNull()).select("block", "bin", "packed").groupBy("bin")
    found = asked.cogroup(known.groupBy("bin")).applyInArrow(price, "block long, bin long, found binary")
    texts = blocks.where((F.col("kind") == kind) & F.col("bin").isNull()).select("block", "packed").groupBy("block")
    return texts.cogroup(found.groupBy("block")).applyInArrow(add, columns)


def _texts(texts: pa.Table, found: pa.Table, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers of a block's texts, where their keys begin, and what was found for each of these."""
    rows, sizes, places = texts["packed"][0].as_py()
    parts = found["found"].to_pylist()
    values = np.concatenate([unpacked(parts[i], kind) for i in np.argsort(found["bin"].to_numpy())])
    sizes = unpacked(sizes, np.int64)
    return np.cumsum(unpacked(rows, np.int64)), np.cumsum(sizes) - sizes, values[unpacked(places, np.int32)]


def _found(asked: pa.Table, values: list[np.ndarray]) -> pa.Table:
    return pa.table([asked["block"], asked["bin"], pa.array([packed(v) for v in values], pa.binary())], names=["block", "bin", "found"])


def added_costs(blocks: DataFrame, costs: DataFrame, bins: int) -> DataFrame:
    """Rows ``row``, ``added``: the summed costs of the missed keys of each text that has some; ``costs`` has all of these."""

    def deal(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy().view(np.uint64)
            yield pa.record_batch([pa.array(bins_of(keys, bins)), batch.column(0), batch.column(1)], names=["bin", "key", "cost"])

    def price(asked: pa.Table, known: pa.Table) -> pa.Table:
        keys = known["key"].to_numpy().view(np.uint64)
        order = np.argsort(keys)
        keys, values = keys[order], known["cost"].to_numpy()[order]
        return _found(asked, [values[np.searchsorted(keys, np.cumsum(unpacked(p[0], np.uint64)))] for p in asked["packed"].to_pylist()])

    def add(texts: pa.Table, found: pa.Table) -> pa.Table:
        rows, first, values = _texts(texts, found, np.float64)
        return pa.table([pa.array(rows), pa.array(np.add.reduceat(values, first))], names=["row", "added"])

    dealt = costs.select("key", "cost").mapInArrow(deal, "bin long, key long, cost double")
    return _looked_up(blocks, "key", dealt, price, add, "row long, added double")


def added_words(blocks: DataFrame, words: DataFrame, bins: int, outcomes: int) -> DataFrame:
    """Rows ``row``, ``rare_base``, ``rare_known``: the summed add-one log10 probabilities of the missed words of each text that has some, and how many of them are in ``words``."""

    def price(asked: pa.Table, known: pa.Table) -> pa.Table:
        counts = dict(zip(known["word"].to_pylist(), known["n"].to_pylist(), strict=True))
        every = (unpacked(p[0], np.uint8).tobytes().split(b" ") for p in asked["packed"].to_pylist())
        return _found(asked, [np.array([counts.get(w, 0) for w in some], np.int64) for some in every])

    def add(texts: pa.Table, found: pa.Table) -> pa.Table:
        rows, first, values = _texts(texts, found, np.int64)
        sums = [np.add.reduceat(x, first) for x in (np.log10((values + 1) / outcomes), (values > 0).astype(np.int64))]
        return pa.table([pa.array(rows), *map(pa.array, sums)], names=["row", "rare_base", "rare_known"])

    dealt = words.select((F.crc32("word") % bins).alias("bin"), "word", "n")
    return _looked_up(blocks, "word", dealt, price, add, "row long, rare_base double, rare_known long")
